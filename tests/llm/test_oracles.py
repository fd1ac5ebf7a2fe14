"""The corpus queries that SQL can state, against their DuckDB statements."""

import pytest
from oracle_check import compare

from trendcast.llm.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf_dir, name):
    res = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES[name])
    assert res["status"] == "ok" and res["rows"] > 0, res
