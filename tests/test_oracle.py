"""Every registered query against its DuckDB oracle on the small fixture."""

import pytest

from oracle_check import compare
from trendcast.catalog import REGISTRY
from trendcast.oracle import QUERIES


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, sf_dir, name):
    res = compare(spark, con, sf_dir, name, REGISTRY[name], QUERIES[name])
    assert res["status"] == "ok", res
    assert res["rows"] > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    qs = entry.queries()
    sql = entry.oracle_sql()
    assert set(sql) <= set(qs)


def test_entry_without_the_corpus_subpackage(tmp_path):
    """The rest works where the subpackage and its pipeline are not installed."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/trendcast", tmp_path / "trendcast", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sorted(set(q) - set(e.oracle_sql())))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                         env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert got.stdout.split() == [str(len(REGISTRY)), "[]"], got.stderr
