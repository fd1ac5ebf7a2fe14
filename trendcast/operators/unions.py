"""UNION ALL by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame) -> DataFrame:
    """Concatenate by name; a column missing from one input is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
