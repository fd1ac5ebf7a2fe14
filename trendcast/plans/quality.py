"""Data-quality checks as DataFrames of (model, column, check, failures)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _report(counts: DataFrame, model: str, check: str, cols: list[str]) -> DataFrame:
    long = counts.unpivot([], cols, "column", "failures")
    return long.select(F.lit(model).alias("model"), "column", F.lit(check).alias("check"),
                       F.col("failures").cast("bigint").alias("failures"))


def check_not_null(df: DataFrame, model: str, cols: list[str]) -> DataFrame:
    """NULL count per column, all columns in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _report(counts, model, "not_null", cols)


def check_accepted(df: DataFrame, model: str, domains: dict[str, list]) -> DataFrame:
    """Count of non-NULL values outside the allowed set, per column, one scan."""
    cols = list(domains)
    counts = df.agg(*[F.count_if(~F.col(c).isin(list(v))).alias(c) for c, v in domains.items()])
    return _report(counts, model, "accepted_values", cols)


def combine(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
