"""Reading the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendcast.session import fit_shuffles

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the test data; Catalyst prunes columns and pushes filters into the scan.

    The session's shuffles are fitted to its size (:func:`fit_shuffles`).
    """
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    fit_shuffles(spark, path)
    return spark.read.parquet(path)
