"""Publishing refreshed tables as named views for SQL users."""

from __future__ import annotations

from pyspark.sql import SparkSession

VIEWS = ["stg_trending_now", "mart_trending_topics", "mart_category_pulse", "mart_keyword_recurrence",
         "mart_gap_analysis"]


def publish_views(spark: SparkSession, paths: dict[str, str]) -> list[str]:
    """A view per table of ``paths`` (see ``refresh_marts``).

    The views are SQL text over the tables' folders: each query resolves them
    anew, so it sees the files of the latest refresh. No job runs here.
    """
    for name in VIEWS:
        spark.sql(f"create or replace temporary view {name} as select * from parquet.`{paths[name]}`")
    return list(VIEWS)
