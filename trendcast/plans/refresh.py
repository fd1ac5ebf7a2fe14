"""Scheduled refresh: staging materialized once, every mart written from it.

The batch form of rebuilding the views: staging is written once (its local
time parts, durations and scores are then not recomputed per mart), the marts
and quality checks read that copy, and each result is written as a table.
Writes go to ``out`` (a shared folder); a mart is replaced as a whole by
``mode('overwrite')`` only after it has been computed from the staging copy.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from trendcast import constants as K
from trendcast.plans import marts, quality, staging
from trendcast.plans import partials as pt
from trendcast.sources.snapshots import SnapshotStore
from trendcast.streaming.ingest import TABLE


def refresh_marts(spark: SparkSession, raw_trends: DataFrame, videos: DataFrame, as_of: dt.datetime,
                  out: str) -> dict[str, str]:
    """Write staging, the four marts and the not-null report below ``out``; returns their paths."""
    paths = {name: f"{out.rstrip('/')}/{name}" for name in (
        "stg_trending_now", "mart_trending_topics", "mart_category_pulse", "mart_keyword_recurrence",
        "mart_gap_analysis", "dq_not_null")}
    staging.stg_trending_now(raw_trends, as_of).write.mode("overwrite").parquet(paths["stg_trending_now"])
    stg = spark.read.parquet(paths["stg_trending_now"])
    built = {
        "mart_trending_topics": marts.mart_trending_topics(stg),
        "mart_category_pulse": marts.mart_category_pulse(stg),
        "mart_keyword_recurrence": marts.mart_keyword_recurrence(stg, as_of),
        "mart_gap_analysis": marts.mart_gap_analysis(videos, raw_trends, as_of),
    }
    for name, df in built.items():
        df.write.mode("overwrite").parquet(paths[name])
    not_null_report(spark, paths).write.mode("overwrite").parquet(paths["dq_not_null"])
    return paths


def refresh_from_partials(trends: SnapshotStore, videos: SnapshotStore, month: str, as_of: dt.datetime, partials: str,
                          out: str) -> dict[str, list[str]]:
    """Bring the stored partials below ``partials`` up to date and write the pulse, recurrence and gap marts from them.

    Returns the days that were aggregated again, by partial table. What is read
    of the stores grows with what has changed, what is written with the marts.
    """
    spark, base, out = trends.spark, partials.rstrip("/"), out.rstrip("/")
    rows = staging.stg_trending_now(trends.load(month).limit(0), as_of)
    pulse = pt.partial_store(spark, f"{base}/pulse_day", pt.pulse_day, rows, "trend_date")
    recurrence = pt.partial_store(spark, f"{base}/recurrence_day", pt.recurrence_day, rows, "trend_date")
    supply = pt.partial_store(spark, f"{base}/supply_day", pt.supply_day, videos.load(month), "published_day")
    supply.grain = videos.grain
    days = {"pulse_day": pt.refresh_trend_partials(trends, month, pulse, pt.pulse_day, as_of),
            "recurrence_day": pt.refresh_trend_partials(trends, month, recurrence, pt.recurrence_day, as_of),
            "supply_day": pt.refresh_supply_partials(videos, month, supply)}
    by_keyword = recurrence.load(TABLE)
    built = {"mart_category_pulse": pt.mart_category_pulse(pulse.load(TABLE)),
             "mart_keyword_recurrence": pt.mart_keyword_recurrence(by_keyword, as_of),
             "mart_gap_analysis": pt.mart_gap_analysis(supply.load(TABLE), by_keyword, as_of)}
    for name, df in built.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
    return days


def not_null_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The not-null rules over the written tables, one scan of a table's few checked columns each."""
    return quality.combine(*[quality.check_not_null(spark.read.parquet(paths[m]), m, cols)
                             for m, cols in K.NOT_NULL_RULES.items()])
