"""Staging view over the trends snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast.functions.timeparts import duration_hours, local_parts, ntz_literal

TREND_COLUMNS = ["query", "start_date", "end_date", "active", "search_volume",
                 "increase_percentage", "categories", "trend_breakdown"]


def stg_trending_now(raw: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Trends plus duration so far (hours) and local-time parts of the start."""
    base = raw.select(*TREND_COLUMNS).withColumn(
        "trend_duration_hrs", duration_hours("start_date", "end_date", as_of))
    return local_parts(base, "start_date")


def keywords_last_hours(stg: DataFrame, as_of: dt.datetime, hours: int = 24) -> DataFrame:
    """Keywords that started within ``hours`` before ``as_of``, with their peak volume.

    The bound is a range predicate on the raw column, so it reaches the scan.
    """
    since = ntz_literal(as_of - dt.timedelta(hours=hours))
    return (stg.where(F.col("start_date") >= since)
            .groupBy("query").agg(F.max("search_volume").alias("search_volume")))
