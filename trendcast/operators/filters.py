"""Row filters written as range predicates so they reach the parquet scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendcast import constants as K
from trendcast.functions.timeparts import add_months, month_start, ntz_literal, parse_iso_ts


def _ts(df: DataFrame, ts_col: str) -> Column:
    """The column as a timestamp; ISO text columns are parsed."""
    if df.schema[ts_col].dataType.typeName() == "string":
        return parse_iso_ts(ts_col)
    return F.col(ts_col)


def in_month(df: DataFrame, ts_col: str, month: dt.datetime) -> Column:
    """``ts`` falls in the calendar month of ``month``, as [start, next start).

    Equivalent to month(ts) = m and year(ts) = y, but a range on a timestamp
    column is pushed down to parquet row-group statistics.
    """
    lo = month_start(month)
    hi = add_months(lo, 1)
    ts = _ts(df, ts_col)
    return (ts >= ntz_literal(lo)) & (ts < ntz_literal(hi))


def rows_in_month(df: DataFrame, ts_col: str, month: dt.datetime) -> DataFrame:
    return df.where(in_month(df, ts_col, month))


def has_rows_in_month(df: DataFrame, ts_col: str, month: dt.datetime) -> bool:
    """Existence check: stops at the first matching row."""
    return not rows_in_month(df, ts_col, month).isEmpty()


def last_hours(df: DataFrame, ts_col: str, as_of: dt.datetime,
               hours: int = K.KEYWORD_WINDOW_HOURS) -> DataFrame:
    return df.where(F.col(ts_col) >= ntz_literal(as_of - dt.timedelta(hours=hours)))


def with_id(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose id is present and not empty."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def watchable(videos: DataFrame, min_secs: int = K.MIN_DURATION_SECS, min_views: int = K.MIN_VIEWS) -> DataFrame:
    """Playable and watched: long enough and at least one view (pushed to the scan)."""
    return videos.where((F.col("duration_secs") >= min_secs) & (F.col("view_count") >= min_views))
