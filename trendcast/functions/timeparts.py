"""Time expressions: durations, local civil time, week numbers, epochs, month tags.

All timestamps are handled as TIMESTAMP_NTZ holding UTC wall time, so results do
not depend on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendcast import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_literal(value: dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (never shifted by the session time zone)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def duration_hours(start="start_date", end="end_date", as_of: dt.datetime | None = None) -> Column:
    """Whole hours from start to end (NULL end = still running until ``as_of``), truncated.

    The difference of two NTZ values takes part in no time zone: an hour is an
    hour across a DST change of the session zone.
    """
    end_col = _c(end)
    if as_of is not None:
        end_col = F.coalesce(end_col, ntz_literal(as_of))
    return (end_col - _c(start)).cast("interval hour").cast("bigint")


def to_local(ts="start_date", tz: str = K.LOCAL_TZ) -> Column:
    """UTC wall time -> local wall time (both TIMESTAMP_NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts).cast("timestamp_ntz"))


def monday_week(date) -> Column:
    """Week of year 00-53, weeks start on Monday, days before the first Monday are week 00."""
    d = _c(date)
    week = F.floor((F.dayofyear(d) + F.lit(6) - F.weekday(d)) / F.lit(7))
    return F.lpad(week.cast("string"), 2, "0")


def local_parts(df: DataFrame, ts_col: str = "start_date", tz: str = K.LOCAL_TZ) -> DataFrame:
    """Adds trend_date, start_hour_eat, day_of_week, month_name, week_number."""
    local = "__local_ts"
    out = df.withColumn(local, to_local(ts_col, tz))
    day = F.to_date(F.col(local))
    return out.withColumns({
        "trend_date": day,
        "start_hour_eat": F.hour(F.col(local)).cast("bigint"),
        "day_of_week": F.date_format(day, "EEEE"),
        "month_name": F.date_format(day, "MMMM"),
        "week_number": monday_week(day),
    }).drop(local)


_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def from_epoch(col, falsy_null: bool = False) -> Column:
    """Epoch seconds (number or numeric text) -> TIMESTAMP_NTZ in UTC.

    ``falsy_null`` maps 0 and '' to NULL (an absent end time).
    """
    c = _c(col)
    secs = c.cast("string").try_cast("bigint")
    if falsy_null:
        secs = F.when(secs == 0, F.lit(None).cast("bigint")).otherwise(secs)
    return F.timestamp_add("SECOND", secs, F.expr(_EPOCH))


def month_suffix(ts) -> Column:
    """'2024_jan' style tag of the month a timestamp falls in."""
    return F.lower(F.date_format(_c(ts), "yyyy_MMM"))


def month_tag(value: dt.datetime | dt.date) -> str:
    """Driver-side twin of ``month_suffix`` for a known parameter value."""
    return value.strftime("%Y_%b").lower()


def month_start(value: dt.datetime | dt.date) -> dt.datetime:
    return dt.datetime(value.year, value.month, 1)


def add_months(value: dt.datetime, months: int) -> dt.datetime:
    y, m = divmod(value.year * 12 + (value.month - 1) + months, 12)
    return dt.datetime(y, m + 1, 1)


_ZONED = r"[+-][0-9]{2}:?[0-9]{2}$"


def parse_iso_ts(col) -> Column:
    """ISO-8601 text (2024-01-02T03:04:05Z, with or without zone) -> TIMESTAMP_NTZ UTC wall time.

    Text with an explicit zone (Z or +hh:mm) is read as an instant and turned
    into UTC wall time; text without one is taken as UTC wall time. Bad text
    gives NULL. Spark's cast parser does the work (no regex extraction), and
    the session time zone never shifts the result.
    """
    c = _c(col)
    zoned = c.endswith("Z") | c.rlike(_ZONED)
    return F.when(zoned, instant_to_ntz(c.try_cast("timestamp"))).otherwise(c.try_cast("timestamp_ntz"))


def epoch_micros(col) -> Column:
    """UTC wall time (TIMESTAMP_NTZ) -> microseconds since 1970-01-01 00:00 UTC.

    From the difference to the epoch as NTZ values: no time zone takes part,
    unlike a cast of NTZ to TIMESTAMP, which reads the value in the session zone.
    """
    since = _c(col) - F.expr(_EPOCH)
    return (since.cast("interval second").cast("decimal(38,6)") * F.lit(1000000)).cast("bigint")


def ntz_to_instant(col) -> Column:
    """UTC wall time (TIMESTAMP_NTZ) -> TIMESTAMP instant, whatever the session time zone."""
    return F.timestamp_micros(epoch_micros(col))


def epoch_seconds(col) -> Column:
    """UTC wall time (TIMESTAMP_NTZ) -> whole seconds since 1970-01-01 (floor)."""
    return F.unix_seconds(ntz_to_instant(col))


def instant_to_ntz(col) -> Column:
    """TIMESTAMP instant -> UTC wall time (TIMESTAMP_NTZ), whatever the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), F.expr(_EPOCH))
