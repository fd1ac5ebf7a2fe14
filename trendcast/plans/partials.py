"""Marts kept from mergeable partial aggregates per group and day.

A refresh aggregates only the days whose rows have changed since the last one
(the source's manifest tells), or that hold trends without an end, whose duration
grows with ``as_of``. The marts are combined from the stored partials, which are
as large as there are groups and days, not rows. Medians come from stored quantile
sketches, most frequent values from stored heavy-hitter states: both are merged
over days, and exact while a group stays within their size.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendcast import constants as K
from trendcast.functions.aggregates import counter_names
from trendcast.functions.scoring import gap_score, opportunity, recurrence_label, scheduling_tip, time_of_day
from trendcast.functions.timeparts import ntz_literal
from trendcast.operators.filters import watchable
from trendcast.plans.marts import category_day_aggregates, common_time_counts, join_on_folded, pulse_windows, with_common_times
from trendcast.plans.staging import stg_trending_now
from trendcast.sources.snapshots import NO_DAY, SnapshotStore
from trendcast.streaming.ingest import TABLE, around, near

# A quantile sketch is exact up to this many values of a group, and off by about 1 / KLL_K of the ranks beyond.
KLL_K = 4096
# A heavy-hitter state is exact up to this many different values of a group.
TOP_ITEMS = 1024

_TIME_COUNTERS = [*counter_names(K.TIMES_OF_DAY, "_tod_"), *counter_names(K.WEEKDAYS, "_day_")]


# -- partials of a day --------------------------------------------------------------------

def pulse_day(stg: DataFrame) -> DataFrame:
    """Per category and local day: the day's measures, and how many of its trends are still open."""
    still = stg.groupBy(F.col("categories").alias("_c"), F.col("trend_date").alias("_d")).agg(
        F.count_if(F.col("end_date").isNull()).alias("open_rows"))
    on = F.col("categories").eqNullSafe(F.col("_c")) & F.col("trend_date").eqNullSafe(F.col("_d"))
    return category_day_aggregates(stg).join(still, on).drop("_c", "_d")


def recurrence_day(stg: DataFrame) -> DataFrame:
    """Per keyword, category and local day: sums, counts and extremes from which any span of days is combined."""
    return stg.withColumn("_tod", time_of_day("start_hour_eat")).groupBy("query", "categories", "trend_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("search_volume").alias("volume_sum"), F.count("search_volume").alias("volume_n"), F.max("search_volume").alias("volume_max"),
        F.sum("increase_percentage").alias("increase_sum"), F.count("increase_percentage").alias("increase_n"),
        F.sum("trend_duration_hrs").alias("duration_sum"), F.count("trend_duration_hrs").alias("duration_n"),
        F.bool_or("active").alias("any_active"), F.max("start_date").alias("last_start"),
        F.count_if(F.col("end_date").isNull()).alias("open_rows"), *common_time_counts())


def supply_day(videos: DataFrame) -> DataFrame:
    """Per keyword and day of publication: counts, sums, the largest, and a quantile sketch of the views."""
    day = F.to_date("published_ts").alias("published_day")
    return watchable(videos).groupBy("keyword", day).agg(
        F.count("video_id").alias("video_count"), F.sum("view_count").alias("views_sum"), F.count("view_count").alias("views_n"),
        F.max("view_count").alias("views_max"), F.sum("like_count").alias("likes"), F.sum("comment_count").alias("comments"),
        F.expr(f"kll_sketch_agg_bigint(view_count, {KLL_K})").alias("views"))


def top_state(value: str) -> Column:
    """A mergeable state of how often each value occurs, NULL being a value like any other."""
    return F.expr(f"approx_top_k_accumulate({value}, {TOP_ITEMS})")


def merged_top(state: str) -> Column:
    """(value, count) of the most frequent value of merged states; ties go to the lowest value, NULL last."""
    items = F.expr(f"approx_top_k_estimate(approx_top_k_combine({state}), {TOP_ITEMS})")
    ranked = F.transform(items, lambda i: F.struct((-i["count"]).alias("less"), i["item"].isNull().alias("none"), i["item"].alias("value")))
    first = F.array_min(ranked)
    return F.struct(first["value"].alias("value"), (-first["less"]).alias("count"))


def hours_day(stg: DataFrame) -> DataFrame:
    """Per category and local day: a heavy-hitter state of the start hours."""
    return stg.groupBy("categories", "trend_date").agg(top_state("start_hour_eat").alias("hours"))


def top_hours(partials: DataFrame) -> DataFrame:
    """Per category the start hour that most trends have, from the daily states."""
    best = partials.groupBy("categories").agg(merged_top("hours").alias("best"))
    return best.select("categories", F.col("best.value").alias("top_hour"), F.col("best.count").cast("bigint").alias("trends"))


# -- refreshing them -----------------------------------------------------------------------

def partial_store(spark: SparkSession, base: str, day: Callable[[DataFrame], DataFrame], rows: DataFrame, day_col: str) -> SnapshotStore:
    """A store for the partials that ``day`` makes of ``rows`` (only their columns matter here)."""
    return SnapshotStore(spark, base, day(rows.limit(0)).schema, day_col)


def refresh_trend_partials(source: SnapshotStore, month: str, partials: SnapshotStore, day: Callable[[DataFrame], DataFrame],
                           as_of: dt.datetime) -> list[str]:
    """Aggregate the changed or open local days of a month of trends again; these days.

    The source has a UTC day of ``start_date`` as its partition. What was
    aggregated stands in the manifest of ``partials`` together with the rows.
    """
    now, before = source.entries(month), partials.note("source", {})
    changed = [d for d in sorted({*now, *before}) if now.get(d) != before.get(d)]
    local, _ = around(changed)
    still_open = set()
    if "open_rows" in partials.schema.fieldNames():  # at most one row per stored day
        for r in partials.load(TABLE).where("open_rows > 0").select("trend_date").distinct().collect():
            still_open.add(r["trend_date"])
    local = sorted({*local, *(d for d in still_open if d)})
    utc = [d.strftime("%Y_%m_%d") for d in near(local)]
    undated = NO_DAY in changed or None in still_open
    if not local and not undated:
        return []
    stg = stg_trending_now(source.load_days(month, [*utc, *([NO_DAY] if undated else [])]), as_of)
    wanted = F.col("trend_date").isin(local)
    if undated:
        wanted = wanted | F.col("trend_date").isNull()
    days = [d.strftime("%Y_%m_%d") for d in local] + [NO_DAY] * undated
    partials.replace_days(day(stg.where(F.coalesce(wanted, F.lit(False)))), TABLE, days, compacted=True, note={"source": now})
    return days


def refresh_supply_partials(source: SnapshotStore, month: str, partials: SnapshotStore) -> list[str]:
    """Aggregate the changed days of publication of a month of keyword videos again; these days."""
    now, before = source.entries(month), partials.note("source", {})
    changed = [d for d in sorted({*now, *before}) if now.get(d) != before.get(d)]
    if changed:
        partials.replace_days(supply_day(source.load_days(month, changed)), TABLE, changed, compacted=True, note={"source": now})
    return changed


# -- the marts ------------------------------------------------------------------------------

def mart_category_pulse(partials: DataFrame) -> DataFrame:
    """The pulse mart from the partials of :func:`pulse_day`."""
    return pulse_windows(partials.drop("open_rows"))


def mart_keyword_recurrence(partials: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The recurrence mart from the partials of :func:`recurrence_day`."""
    average = lambda what, digits: F.round(F.try_divide(F.sum(f"{what}_sum"), F.sum(f"{what}_n")), digits)
    agg = partials.groupBy("query", "categories").agg(
        F.sum("n").alias("times_trended"),
        F.min("trend_date").alias("first_seen_date"),
        F.max("trend_date").alias("last_seen_date"),
        F.datediff(F.max("trend_date"), F.min("trend_date")).cast("bigint").alias("active_span_days"),
        average("volume", 0).alias("avg_search_volume"),
        F.max("volume_max").alias("peak_search_volume"),
        average("increase", 0).alias("avg_increase_pct"),
        average("duration", 1).alias("avg_trend_duration_hrs"),
        *[F.sum(c).alias(c) for c in _TIME_COUNTERS],
        F.bool_or("any_active").alias("currently_active"),
        F.max("last_start").alias("last_trend_start"),
        F.datediff(F.lit(as_of.date()), F.max("trend_date")).cast("bigint").alias("days_since_last_trend"),
    )
    return with_common_times(agg).withColumns({"recurrence_label": recurrence_label(), "scheduling_tip": scheduling_tip()})


def mart_gap_analysis(supply: DataFrame, recurrence: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The gap mart from the partials of :func:`supply_day` and :func:`recurrence_day`."""
    per_keyword = supply.groupBy("keyword").agg(
        F.sum("video_count").alias("video_count"),
        F.round(F.try_divide(F.sum("views_sum"), F.sum("views_n")), 0).alias("avg_views"),
        F.expr("kll_sketch_get_quantile_bigint(kll_merge_agg_bigint(views), 0.5D)").alias("median_views"),
        F.max("views_max").alias("max_views"), F.sum("likes").alias("total_likes"), F.sum("comments").alias("total_comments"))
    demand = recurrence.groupBy("query").agg(F.max("volume_max").alias("search_volume"))
    joined = join_on_folded(per_keyword, "keyword", demand, "query")
    score = gap_score("search_volume", "median_views")
    return joined.select("keyword", "search_volume", "video_count", "median_views", "avg_views", "max_views", "total_likes",
                         "total_comments", score.alias("gap_score"), opportunity(score).alias("opportunity"),
                         ntz_literal(as_of).alias("collected_at"))
