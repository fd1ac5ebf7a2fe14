"""The four marts: trending topics, category pulse, keyword recurrence, gap analysis."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendcast import constants as K
from trendcast.functions.aggregates import approx_median, counter_names, domain_counts, most_counted
from trendcast.functions.scoring import (
    content_window,
    gap_score,
    opportunity,
    recommendation_score,
    recurrence_label,
    scheduling_tip,
    time_of_day,
    urgency_tier,
)
from trendcast.functions.timeparts import ntz_literal
from trendcast.operators.filters import watchable
from trendcast.operators.ranking import row_number_split
from trendcast.operators.topk import arg_max_per_group

# The published column lists of the marts.
TOPIC_COLUMNS = ["query", "start_date", "end_date", "active", "search_volume", "increase_percentage",
                 "categories", "trend_breakdown", "trend_duration_hrs", "trend_date", "start_hour_eat",
                 "day_of_week", "month_name"]

# Tie-break after the score: the identifying and raw columns, so numbering is repeatable.
RANK_TIEBREAK = ["query", "start_date", "end_date", "active", "search_volume",
                 "increase_percentage", "trend_breakdown"]


def scored_topics(stg: DataFrame) -> DataFrame:
    return stg.select(
        *TOPIC_COLUMNS,
        recommendation_score().alias("recommendation_score"),
        content_window().alias("content_window"),
        urgency_tier().alias("urgency_tier"),
        time_of_day().alias("time_of_day"),
    )


def rank_order() -> list:
    return ([F.col("recommendation_score").desc_nulls_last()]
            + [F.col(c).asc_nulls_first() for c in RANK_TIEBREAK])


def mart_trending_topics(stg: DataFrame, sort: bool = False) -> DataFrame:
    """Scored and labelled trends with their rank inside the category.

    The numbering is split over (category, score, query), so a category of any
    size spreads over many tasks.
    """
    ranked = row_number_split(scored_topics(stg), ["categories"], rank_order(), "rank_in_category",
                              lead=["recommendation_score", "query"])
    return ranked.orderBy(F.col("recommendation_score").desc_nulls_last()) if sort else ranked


PULSE_KEYS = ["categories", "trend_date", "day_of_week", "week_number", "month_name"]


HOURS = list(range(24))
_HOUR, _DAY, _TOD = "_hour_", "_day_", "_tod_"


def category_day_aggregates(stg: DataFrame) -> DataFrame:
    """Per category and day: one hash aggregate, the hour of most starts from 24 counters; the
    top keyword from a second one over (category, day, query), joined on its one row per group."""
    agg = stg.groupBy(*PULSE_KEYS).agg(
        F.count(F.lit(1)).alias("total_keywords"),
        F.sum("search_volume").alias("total_search_volume"),
        F.round(F.avg("search_volume"), 0).alias("avg_search_volume"),
        F.max("search_volume").alias("peak_search_volume"),
        F.round(F.avg("increase_percentage"), 0).alias("avg_increase_pct"),
        F.max("increase_percentage").alias("max_increase_pct"),
        F.count_if(F.col("active")).alias("active_keyword_count"),
        F.round(F.avg("trend_duration_hrs"), 1).alias("avg_trend_duration_hrs"),
        *domain_counts("start_hour_eat", HOURS, _HOUR),
    ).withColumn("peak_start_hour_eat", most_counted(HOURS, _HOUR).cast("bigint")).drop(*counter_names(HOURS, _HOUR))
    keys = ["categories", "trend_date"]
    top = arg_max_per_group(stg, keys, "query", "search_volume", "top_keyword")
    right = top.select(*[F.col(k).alias(f"_top_{k}") for k in keys], "top_keyword")
    cond = [F.col(k).eqNullSafe(F.col(f"_top_{k}")) for k in keys]
    return agg.join(right, cond, "left").drop(*[f"_top_{k}" for k in keys])


def vs_trailing_avg(col: str, partition: list[str], order: str, rows: int = K.TRAILING_ROWS):
    """Value minus the average of the ``rows`` previous rows (not calendar days); first row NULL."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-rows, -1)
    return F.round(F.col(col) - F.avg(col).over(w), 1)


def daily_category_rank(total: str = "total_search_volume"):
    return F.rank().over(Window.partitionBy("trend_date").orderBy(F.col(total).desc_nulls_last()))


def pulse_windows(agg: DataFrame) -> DataFrame:
    """The comparisons between days and between categories, on one row per category and day."""
    return agg.withColumns({
        "keyword_count_vs_7d_avg": vs_trailing_avg("total_keywords", ["categories"], "trend_date"),
        "daily_category_rank": daily_category_rank().cast("bigint"),
    })


def mart_category_pulse(stg: DataFrame, sort: bool = False) -> DataFrame:
    """One row per category and local day.

    The windows run on the aggregate (one row per category-day), so their
    groups are bounded by the number of days, not by raw rows.
    """
    out = pulse_windows(category_day_aggregates(stg))
    if sort:
        out = out.orderBy(F.col("trend_date").desc(), F.col("total_search_volume").desc())
    return out


def common_time_counts() -> list:
    """Counters of daypart (column ``_tod``) and weekday; see :func:`with_common_times`."""
    return [*domain_counts("_tod", K.TIMES_OF_DAY, _TOD), *domain_counts("day_of_week", K.WEEKDAYS, _DAY)]


def with_common_times(agg: DataFrame) -> DataFrame:
    """The most common daypart and weekday from their counters, which go."""
    return agg.withColumns({
        "most_common_time_of_day": most_counted(K.TIMES_OF_DAY, _TOD),
        "most_common_day": most_counted(K.WEEKDAYS, _DAY),
    }).drop(*counter_names(K.TIMES_OF_DAY, _TOD), *counter_names(K.WEEKDAYS, _DAY))


def mart_keyword_recurrence(stg: DataFrame, as_of: dt.datetime, sort: bool = False) -> DataFrame:
    """One row per (query, categories): how often and when a keyword trends."""
    today = F.lit(as_of.date())
    agg = (stg.withColumn("_tod", time_of_day("start_hour_eat"))
           .groupBy("query", "categories").agg(
               F.count(F.lit(1)).alias("times_trended"),
               F.min("trend_date").alias("first_seen_date"),
               F.max("trend_date").alias("last_seen_date"),
               F.datediff(F.max("trend_date"), F.min("trend_date")).cast("bigint").alias("active_span_days"),
               F.round(F.avg("search_volume"), 0).alias("avg_search_volume"),
               F.max("search_volume").alias("peak_search_volume"),
               F.round(F.avg("increase_percentage"), 0).alias("avg_increase_pct"),
               F.round(F.avg("trend_duration_hrs"), 1).alias("avg_trend_duration_hrs"),
               *common_time_counts(),
               F.bool_or("active").alias("currently_active"),
               F.max("start_date").alias("last_trend_start"),
               F.datediff(today, F.max("trend_date")).cast("bigint").alias("days_since_last_trend"),
           ))
    out = with_common_times(agg).withColumns({
        "recurrence_label": recurrence_label(),
        "scheduling_tip": scheduling_tip(),
    })
    if sort:
        out = out.orderBy(F.col("times_trended").desc(), F.col("avg_search_volume").desc())
    return out


def keyword_supply(videos: DataFrame) -> DataFrame:
    """Per-keyword video supply; map-side partial aggregation, median as a sketch."""
    return watchable(videos).groupBy("keyword").agg(
        F.count("video_id").alias("video_count"),
        F.round(F.avg("view_count"), 0).alias("avg_views"),
        approx_median("view_count").alias("median_views"),
        F.max("view_count").alias("max_views"),
        F.sum("like_count").alias("total_likes"),
        F.sum("comment_count").alias("total_comments"),
    )


def keyword_peak_volume(trends: DataFrame) -> DataFrame:
    """Peak search volume per (case-sensitive) query."""
    return trends.groupBy("query").agg(F.max("search_volume").alias("search_volume"))


def join_on_folded(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> DataFrame:
    """Inner join on lower-cased keys; both sides should already be one row per raw key."""
    fa = a.withColumn("_fold", F.lower(F.col(a_key)))
    fb = b.withColumn("_fold", F.lower(F.col(b_key)))
    return fa.join(fb, "_fold", "inner").drop("_fold")


def mart_gap_analysis(videos: DataFrame, trends: DataFrame, as_of: dt.datetime,
                      sort: bool = False) -> DataFrame:
    """Search demand against video supply per keyword.

    Both sides are aggregated before the join, so the join sees one row per
    distinct keyword on each side.
    """
    joined = join_on_folded(keyword_supply(videos), "keyword", keyword_peak_volume(trends), "query")
    score = gap_score("search_volume", "median_views")
    out = joined.select(
        "keyword", "search_volume", "video_count", "median_views", "avg_views", "max_views",
        "total_likes", "total_comments",
        score.alias("gap_score"),
        opportunity(score).alias("opportunity"),
        ntz_literal(as_of).alias("collected_at"),
    )
    return out.orderBy(F.col("gap_score").desc_nulls_last()) if sort else out
