"""Dashboard tables: top cards per category, leaderboard, hour heatmap, weekly growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendcast import constants as K
from trendcast.operators.ranking import leaderboard as _leaderboard
from trendcast.operators.ranking import top_n_per_group
from trendcast.plans.marts import rank_order, scored_topics


def top_n_per_category(stg: DataFrame, n: int = K.TOP_PER_CATEGORY) -> DataFrame:
    """Best ``n`` scored trends per category, with their rank.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit, so a hot
    category contributes at most ``n`` rows per map task to the shuffle.
    """
    return top_n_per_group(scored_topics(stg), ["categories"], rank_order(), n,
                           rank_col="rank_in_category")


def leaderboard(stg: DataFrame, n: int = 20) -> DataFrame:
    """Global top ``n`` by score (TakeOrderedAndProject, no full sort)."""
    return _leaderboard(scored_topics(stg), rank_order() + [F.col("categories").asc_nulls_first()], n)


def category_hour_heatmap(stg: DataFrame) -> DataFrame:
    """Category x local start hour counts, one column per hour (h00..h23), one pass."""
    return stg.groupBy("categories").agg(
        *[F.count_if(F.col("start_hour_eat") == h).alias(f"h{h:02d}") for h in range(24)])


def category_wow_growth(stg: DataFrame) -> DataFrame:
    """Weekly keyword count and volume per category and the change against the week before.

    A category without trends in the calendar week before has no growth (NULL).
    The window runs over the weekly aggregate (a handful of rows per category).
    """
    weekly = (stg.withColumn("week_start", F.date_trunc("week", F.col("trend_date")).cast("date"))
              .groupBy("categories", "week_start")
              .agg(F.count(F.lit(1)).alias("keywords"),
                   F.sum("search_volume").alias("total_search_volume")))
    w = Window.partitionBy("categories").orderBy("week_start")
    is_next = F.lag("week_start").over(w) == F.date_sub("week_start", 7)
    prev = F.when(is_next, F.lag("total_search_volume").over(w))
    return weekly.withColumns({
        "prev_search_volume": prev,
        "volume_growth_pct": F.round(
            F.try_divide((F.col("total_search_volume") - prev).cast("double") * F.lit(100.0),
                         prev.cast("double")), 1),
    })
