"""Most frequent value and arg-max per group, for unbounded domains.

Both count or reduce (group, value) pairs in a hash aggregate first, which
collapses a hot group to one row per distinct value per map task, and then keep
one row per group with a partial limit before the shuffle. No group is ever
gathered as raw rows, whatever the number of distinct values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast.operators.ranking import top_n_per_group


def top_value_per_group(df: DataFrame, keys: list[str], col: str, out: str | None = None) -> DataFrame:
    """Most frequent non-NULL ``col`` per group (ties -> lowest value) and its count."""
    out = out or f"top_{col}"
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias(out)).agg(
        F.count(F.lit(1)).alias(f"{out}_count"))
    return top_n_per_group(counts, keys, [F.col(f"{out}_count").desc(), F.col(out).asc()], 1)


def arg_max_per_group(df: DataFrame, keys: list[str], value: str, by: str, out: str) -> DataFrame:
    """``value`` of the row with the largest ``by`` per group; NULL ``by`` sorts last, ties -> lowest value.

    ``by`` is compared as it is, so fractions, texts and times keep their order.
    """
    best = df.groupBy(*keys, F.col(value).alias(out)).agg(F.max(by).alias("_am_by"))
    order = [F.col("_am_by").desc_nulls_last(), F.col(out).asc_nulls_first()]
    return top_n_per_group(best, keys, order, 1).drop("_am_by")
