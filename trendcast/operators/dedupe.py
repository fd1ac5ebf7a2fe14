"""Keyed deduplication with a defined survivor, and duplicate counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendcast.operators.ranking import top_n_per_group


def survivor_order(df: DataFrame, keys: list[str], order: list | None = None) -> list[Column]:
    """Given order first, then every other column ascending: a total order on distinct rows."""
    order = [F.col(c) if isinstance(c, str) else c for c in (order or [])]
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    return order + rest


def keep_one(df: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """One row per key: the first in ``order`` (ties -> lowest remaining columns).

    NULL keys form one group, like pandas ``drop_duplicates``. Planned as
    row_number() = 1 with a partial WindowGroupLimit, so a key holding a third
    of the rows is cut down to one row per map task before the shuffle.
    """
    return top_n_per_group(df, keys, survivor_order(df, keys, order), 1)


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that a keyed dedupe would remove (total rows minus distinct keys)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
    )
