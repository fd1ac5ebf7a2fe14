"""Joins: dimension lookups, null-safe anti-join, stats attachment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast import constants as K


def lookup(df: DataFrame, dim: DataFrame, on: str | list[str], value: str, out: str | None = None,
           dim_key: str | list[str] | None = None, default: str = K.UNKNOWN) -> DataFrame:
    """Left join a key -> value dimension; missing keys get ``default``.

    ``dim`` must be unique on its key (a mapping; several columns may form it).
    The dimension's key is renamed so the input keeps its own columns. No hint
    is given: the planner broadcasts the dimension where its bytes are under
    ``spark.sql.autoBroadcastJoinThreshold``, and AQE decides anew at run time.
    """
    on = [on] if isinstance(on, str) else on
    dim_key = on if dim_key is None else [dim_key] if isinstance(dim_key, str) else dim_key
    out = out or value
    right = dim.select(*[F.col(k).alias(f"_lk_{i}") for i, k in enumerate(dim_key)], F.col(value).alias("_lk_val"))
    cond = [F.col(c) == F.col(f"_lk_{i}") for i, c in enumerate(on)]
    joined = df.join(right, cond, "left")
    return (joined.withColumn(out, F.coalesce(F.col("_lk_val"), F.lit(default)))
            .drop("_lk_val", *[f"_lk_{i}" for i in range(len(on))]))


def not_yet_present(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose keys do not occur in ``existing``; NULL keys match NULL keys.

    ``existing`` is reduced to distinct keys first (partial aggregation), so a
    hot key costs one row on the build side; AQE splits a skewed streamed side.
    """
    right = existing.select(*[F.col(k).alias(f"_ex_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_ex_{k}"))
        cond = c if cond is None else cond & c
    return df.join(right, cond, "left_anti")


def attach_stats(hits: DataFrame, stats: DataFrame, on: str = "video_id") -> DataFrame:
    """Search hits joined to per-id details; ids without details drop out (inner join)."""
    return hits.join(stats, on, "inner")


def semi_on_folded(df: DataFrame, key: str, keys: DataFrame, keys_col: str) -> DataFrame:
    """Rows of ``df`` whose lower-cased ``key`` appears among lower-cased ``keys_col``."""
    right = keys.select(F.lower(F.col(keys_col)).alias("_fold_k")).distinct()
    return df.join(right, F.lower(F.col(key)) == F.col("_fold_k"), "left_semi")
