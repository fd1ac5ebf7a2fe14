"""Ranking and top-k that survive hot groups.

``Window.partitionBy(g)`` sends every row of a group to one task. When one
group can hold a third of the data, a full per-group numbering has to be split:
``row_number_split`` counts the rows of each (group, leading order values) first
and numbers only the rows that are equal in all of these within one task; what
stands before them comes from running sums over the counts.

Top-k and keep-one (``row_number() <= k``) need no such machinery: Catalyst
plans them with a partial ``WindowGroupLimit`` before the shuffle, so each map
task forwards at most k rows per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_N, _CELL, _COARSE, _FINE, _FIRST, _SECOND = "_rk_n", "_rk_cell", "_rk_coarse", "_rk_fine", "_rk_first", "_rk_second"


def _sort_cols(order_by: list) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal or both-NULL keys; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_rk_r{i}" for i, k in enumerate(keys)})
    cond = [F.col(k).eqNullSafe(F.col(f"_rk_r{i}")) for i, k in enumerate(keys)]
    return left.join(renamed, cond).drop(*[f"_rk_r{i}" for i in range(len(keys))])


def _cell(df: DataFrame, col: str) -> Column:
    """A coarse value that never falls where ``col`` rises, and has far fewer different values.

    Numbers: some 4000 cells for each doubling, so a group's cells are bounded by
    the range of its values; times: the day; strings: the first three characters.
    """
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, T.NumericType):
        x = c.cast("double")
        return F.signum(x) * F.rint(F.log2(F.abs(x) + 1) * 4096)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    if isinstance(kind, T.StringType):
        return F.left(c, F.lit(3))
    return c


def _running(rows: DataFrame, unit: list[str], order: Column, name: str) -> DataFrame:
    """``rows`` with what comes before each of them within its unit."""
    before_me = Window.partitionBy(*unit).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(_N).over(before_me), F.lit(0)))


def _offsets(counts: DataFrame, unit: list[str], lead: str, order: Column, name: str) -> DataFrame:
    """(unit, lead, name): how many rows of a unit come before those with each value of ``lead``.

    Two running sums: over the cells of a unit, each shown by one of its values,
    and over the values of a cell. Neither holds all the values of a large unit.
    """
    per_value = counts.groupBy(*unit, lead).agg(F.sum(_N).alias(_N)).withColumn(_CELL, _cell(counts, lead))
    per_cell = per_value.groupBy(*unit, _CELL).agg(F.max(lead).alias(lead), F.sum(_N).alias(_N))
    cells = _running(per_cell, unit, order, _COARSE).select(*unit, _CELL, _COARSE)
    values = _running(per_value, [*unit, _CELL], order, _FINE).select(*unit, _CELL, lead, _FINE)
    return _join_null_safe(values, cells, [*unit, _CELL]).select(*unit, lead, (F.col(_COARSE) + F.col(_FINE)).alias(name))


def row_number_split(df: DataFrame, partition_by: list[str], order_by: list, name: str,
                     lead: list[str]) -> DataFrame:
    """``row_number() over (partition by .. order by ..)`` without one task per group.

    ``lead`` names the first one or two columns of ``order_by``. A task sorts
    the rows of one (group, lead values); what comes before them is summed up over
    coarse cells of a group, then over the values of a cell, for the first lead
    column and, within one of its values, for the second. So neither a group of
    all different values nor one large tie meets in a single task. The input is
    read twice: once counted, once numbered. Nothing is computed before the
    caller's action and nothing is written. Ties in ``order_by`` are numbered in
    any order; pass a total order for repeatable numbers.
    """
    cols = _sort_cols(order_by)
    both = [*partition_by, *lead]
    # Every step below starts from this shuffled count, which Spark computes once and reuses.
    counts = df.groupBy(*both).agg(F.count(F.lit(1)).alias(_N))
    offsets = _offsets(counts, partition_by, lead[0], cols[0], _FIRST)
    if len(lead) == 1:
        offsets = offsets.withColumn(_SECOND, F.lit(0))
    else:
        within = _offsets(counts, [*partition_by, lead[0]], lead[1], cols[1], _SECOND)
        offsets = _join_null_safe(within, offsets, [*partition_by, lead[0]])
    joined = _join_null_safe(df, offsets, both)
    own = Window.partitionBy(*both).orderBy(*(cols[len(lead):] or [F.lit(0)]))
    rn = F.col(_FIRST) + F.col(_SECOND) + F.row_number().over(own)
    return joined.withColumn(name, rn.cast("bigint")).drop(_FIRST, _SECOND)


def top_n_per_group(df: DataFrame, partition_by: list[str], order_by: list, n: int,
                    rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows of each group; partial limit runs map-side (WindowGroupLimit)."""
    col = rank_col or "_rk_row"
    w = Window.partitionBy(*partition_by).orderBy(*_sort_cols(order_by))
    out = df.withColumn(col, F.row_number().over(w).cast("bigint")).where(F.col(col) <= n)
    return out if rank_col else out.drop(col)


def leaderboard(df: DataFrame, order_by: list, n: int) -> DataFrame:
    """Global top ``n`` (TakeOrderedAndProject: per-partition top n, then merge)."""
    return df.orderBy(*_sort_cols(order_by)).limit(n)
