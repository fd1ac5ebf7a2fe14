"""Aggregate expressions with deterministic results.

All of these are partial-aggregation friendly (map-side combine), so a hot
group never reaches a single task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def domain_counts(col, domain: list, prefix: str) -> list[Column]:
    """One counter per value of a small fixed domain: plain hash aggregation, no map per group."""
    return [F.count_if(_c(col) == F.lit(v)).alias(f"{prefix}{i}") for i, v in enumerate(domain)]


def most_counted(domain: list, prefix: str) -> Column:
    """The value of the largest counter of :func:`domain_counts` (ties -> lowest value; no value -> NULL)."""
    # The first of equal counters wins, so the counters are compared in order of their values.
    order = sorted(range(len(domain)), key=lambda i: domain[i])
    counts = [F.col(f"{prefix}{i}") for i in order]
    largest = F.greatest(*counts)
    picked = F.coalesce(*[F.when(c == largest, F.lit(domain[i])) for c, i in zip(counts, order, strict=True)])
    return F.when(largest > 0, picked)


def counter_names(domain: list, prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(len(domain))]


def approx_median(col, accuracy: int = 10000) -> Column:
    """Approximate median that is an actual value of the group (mergeable sketch)."""
    return F.percentile_approx(_c(col), 0.5, accuracy)
