"""Connected components of a graph that is held as edges in a DataFrame.

Alternating star rounds: the large star links every larger neighbour of a node
to the smallest node it knows, the small star does so for the smaller ones. After
a logarithmic number of rounds every node is linked to the smallest node of its
component alone. Each round is written to the shared folder, so the lineage stays
short and the joins are between plain scans, which AQE splits at hot nodes.

Before each round the edges are dealt into parts of at most about ``ROWS_A_PART``,
and a task replaces those of its part by stars with the same components. Where one
such part is enough for all edges that are left, this is the answer; a round of
shuffles would cost more than that task does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast.llm.common import ROWS_A_PART, materialize

MAX_ROUNDS = 60


def local_labels(u: np.ndarray, v: np.ndarray, count: int) -> np.ndarray:
    """Smallest node of each node's component, for edges (u, v) of nodes 0 .. count - 1."""
    label = np.arange(count)
    while True:
        low, high = np.minimum(label[u], label[v]), np.maximum(label[u], label[v])
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def _stars(edges: DataFrame, parts: int) -> DataFrame:
    """(u, v): edges with the same components; of each of ``parts`` parts every node with the smallest that it reaches there."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [(b["u"].to_numpy(), b["v"].to_numpy()) for b in batches if len(b)]
        if got:
            u, v = (np.concatenate(x) for x in zip(*got, strict=True))
            nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
            label = local_labels(at[:len(u)], at[len(u):], len(nodes))
            other = label != np.arange(len(nodes))
            yield pd.DataFrame({"u": nodes[other], "v": nodes[label[other]]})

    return edges.repartition(parts).mapInPandas(run, "u bigint, v bigint")


def _facts(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame, label: str) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{label}_least")
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, label: str) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialize(down.groupBy("u").agg(F.min("v").alias("m")), f"{label}_least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(edges: DataFrame, label: str = "components", rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v bigint) but each component's smallest node.

    Loops and repeated edges do no harm; no edges give no rows.
    """
    now = materialize(edges.filter("u != v").distinct(), label)
    before = _facts(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        parts = -(-before[0] // rows_a_part)
        now = materialize(_stars(now, parts), label)
        if parts == 1:
            break
        large = materialize(_large_star(now, label), label)
        now = materialize(_small_star(large, label), label)
        after = _facts(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
