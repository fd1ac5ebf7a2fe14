"""Sparse count vectors of texts, and sums of them by cluster: a helper of the language and topic models.

A vector travels as a bit for each cell that counts (``cells``) and those counts
in order (``n``). Passes over all vectors return partial sums of each task; their
parts are whole numbers, so that a sum does not depend on how rows are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = float(1 << 20)
_BATCH = 128
_LOGS = np.log1p(np.arange(256, dtype=np.float32))


def packed(counts: np.ndarray) -> tuple[bytes, bytes]:
    """``cells`` and ``n`` of a vector that isn't zero."""
    n = counts[counts > 0]
    return np.packbits(counts > 0).tobytes(), n.astype(np.uint8 if n.max() < 256 else np.int64).tobytes()


class Vectors:
    """Some packed vectors: the row, cell and count of each entry, and its weighted value in rows of unit length."""

    def __init__(self, rows: pd.DataFrame, weights: np.ndarray):
        self.table, self.dims, self.size = rows, len(weights), len(rows)
        bits = np.frombuffer(b"".join(rows["cells"]), np.uint8)
        self.entries = entries = np.flatnonzero(np.unpackbits(bits).view(bool))
        # There is a power of two of cells.
        self.rows, self.cols = entries >> (self.dims.bit_length() - 1), entries & (self.dims - 1)
        joined = b"".join(rows["n"])
        if len(joined) == len(entries):
            self.n = np.frombuffer(joined, np.uint8)
            v = _LOGS[self.n]
        else:
            sizes = np.bincount(self.rows, minlength=self.size)
            self.n = np.concatenate([np.frombuffer(b, np.uint8 if len(b) == k else np.int64) for b, k in zip(rows["n"], sizes, strict=True)])
            v = np.log1p(self.n.astype(np.float32))
        v = v * weights.astype(np.float32)[self.cols]
        norm = np.sqrt(np.bincount(self.rows, v * v, minlength=self.size)).astype(np.float32)
        self.values = v / norm[self.rows]

    def dense(self) -> np.ndarray:
        x = np.zeros(self.size * self.dims, dtype=np.float32)
        x[self.entries] = self.values
        return x.reshape(self.size, self.dims)

    def totals(self) -> np.ndarray:
        return np.bincount(self.rows, self.n, minlength=self.size)

    def add(self, slots: np.ndarray, into: dict[int, tuple[int, np.ndarray]]) -> None:
        """Add each row's values to the sum of its slot."""
        taken, place, many = np.unique(slots, return_inverse=True, return_counts=True)
        sums = np.bincount(self.entries + ((place - np.arange(self.size)) * self.dims)[self.rows], np.round(self.values * SCALE), minlength=len(taken) * self.dims)
        for slot, n, row in zip(taken.tolist(), many.tolist(), sums.reshape(len(taken), self.dims), strict=True):
            had = into.get(slot)
            into[slot] = (n, row) if had is None else (had[0] + n, had[1] + row)


def chunks(batches: Iterator[pd.DataFrame], weights: np.ndarray) -> Iterator[Vectors]:
    for b in batches:
        for at in range(0, len(b), _BATCH):
            yield Vectors(b.iloc[at:at + _BATCH], weights)


def partial_sums(into: dict[int, tuple[int, np.ndarray]]) -> pd.DataFrame:
    return pd.DataFrame([(s, n, row.tobytes()) for s, (n, row) in into.items()], columns=["slot", "rows", "sums"])


PARTIAL = "slot bigint, rows bigint, sums binary"


def added_up(partial: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Rows and sum of each slot over the parts of all tasks."""
    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(group["sums"].iloc[0]) // 8)
        for part in group["sums"]:
            total += np.frombuffer(part)
        return pd.DataFrame({"slot": [group["slot"].iloc[0]], "rows": [group["rows"].sum()], "sums": [total.tobytes()]})

    return {r["slot"]: (r["rows"], np.frombuffer(r["sums"])) for r in partial.groupBy("slot").applyInPandas(add, PARTIAL).collect()}


def inverse_frequencies(vectors: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """How many vectors there are, and the inverse document frequency of each cell."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(dims, dtype=np.int64), 0
        for b in batches:
            for cells in b["cells"]:
                df += np.unpackbits(np.frombuffer(cells, np.uint8))
                n += 1
        if n:
            yield pd.DataFrame({"cell": np.arange(-1, dims), "df": np.concatenate([[n], df])})

    found = {r["cell"]: r["s"] for r in vectors.select("cells").mapInPandas(count, "cell int, df bigint")
             .groupBy("cell").agg(F.sum("df").alias("s")).collect()}
    n = found.get(-1, 0)
    return n, np.log((1 + n) / (1 + np.array([found.get(i, 0) for i in range(dims)]))) + 1


def one_row(cells: bytes, n: bytes, weights: np.ndarray) -> np.ndarray:
    return Vectors(pd.DataFrame({"cells": [cells], "n": [n]}), weights).dense()
