"""Topics of texts, learned from the corpus itself: a helper of the mixing operator.

A text becomes a vector of hashed words (runs of letters, lower case;
logarithmic counts times the model's word weights, unit length). Spherical
k-means over the distinct vectors of all texts finds ``TOPICS`` directions; a
text's topic is the nearest one by cosine. Topics are named ``t0``, ``t1``, ...
by falling size.

Every text takes part in the word weights, the start, the directions and the
sizes: each round of k-means is a pass over all vectors whose tasks return a sum
for each topic. The start is drawn from all vectors by their distance to those
drawn before (k-means||); the driver sees the drawn ones and the sums only.
Prediction reads every whole text, needs no shuffle and broadcasts
``TOPICS x DIMS`` numbers.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendcast.llm import sparse_vectors
from trendcast.llm.common import discard, materialize
from trendcast.llm.language_id import letter_table, unit

TOPICS = 8
ROUNDS = 12
# The start: so many draws of so many vectors a topic, of which the best of some runs of k-means is taken.
DRAWS, DRAWN_A_TOPIC = 3, 4
STARTS = 4
DIMS = 2048
_CHUNK = 1 << 18
_BATCH = 128
_POWERS = np.cumprod(np.full(64, 0x01000193, dtype=np.uint32), dtype=np.uint32)


def word_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed words of a whole text; None without a letter.

    Long texts go through in chunks that end at white space, so memory stays
    bounded; a word longer than a chunk is cut.
    """
    if not text:
        return None
    counts, seen, at = np.zeros(DIMS, dtype=np.int64), False, 0
    while at < len(text):
        end = at + _CHUNK
        if end < len(text):
            space = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = space + 1 if space >= at else end
        cp = np.frombuffer(text[at:end].lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        at = end
        letter = letter_table()[cp]
        where = np.flatnonzero(letter)
        if not len(where):
            continue
        seen = True
        starts = np.flatnonzero(np.diff(where, prepend=-2) > 1)
        place = np.arange(len(where)) - np.repeat(starts, np.diff(starts, append=len(where)))
        h = np.add.reduceat(cp[where] * _POWERS[place & 63], starts, dtype=np.uint32)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        counts += np.bincount(h >> np.uint32(32 - (DIMS.bit_length() - 1)), minlength=DIMS)
    return counts if seen else None


def _start(x: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """Of ``STARTS`` runs of k-means over the drawn vectors, each of the given size, the centres that fit best."""
    rng, found = np.random.default_rng(0), []
    for _ in range(STARTS):
        centres = x[[rng.choice(len(x), p=size / size.sum())]]
        while len(centres) < min(k, len(x)):
            far = size * np.clip(1 - np.round((x @ centres.T).max(axis=1), 6), 0, None)
            if not far.any():
                break
            centres = np.vstack([centres, x[[rng.choice(len(x), p=far / far.sum())]]])
        for _ in range(ROUNDS):
            own = np.round(x @ centres.T, 6).argmax(axis=1)
            sums = np.stack([(x * size[:, None])[own == j].sum(axis=0) for j in range(len(centres))])
            centres = unit(np.where((sums != 0).any(axis=1)[:, None], sums, centres))
        found.append(centres)
    return max(found, key=lambda c: float(((x @ c.T).max(axis=1) * size).sum()))


@dataclass
class TopicModel:
    centroids: np.ndarray   # unit rows, topics x DIMS
    weights: np.ndarray     # of the hashed words

    @property
    def names(self) -> list[str]:
        return [f"t{i}" for i in range(len(self.centroids))]

    def predict(self, texts: list[str | None]) -> list[str | None]:
        """The topic of each text; None without a letter or without a model."""
        out: list[str | None] = [None] * len(texts)
        for at in range(0, len(texts), _BATCH):
            counted = [(i, c) for i in range(at, min(at + _BATCH, len(texts))) if (c := word_counts(texts[i])) is not None]
            if not counted or not len(self.centroids):
                continue
            x = unit(np.log1p(np.stack([c for _, c in counted])) * self.weights)
            # Rounded, so that the answer does not depend on which texts share a batch.
            for (i, _), best in zip(counted, np.round(x @ self.centroids.T, 6).argmax(axis=1), strict=True):
                out[i] = f"t{best}"
        return out

    def topic(self, text_col: str = "text") -> Column:
        """The topic of a text column."""
        @F.pandas_udf("string")
        def topic_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(self.predict(texts.tolist()), dtype=object)

        return topic_of(F.col(text_col))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", topics: int = TOPICS) -> TopicModel:
    """The model of all texts of ``docs`` (equal vectors count once); without any text that has a letter, a model of no topics."""
    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([sparse_vectors.packed(c) for c in map(word_counts, b["text"]) if c is not None], columns=["cells", "n"])

    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null")
    vectors = materialize(texts.mapInPandas(sparse, "cells binary, n binary").distinct(), "topic_vectors")
    n, weights = sparse_vectors.inverse_frequencies(vectors, DIMS)
    if not n:
        discard(vectors)
        return TopicModel(np.zeros((0, DIMS)), np.ones(DIMS))
    drawn = np.zeros((0, DIMS), np.float32)
    for turn in range(DRAWS):
        found = vectors.mapInPandas(_draw(drawn, weights, topics * DRAWN_A_TOPIC, turn), "place double, cells binary, n binary").orderBy(
            "place", "cells", "n").limit(topics * DRAWN_A_TOPIC).collect()
        drawn = np.vstack([drawn, *[sparse_vectors.one_row(r["cells"], r["n"], weights) for r in found]])
    near = vectors.mapInPandas(_nearest_sums(drawn, weights), sparse_vectors.PARTIAL).groupBy("slot").agg(F.sum("rows").alias("rows")).collect()
    size = np.zeros(len(drawn))
    size[[r["slot"] for r in near]] = [r["rows"] for r in near]
    centres, before = _start(drawn.astype(np.float64), size, topics), None
    for _ in range(ROUNDS):
        sums = sparse_vectors.added_up(vectors.mapInPandas(_nearest_sums(centres.astype(np.float32), weights), sparse_vectors.PARTIAL))
        if before is not None and sums.keys() == before.keys() and all((sums[k][1] == before[k][1]).all() for k in sums):
            break
        centres, before = centres.copy(), sums
        for k, (_, row) in sums.items():
            centres[k] = row / np.linalg.norm(row)
    discard(vectors)
    kept = sorted(sums, key=lambda k: (-sums[k][0], k))
    return TopicModel(centres[kept], weights)


def _draw(drawn: np.ndarray, weights: np.ndarray, most: int, turn: int):
    """The ``most`` vectors with the smallest places of a task: over all tasks, a draw by distance to the drawn ones."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[tuple] = []
        for part in sparse_vectors.chunks(batches, weights):
            far = np.ones(part.size)
            if len(drawn):
                far = np.clip(1 - np.round((part.dense() @ drawn.T).max(axis=1).astype(np.float64), 6), 0, None)
            new = [(-float(np.log((zlib.crc32(c + n, turn) + 0.5) / (1 << 32))) / float(d), c, n)
                   for d, c, n in zip(far, part.table["cells"], part.table["n"], strict=True) if d > 0]
            best = heapq.nsmallest(most, best + new)
        yield pd.DataFrame(best, columns=["place", "cells", "n"])

    return run


def _nearest_sums(centres: np.ndarray, weights: np.ndarray):
    """Rows and sum of the vectors nearest to each centre, by task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        into: dict[int, tuple[int, np.ndarray]] = {}
        for part in sparse_vectors.chunks(batches, weights):
            part.add(np.round(part.dense() @ centres.T, 6).argmax(axis=1), into)
        yield sparse_vectors.partial_sums(into)

    return run
