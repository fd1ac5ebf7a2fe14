"""Operator 9: language identification by nearest centroid.

A text becomes a vector of hashed character 1- to 3-grams over its letters
(logarithmic counts times inverse document frequency, unit length). Each
language is described by a few centroids, found by spherical k-means over its
training texts; a text takes the language of the centroid with the largest
cosine. A text too far from that centroid for its length is ``rejected``: the
limit of each language and length class lies between what its own texts reach by
centroids that were fitted without them, and what texts of the other languages
reach whose own centroids are left out. Prefixes of the training texts stand for
short ones.

Learning uses every text that has a label: document frequencies, centroids and
limits are found by passes over all their vectors, whose tasks return a sum for
each centroid or a count for each ten-thousandth of the cosine's range.
Prediction reads every whole text and needs no shuffle: the model is
broadcast, ``languages x centroids x DIMS`` floats.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast.llm import sparse_vectors
from trendcast.llm.common import discard, document_stage, materialize, table

UNKNOWN = "und"
DIMS = 4096
CENTROIDS = 4
ROUNDS = 12
MAX_LANGUAGES = 1000
# Rejection: of the gap between the cosine that 90 % of the strange texts of about the same
# length do not reach and the one that 99 % of a language's own reach, the limit is this part
# up; without a gap, the latter (neighbouring length classes join until there are LENGTH_LEAST texts).
REJECT_QUANTILE = 0.01
STRANGE_QUANTILE = 0.9
GAP_PART = 0.25
LENGTH_LEAST = 50
_STEPS = 10_000   # of a cosine from 0 to 1, for the quantiles
_CHUNK = 1 << 20
_BATCH = 128
_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """True for each code point that is a letter; built once in a worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed letter 1- to 3-grams of a whole text; None without a letter.

    Runs of other characters count as one blank. Long texts go through in
    chunks, so memory stays bounded.
    """
    if not text:
        return None
    letter, counts, tail = letter_table(), np.zeros(DIMS, dtype=np.int64), np.array([32], dtype=np.uint32)
    seen = False
    for at in range(0, len(text), _CHUNK):
        cp = np.frombuffer(text[at:at + _CHUNK].lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        is_letter = letter[cp]
        seen = seen or bool(is_letter.any())
        # Of each run of other characters only the first stays, as a blank.
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        keep[0] |= bool(tail[-1] != 32)
        s = np.concatenate([tail, np.where(is_letter, cp, 32).astype(np.uint32)[keep]])
        counts += _hash_grams(s, len(tail))
        tail = s[-2:]
    if not seen:
        return None
    if tail[-1] != 32:
        counts += _hash_grams(np.concatenate([tail, np.array([32], dtype=np.uint32)]), len(tail))
    return counts


def _hash_grams(s: np.ndarray, old: int) -> np.ndarray:
    """Grams that end after the first ``old`` characters of ``s``."""
    shift = np.uint32(32 - (DIMS.bit_length() - 1))
    one = s * _PRIMES[0]
    two = (s[:-1] * _PRIMES[1]) ^ one[1:]
    three = (s[:-2] * _PRIMES[2] + (s[1:-1] * _PRIMES[1])) ^ one[2:] if len(s) > 2 else s[:0]
    spread = np.uint32(0x27D4EB2F)
    parts = [one[old:][s[old:] != 32], two[max(0, old - 1):] * spread, three[max(0, old - 2):] * np.uint32(0x165667B1)]
    h = np.concatenate(parts)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return np.bincount(h >> shift, minlength=DIMS)


def _length_class(total: np.ndarray) -> np.ndarray:
    return np.minimum(15, np.log2(np.maximum(total, 1))).astype(np.int64)


@dataclass
class LanguageModel:
    languages: list[str]          # of each centroid
    centroids: np.ndarray         # unit rows, centroids x DIMS
    idf: np.ndarray
    reject_below: np.ndarray      # cosine limit by centroid and length class

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.log1p(counts).astype(np.float32) * self.idf)

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        lang, score, reject = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        values = texts.tolist()
        for at in range(0, len(values), _BATCH):
            rows, counts = [], []
            for i in range(at, min(at + _BATCH, len(values))):
                c = gram_counts(values[i])
                if c is not None:
                    rows.append(i)
                    counts.append(c)
            if not rows or not self.languages:
                continue
            x = np.stack(counts)
            cosine = self.vectors(x) @ self.centroids.T
            best = cosine.argmax(axis=1)
            top = np.clip(cosine[np.arange(len(rows)), best], 0, 1)
            low = top < self.reject_below[best, _length_class(x.sum(axis=1))]
            for k, i in enumerate(rows):
                lang[i], score[i], reject[i] = self.languages[best[k]], float(top[k]), bool(low[k])
        return pd.DataFrame({"lang_pred": lang, "score": score, "rejected": reject})


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def held_out(id_col: str = "doc_id"):
    """True for the fifth of the ids that learning never reads (crc32 of the id as text)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_per_language: int | None = None, centroids: int = CENTROIDS) -> LanguageModel:
    """Fit the model on the rows of ``labelled`` that have a language and a letter.

    All of them are learned from, unless a caller asks for a sample of about
    ``sample_per_language`` rows of each language. Of more than ``MAX_LANGUAGES``
    label values the most frequent are learned (ties: smallest); texts with the
    others are predicted like any text. No usable row: an empty model, which
    answers ``und`` for everything.
    """
    usable = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = usable.groupBy(F.col(lang_col).alias("_l")).agg(F.count(F.lit(1)).alias("_n")).orderBy(
        F.desc("_n"), "_l").limit(MAX_LANGUAGES).collect()
    if not sizes:
        return LanguageModel([], np.zeros((0, DIMS), np.float32), np.ones(DIMS, np.float32), np.zeros((0, 16)))
    names = sorted(r["_l"] for r in sizes)
    code = {name: i for i, name in enumerate(names)}
    learned = usable.filter(F.col(lang_col).isin(names))
    if sample_per_language is not None:
        share = F.create_map(*[F.lit(v) for r in sizes for v in (r["_l"], min(1.0, sample_per_language / r["_n"]))])
        dice = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)) / float(1 << 30)
        learned = learned.filter(dice < share[F.col(lang_col)])

    def to_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for lang, text in zip(b["lang"], b["text"], strict=True):
                dice = zlib.crc32(text.encode("utf-8", "replace"))
                short = text[:4 << (dice >> 1) % 10]
                for part in (text, short) if len(short) < len(text) else (text,):
                    c = gram_counts(part)
                    if c is not None:
                        rows.append((code[lang], part is text, dice & 1, *sparse_vectors.packed(c)))
            yield pd.DataFrame(rows, columns=["code", "whole", "fold", "cells", "n"])

    texts = learned.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    parts = materialize(texts.mapInPandas(to_counts, "code int, whole boolean, fold int, cells binary, n binary"), "language_vectors")
    whole = parts.filter("whole")
    n, weights = sparse_vectors.inverse_frequencies(whole, DIMS)
    idf = weights.astype(np.float32)
    centres, rows = _centres(whole, idf, centroids) if n else ({}, {})
    found = sorted(c for c in range(len(names)) if 3 * c in centres)
    if not found:
        discard(parts)
        return LanguageModel([], np.zeros((0, DIMS), np.float32), idf, np.zeros((0, 16)))
    # Each half is measured by centroids of the other half, if that has enough texts.
    measure = {(c, fold): centres[other if rows.get(other := 3 * c + 2 - fold, 0) > centroids else 3 * c] for c in found for fold in (0, 1)}
    owner = np.concatenate([np.full(len(centres[3 * c]), c) for c in found])
    every = np.concatenate([centres[3 * c] for c in found])
    low, strange = _quantiles(parts.filter(F.col("code").isin(found)), idf, measure, owner, every)
    discard(parts)
    limits = {c: _limits(low[c], strange.get(c)) for c in found}
    return LanguageModel([names[c] for c in owner], every, idf, np.array([limits[c] for c in owner]))


# Of each language three sets of centroids are fitted, at the places 3 * code and on: to all its texts, and to either half.
def _nearest(part: sparse_vectors.Vectors, x: np.ndarray, places: np.ndarray, centres: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: the nearest centroid at its place, and the cosine; 0 where there is none."""
    best, top = np.zeros(part.size, dtype=np.int64), np.zeros(part.size)
    for place in np.unique(places):
        if (own := centres.get(int(place))) is not None:
            at = np.flatnonzero(places == place)
            cosine = np.round(x[at] @ own.T, 6)
            best[at] = cosine.argmax(axis=1)
            top[at] = cosine[np.arange(len(at)), best[at]]
    return best, top


def _places(part: sparse_vectors.Vectors) -> tuple[np.ndarray, np.ndarray]:
    code, fold = part.table["code"].to_numpy(np.int64), part.table["fold"].to_numpy(np.int64)
    return 3 * code, 3 * code + 1 + fold


def _centres(whole: DataFrame, idf: np.ndarray, k: int) -> tuple[dict[int, np.ndarray], dict[int, int]]:
    """Spherical k-means at each place, over all its rows, and how many those are.

    The first centroids are spread out greedily from the mean.
    """
    def sums(centres: dict[int, np.ndarray]) -> dict[int, tuple[int, np.ndarray]]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            into: dict[int, tuple[int, np.ndarray]] = {}
            for part in sparse_vectors.chunks(batches, idf):
                x = part.dense()
                for places in _places(part):
                    part.add(places * k + _nearest(part, x, places, centres)[0], into)
            yield sparse_vectors.partial_sums(into)

        return sparse_vectors.added_up(whole.mapInPandas(run, sparse_vectors.PARTIAL))

    def farthest(centres: dict[int, np.ndarray]) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            least: dict[int, tuple] = {}
            for part in sparse_vectors.chunks(batches, idf):
                x = part.dense()
                for places in _places(part):
                    top = _nearest(part, x, places, centres)[1]
                    for row in zip(places.tolist(), top.tolist(), part.table["cells"], part.table["n"], strict=True):
                        if row[0] not in least or row[1:] < least[row[0]]:
                            least[row[0]] = row[1:]
            yield pd.DataFrame([(p, *row) for p, row in least.items()], columns=["place", "top", "cells", "n"])

        return whole.mapInPandas(run, "place bigint, top double, cells binary, n binary").groupBy("place").agg(
            F.min(F.struct("top", "cells", "n")).alias("far"))

    first = sums({})
    rows = {slot // k: n for slot, (n, _) in first.items()}
    centres = {slot // k: unit(row[None, :]).astype(np.float32) for slot, (_, row) in first.items()}
    for size in range(1, min(k, max(rows.values()))):
        for r in farthest(centres).collect():
            if rows[r["place"]] > size:
                new = sparse_vectors.one_row(r["far"]["cells"], r["far"]["n"], idf)
                centres[r["place"]] = np.vstack([centres[r["place"]], new])
    before = None
    for _ in range(ROUNDS):
        now = sums(centres)
        if before is not None and now.keys() == before.keys() and all((now[s][1] == before[s][1]).all() for s in now):
            break
        centres, before = {place: c.copy() for place, c in centres.items()}, now
        for slot, (_, row) in now.items():
            centres[slot // k][slot % k] = unit(row[None, :])[0]
    return centres, rows


def _quantiles(parts: DataFrame, idf: np.ndarray, measure: dict[tuple[int, int], np.ndarray], owner: np.ndarray,
               every: np.ndarray) -> tuple[dict[int, list[float]], dict[int, list[float]]]:
    """By language and length class: the low quantile of the cosines that its own texts reach, and the high one of
    those of texts that it is nearest to with their own language left out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = []
            for part in sparse_vectors.chunks(iter([b]), idf):
                x, k = part.dense(), _length_class(part.totals())
                code, fold = part.table["code"].to_numpy(np.int64), part.table["fold"].to_numpy(np.int64)
                own = _nearest(part, x, 2 * code + fold, {2 * c + f: v for (c, f), v in measure.items()})[1]
                found.append(pd.DataFrame({"own": True, "code": code, "k": k, "step": np.round(own * _STEPS).astype(np.int64)}))
                cosine = x @ every.T
                cosine[code[:, None] == owner[None, :]] = -1
                best = cosine.argmax(axis=1)
                top = cosine[np.arange(part.size), best]
                other = pd.DataFrame({"own": False, "code": owner[best], "k": k, "step": np.round(top * _STEPS).astype(np.int64)})
                found.append(other[top >= 0])
            yield pd.concat(found).value_counts(sort=False).rename("rows").reset_index() if found else pd.DataFrame(
                columns=["own", "code", "k", "step", "rows"])

    def quantiles(group: pd.DataFrame) -> pd.DataFrame:
        q = REJECT_QUANTILE if group["own"].iloc[0] else STRANGE_QUANTILE
        steps, lengths, rows = (group[c].to_numpy(np.int64) for c in ("step", "k", "rows"))
        return pd.DataFrame({"own": [group["own"].iloc[0]], "code": [group["code"].iloc[0]],
                             "limits": [[_quantile(steps / _STEPS, lengths, rows, k, q) for k in range(16)]]})

    counted = parts.mapInPandas(run, "own boolean, code bigint, k bigint, step bigint, rows bigint").groupBy(
        "own", "code", "k", "step").agg(F.sum("rows").alias("rows"))
    got = counted.groupBy("own", "code").applyInPandas(quantiles, "own boolean, code bigint, limits array<double>").collect()
    return {r["code"]: r["limits"] for r in got if r["own"]}, {r["code"]: r["limits"] for r in got if not r["own"]}


def _quantile(cosines: np.ndarray, lengths: np.ndarray, rows: np.ndarray, k: int, q: float) -> float:
    """A quantile of the cosines, each as often as ``rows`` says, of length class k and as many neighbouring classes as needed."""
    for reach in range(16):
        near = np.abs(lengths - k) <= reach
        if rows[near].sum() >= LENGTH_LEAST:
            break
    order = np.argsort(cosines[near], kind="stable")
    value, upto = cosines[near][order], np.cumsum(rows[near][order])
    at = q * (upto[-1] - 1)
    low, high = (value[np.searchsorted(upto, i, side="right")] for i in (np.floor(at), np.ceil(at)))
    return float(low + (high - low) * (at - np.floor(at)))


def _limits(low: list[float], high: list[float] | None) -> np.ndarray:
    """A language's cosine limit by length class: between the strange texts and its own, never above the latter."""
    known, strange = np.array(low), np.zeros(16) if high is None else np.array(high)
    return np.minimum(known, strange + GAP_PART * (known - strange))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``language`` (lang_pred, score, rejected).

    A null text or one without a letter is ``und`` with score 0, rejected. Other
    texts always get a learned language; ``rejected`` tells that it is too far
    away. Only the text is read by the prediction. Columns named ``language``
    are replaced.
    """
    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield model.predict(texts)

    predict = predict.asNondeterministic()  # else a filter on it would run it again, in a Python worker more a task
    return docs.withColumn("language", predict(F.col(text_col)))


def op9_language_id(spark, sf_dir):
    """Every document's predicted language; learned from the rows whose id's checksum is not divisible by 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~held_out()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score", "language.rejected")


@document_stage
def keep_identified(spark, docs, sf_dir):
    """Pipeline stage: documents with a language that the model knows; the rest go.

    A document without a label gets the predicted one; given labels stay.
    """
    model = train(docs.filter(~held_out()))
    found = identify(docs, model)
    lang = F.coalesce("lang", "language.lang_pred").alias("lang")
    return found.filter(~F.col("language.rejected")).select(*[lang if c == "lang" else c for c in docs.columns])
