"""Operator 10: mixing sources to target weights by iterative proportional fitting.

Tokens are summed by (source, language, topic) cell, in one aggregation that
combines on the map side. Raking then scales the cell weights to each marginal
in turn until all three are met, within what a cell has to give. A sample of
``budget`` of all tokens takes from each cell its weight's part; that over the
cell's tokens is the probability of its documents, and a document is taken when
a hash of its id falls below it: the same rows on every run, no shuffle.

A dimension's targets are given by the caller, or derived from the observed
token sums (:func:`derived_targets`). Its categories are those with a target, and
``OTHER`` for the rest, so there are at most the product of the targets' sizes
plus one cells, however large the input: the only thing the driver sees or
broadcasts. Topics are learned from all texts (``llm/topics.py``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendcast.llm import topics
from trendcast.llm.common import document_stage, materialize, table, text_or_empty

OTHER = "(other)"
ROUNDS = 200
TOLERANCE = 1e-10
BUDGET = 0.5

# Derived targets: shares in proportion to a power of what a category has, so that
# large ones give way to small ones; for the categories with the most tokens.
POWER = 0.5
MOST_CATEGORIES = 1000
# Target shares of tokens by language; what is not listed keeps the share that it has.
LANGUAGE_TARGETS = {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11}


def tokens() -> Column:
    """Words of ``text``: runs without white space."""
    return F.regexp_count(text_or_empty("text"), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


@dataclass(frozen=True)
class Marginal:
    """A dimension: its name, its expression and the wanted token shares by category (None: derived from the input)."""
    name: str
    column: Column
    targets: Mapping[str, float] | None = None


def category(value: Column, targets: Mapping[str, float]) -> Column:
    return F.when(value.isin(list(targets)), value).otherwise(F.lit(OTHER))


def default_marginals(docs: DataFrame, id_col: str = "doc_id") -> list[Marginal]:
    """Sources and learned topics with derived targets, languages with the given ones."""
    return [Marginal("source", F.col("source")), Marginal("lang", F.col("lang"), LANGUAGE_TARGETS),
            Marginal("topic", topics.fit(docs, id_col).topic())]


def derived_targets(sums: DataFrame, name: str, power: float = POWER, most: int = MOST_CATEGORIES) -> dict[str, float]:
    """Targets of the ``most`` categories with the most tokens (ties: smallest name): their tokens to the power.

    ``sums`` holds tokens by category. Power 1 leaves the shares as they are, 0
    makes them equal. The other categories count as ``OTHER``.
    """
    top = (sums.groupBy(name).agg(F.sum("tokens").alias("tokens")).filter(F.col(name).isNotNull() & (F.col(name) != OTHER) & (F.col("tokens") > 0))
           .orderBy(F.desc("tokens"), name).limit(most).collect())
    return {r[name]: float(r["tokens"]) ** power for r in top}


def wanted_shares(observed: Mapping[str, float], targets: Mapping[str, float]) -> dict[str, float]:
    """Target share of each category that has tokens.

    Listed categories share, in proportion to their targets, what the others
    leave; a listed category without tokens drops out.
    """
    total = sum(observed.values())
    listed = {k: targets.get(k, 0.0) for k, v in observed.items() if v > 0 and k != OTHER}
    rest = observed.get(OTHER, 0.0) / total if total else 0.0
    scale = sum(listed.values())
    out = {k: v / scale * (1 - rest) for k, v in listed.items()} if scale else {}
    if OTHER in observed:
        out[OTHER] = rest if scale else 1.0
    return out


def rake(cells: np.ndarray, keys: list[np.ndarray], shares: list[np.ndarray], budget: float = BUDGET,
         rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> np.ndarray:
    """Cell weights (sum 1) that meet each dimension's shares, from ``cells`` by proportional fitting.

    ``keys[d]`` gives a cell's category in dimension d, ``shares[d]`` the shares.
    No cell is asked for more tokens than it has: a weight stays within the
    cell's share of the input over ``budget``, and the other cells make up for
    it in the next round. Targets that the cells can't meet are met as nearly
    as these limits allow.
    """
    start = cells / cells.sum()
    most = start / min(1.0, budget)
    w = start
    for _ in range(rounds):
        before = w
        for key, share in zip(keys, shares, strict=True):
            have = np.bincount(key, weights=w, minlength=len(share))
            w = w * np.divide(share, have, out=np.zeros_like(share), where=have > 0)[key]
        w = np.minimum(w, most)
        if float(np.abs(w - before).max()) < tolerance:
            break
    return w / w.sum()


def probabilities(cells: np.ndarray, weights: np.ndarray, budget: float) -> np.ndarray:
    """Of each cell: the chance that gives it ``weights`` of ``budget`` of all tokens, at most 1."""
    wanted = weights * min(1.0, budget) * cells.sum()
    return np.minimum(1.0, np.divide(wanted, cells, out=np.zeros_like(weights), where=cells > 0))


def uniform(id_col: str = "doc_id", seed: int = 0) -> Column:
    """A number in [0, 1) from the id: 52 bits of an MD5, the same on any engine."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint").cast("double") / float(1 << 52)


def mix(docs: DataFrame, marginals: list[Marginal] | None = None, weight: Column | None = None,
        budget: float = BUDGET, id_col: str = "doc_id", seed: int = 0, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct column ``mix``: a category per dimension, tokens, weight, probability, sampled.

    Without ``marginals`` those of :func:`default_marginals` hold. ``keep`` names
    the columns to return, the id's among them, if not all are wanted.

    ``weight`` is the share of all tokens that the raked mixture gives the
    document's cell. Null categories and categories without a target count as
    ``OTHER``, which keeps its share. Documents without tokens belong to their
    cell like any other; a cell without tokens has probability 1, as it changes
    no share. Rows with equal ids are taken or left together. An empty table
    stays empty. A column named ``mix`` is replaced.
    """
    marginals = marginals or default_marginals(docs, id_col)
    weight = tokens() if weight is None else weight
    names = [m.name for m in marginals]
    # The values are in a struct of their own first, so that each is computed once a row.
    values = F.struct(*[m.column.cast("string").alias(m.name) for m in marginals], weight.alias("tokens"))
    # They are written once: sums and places need the same ones, and a topic costs a pass over the text.
    kept = [c for c in keep or docs.columns if c != "mix"]
    valued = materialize(docs.drop("mix").withColumn("mix", values).select(*kept, "mix"), "mixing_rows")
    sums = materialize(valued.select("mix.*").groupBy(*names).agg(F.sum("tokens").alias("tokens")), "mixing_cells")
    targets = [derived_targets(sums, m.name) if m.targets is None else m.targets for m in marginals]
    merged = sums.select(*[category(F.col(n), t).alias(n) for n, t in zip(names, targets, strict=True)], "tokens").groupBy(
        *names).agg(F.sum("tokens").alias("tokens")).collect()
    rows = [(tuple(r[n] for n in names), float(r["tokens"] or 0)) for r in sorted(merged, key=lambda r: [r[n] for n in names])]
    fitted = _fit([r for r in rows if r[1] > 0], targets, budget)
    # As an Arrow table the cells need no Python workers, which rows would, of a kind of their own that stays in memory.
    columns = {f"_{i}": pa.array([cell[i] for cell, _ in rows], pa.string()) for i in range(len(names))}
    facts = [fitted.get(cell, (0.0, 1.0)) for cell, _ in rows]
    columns |= {name: pa.array([fact[i] for fact in facts], pa.float64()) for i, name in enumerate(("weight", "probability"))}
    cells = docs.sparkSession.createDataFrame(pa.table(columns))

    placed = [category(F.col(f"mix.{n}"), t).alias(n) for n, t in zip(names, targets, strict=True)]
    out = valued.withColumn("mix", F.struct(*placed, F.col("mix.tokens").alias("tokens")))
    on = [F.col(f"mix.{n}") == cells[f"_{i}"] for i, n in enumerate(names)]
    joined = out.join(F.broadcast(cells), on, "left")
    chosen = F.struct("mix.*", cells["weight"].alias("weight"), cells["probability"].alias("probability"),
                      (uniform(id_col, seed) < cells["probability"]).alias("sampled"))
    return joined.select(*[out[c] for c in kept], chosen.alias("mix"))


def _fit(rows: list[tuple[tuple, float]], targets: list[Mapping[str, float]], budget: float) -> dict[tuple, tuple[float, float]]:
    if not rows:
        return {}
    cells, keys, shares = np.array([t for _, t in rows]), [], []
    for d, wanted in enumerate(targets):
        observed: dict[str, float] = {}
        for cell, t in rows:
            observed[cell[d]] = observed.get(cell[d], 0.0) + t
        order = sorted(observed)
        place = {k: i for i, k in enumerate(order)}
        want = wanted_shares(observed, wanted)
        keys.append(np.array([place[cell[d]] for cell, _ in rows]))
        shares.append(np.array([want.get(k, 0.0) for k in order]))
    w = rake(cells, keys, shares, budget)
    p = probabilities(cells, w, budget)
    return {cell: (float(w[i]), float(p[i])) for i, (cell, _) in enumerate(rows)}


def op10_source_mixing(spark, sf_dir):
    """Every document's cell, its weight and probability in the mixture, and whether it is sampled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs, keep=["doc_id"]).select("doc_id", "mix.*")


@document_stage
def sampled(spark, docs, sf_dir):
    """Pipeline stage: the documents that the mixture takes."""
    return mix(docs).filter("mix.sampled").select(*docs.columns)
