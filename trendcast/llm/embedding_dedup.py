"""Operator 13: near-duplicate embeddings by a random-projection tree forest.

Every tree halves the vectors again and again at the median of their products
with a random direction. Vectors within a band around the median go to both sides
(spill overlap), so near ones are seldom parted; several trees make it unlikely
that all of them part a pair. Vectors are compared within leaves, in blocks, and
linked where their exact cosine reaches the threshold.

*Fitting.* A round splits each node that is too large by a subtree of at most
``LEVELS`` levels, fitted on at most ``SAMPLE`` of its vectors; the node's vectors
are routed through it in chunks. So no task holds a node, and rounds grow with the
logarithm of the input. A node of which a random cut would leave more than half in
the band is a dense ball of near copies: it stays a leaf and is compared in blocks.

*Whole counts without all pairs.* Equal vectors are one class from the start. A
pair of classes that meets in several leaves counts in the one of smallest number
only; every vector carries its leaves, so a block decides that alone. A block
returns a count per vector, and a star instead of its pairs; the stars are united
to components.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendcast.llm.common import materialize, table
from trendcast.llm.components import components

THRESHOLD = 0.95
TREES = 4
LEAF = 512
LEVELS = 10
SAMPLE = 8192
FEW = 16  # a cut is not drawn from fewer sample vectors; such a node waits for the next round's sample
# Half the band is this many standard deviations of how far a random direction parts a pair at the threshold.
SPILL = 0.6
DIRECTIONS = 4
DENSE = 0.5
CHUNK = 4096
BLOCK = 2048


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1. Scaled by a power of two first, so that no square over- or underflows."""
    _, e = np.frexp(np.abs(x).max(axis=1))
    x = np.ldexp(x, -e[:, None])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, each pair by itself: the same two vectors always have the same cosine."""
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None]) for x in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _takes_part(id_col: str, vector_col: str) -> Column:
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(id_col).isNotNull() & F.coalesce(finite & F.exists(vector_col, lambda x: x != 0), F.lit(False))


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v, a, b): rows with an id and a vector that is not null, empty or zero and has only finite components.

    ``a`` and ``b`` are two hashes of the vector, 128 bits that stand for it.
    """
    kept = rows.filter(_takes_part(id_col, vector_col))
    plain = F.transform(vector_col, lambda x: x + F.lit(0).cast(rows.schema[vector_col].dataType.elementType))  # -0 is 0
    one = kept.select(F.col(id_col).cast("bigint").alias("vec_id"), plain.alias("v"))
    return one.withColumns({"a": F.xxhash64("v"), "b": F.xxhash64(F.lit(1), "v")})


def _matrix(vectors: pd.Series, kind: str) -> np.ndarray:
    if isinstance(vectors.iloc[0], bytes):
        return np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    return np.stack(vectors.to_list()).astype(np.float64)


def _number(*parts) -> int:
    return int.from_bytes(hashlib.blake2b(":".join(map(str, parts)).encode(), digest_size=8).digest(), "big", signed=True)


def _direction(seed: int, dim: int) -> np.ndarray:
    d = np.random.default_rng(seed & ((1 << 64) - 1)).standard_normal(dim)
    return d / np.sqrt(d @ d)


class Forest:
    """How to split one kind of tree: sizes, levels, and the width of the band for a threshold."""

    def __init__(self, threshold: float, leaf: int, levels: int, spill: float):
        self.threshold, self.leaf, self.levels, self.spill = threshold, leaf, levels, spill

    def band(self, dim: int) -> float:
        """Half the band: a pair at the threshold lies ``sqrt(2 - 2 threshold)`` apart, any direction sees
        ``1 / sqrt(dim)`` of that as a standard deviation."""
        return self.spill * np.sqrt(max(0.0, 2 - 2 * self.threshold) / dim)

    def fit(self, x: np.ndarray, size: int, node: int, tree: int) -> list:
        """A subtree for a node of ``size`` vectors of which ``x`` (unit rows) is a sample.

        Each entry is [direction's seed, cut, left, right] or [number of the child, whether it is a leaf].
        """
        out: list = []
        weight, band = size / len(x), self.band(x.shape[1])
        todo = [(np.arange(len(x)), 0, "", None)]
        while todo:
            rows, level, path, parent = todo.pop()
            at = len(out)
            if parent is not None:
                out[parent[0]][parent[1]] = at
            cut = None
            small = len(rows) * weight <= self.leaf or not level and len(rows) < FEW
            if not small and level < self.levels and len(rows) >= FEW:
                for i in range(DIRECTIONS):
                    seed = _number(node, tree, path, i)
                    p = x[rows] @ _direction(seed, x.shape[1])
                    t = float(np.median(p))
                    share = float((np.abs(p - t) <= band).mean())
                    if cut is None or share < cut[0]:
                        cut = (share, seed, t, p)
            if cut is None or cut[0] > DENSE:
                out.append([_number(node, tree, path, "leaf"), small or cut is not None])
                continue
            _, seed, t, p = cut
            out.append([seed, t, None, None])
            todo.append((rows[p >= t - band], level + 1, path + "r", (at, 3)))
            todo.append((rows[p <= t + band], level + 1, path + "l", (at, 2)))
        return out

    def route(self, x: np.ndarray, trees: list[list]) -> tuple[list[list[int]], list[list[int]]]:
        """Per row the leaves and the still open nodes it comes to (several, where it lies in bands)."""
        leaves: list[list[int]] = [[] for _ in x]
        opened: list[list[int]] = [[] for _ in x]
        band = self.band(x.shape[1])
        for tree in trees:
            todo = [(0, np.arange(len(x)))]
            while todo:
                at, rows = todo.pop()
                if not len(rows):
                    continue
                entry = tree[at]
                if len(entry) == 2:
                    into = leaves if entry[1] else opened
                    for r in rows.tolist():
                        into[r].append(entry[0])
                    continue
                seed, t, left, right = entry
                p = x[rows] @ _direction(seed, x.shape[1])
                todo += [(left, rows[p <= t + band]), (right, rows[p >= t - band])]
        return leaves, opened


_ROUTED = "id bigint, leaves array<bigint>, open array<bigint>"


def _routed(open_rows: DataFrame, forest: Forest, trees: int, sample: int, chunk: int, kind: str, keep: bool) -> DataFrame:
    """Send the rows (node, id, v) of open nodes through subtrees fitted on samples of them: (id, leaves, open)
    per row, with its vector as bytes if ``keep``. A node that is small enough becomes a leaf as it is."""
    sizes = materialize(open_rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")), "forest_nodes")
    dice = F.pmod(F.xxhash64("id", "node"), F.lit(1 << 30)) / float(1 << 30)
    drawn = open_rows.join(sizes, "node").filter((F.col("size") > forest.leaf) & (dice < F.lit(float(sample)) / F.col("size")))

    def fit(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id").iloc[:2 * sample]
        x, node = unit_rows(_matrix(group["v"], kind)), int(key[0])
        made = [forest.fit(x, int(group["size"].iloc[0]), node, t) for t in range(trees)]
        return pd.DataFrame({"node": [node], "trees": [json.dumps(made)]})

    fitted = materialize(drawn.groupBy("node").applyInPandas(fit, "node bigint, trees string"), "forest_trees")
    chunks = F.ceil(F.col("size") / chunk).cast("int")
    rows = open_rows.join(sizes, "node").select("node", F.pmod(F.xxhash64("id"), chunks).alias("chunk"), "id", "v")
    plans = sizes.join(fitted, "node", "left").select("node", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), "trees")

    def route(key, group: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
        if not len(group):  # a chunk that no id fell into
            return pd.DataFrame({c: [] for c in ("id", "leaves", "open", *["v"] * keep)}, dtype=object)
        node, raw = int(key[0]), _matrix(group["v"], kind)
        made = plan["trees"].iloc[0] if len(plan) else None
        if made:
            leaves, opened = forest.route(unit_rows(raw), json.loads(made))
        else:
            leaves, opened = [[_number(node, "leaf")]] * len(group), [[]] * len(group)
        out = pd.DataFrame({"id": group["id"], "leaves": leaves, "open": opened})
        if keep:
            out["v"] = [r.tobytes() for r in raw.astype(kind)]
        return out

    schema = _ROUTED + (", v binary" if keep else "")
    return rows.groupBy("node", "chunk").cogroup(plans.groupBy("node", "chunk")).applyInPandas(route, schema)


def forest_leaves(classes: DataFrame, forest: Forest, trees: int = TREES, sample: int = SAMPLE, chunk: int = CHUNK) -> DataFrame:
    """(id, v as bytes, leaves) of the distinct vectors ``classes`` (id, v): the leaves of all trees that a vector is in.

    Vectors of different lengths never share a leaf.
    """
    kind = "<f4" if isinstance(classes.schema["v"].dataType.elementType, T.FloatType) else "<f8"
    rooted = classes.select(F.size("v").cast("bigint").alias("node"), "id", "v")
    now = materialize(_routed(rooted, forest, trees, sample, chunk, kind, keep=True), "forest_round")
    while True:
        opened = now.filter(F.size("open") > 0).select(F.explode("open").alias("node"), "id", "v")
        if opened.isEmpty():
            return now.select("id", "v", "leaves")
        more = _routed(opened, forest, 1, sample, chunk, kind, keep=False).groupBy(F.col("id").alias("_id")).agg(
            F.flatten(F.collect_list("leaves")).alias("_leaves"), F.flatten(F.collect_list("open")).alias("_open"))
        none = F.array().cast("array<bigint>")
        now = materialize(now.join(more, F.col("id") == F.col("_id"), "left").select(
            "id", "v", F.concat("leaves", F.coalesce("_leaves", none)).alias("leaves"), F.coalesce("_open", none).alias("open")), "forest_round")


def _least_reachable(near: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Per row the least label among the rows that ``near`` (symmetric) connects it with."""
    label = label.copy()
    rows, cols = np.nonzero(near)
    while True:
        least = label.copy()
        np.minimum.at(least, rows, label[cols])
        if (least == label).all():
            return label
        label = least


def _linked(threshold: float, kind: str):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        leaf, left, right = (int(k) for k in key)
        group = group.sort_values(["part", "id"], kind="stable")
        raw, part = _matrix(group["v"], kind), group["part"].to_numpy()
        unit = unit_rows(raw)
        # Single precision finds the rows that may have a link at all; it is off by less than this.
        rough, slack = unit.astype(np.float32), 2.5e-7 * unit.shape[1]
        if left == right:
            near_to = rough @ rough.T
            np.fill_diagonal(near_to, -1)
            hit = np.flatnonzero(near_to.max(axis=1) >= threshold - slack)
        else:
            cut = int(np.searchsorted(part, right))
            near_to = rough[:cut] @ rough[cut:].T >= threshold - slack
            hit = np.flatnonzero(np.concatenate([near_to.any(axis=1), near_to.any(axis=0)]))
        del near_to
        unit, raw, part, group = unit[hit], raw[hit], part[hit], group.iloc[hit]
        near_to = unit @ unit.T
        near = near_to >= threshold + 1e-9
        i, j = np.nonzero(np.triu(np.abs(near_to - threshold) < 1e-9, 1))
        if len(i):
            near[i, j] = near[j, i] = cosines(raw[i], raw[j]) >= threshold
        np.fill_diagonal(near, False)
        if left != right:
            near &= part[:, None] != part[None, :]
        hit = np.flatnonzero(near.any(axis=1)) if len(hit) else hit
        if not len(hit):
            return pd.DataFrame({"id": [], "links": [], "least": []}).astype("int64")
        near, group = near[np.ix_(hit, hit)], group.iloc[hit]
        ids, count = group["id"].to_numpy(), group["n"].to_numpy()
        root = _least_reachable(near, ids)
        # A pair counts in the smallest of the leaves that both are in.
        before = [[x for x in leaves if x < leaf] for leaves in group["leaves"]]
        columns = {x: c for c, x in enumerate(sorted({x for b in before for x in b}))}
        if columns:
            inside = np.zeros((len(ids), len(columns)), dtype=np.float32)
            for r, b in enumerate(before):
                inside[r, [columns[x] for x in b]] = 1
            near &= inside @ inside.T == 0
        return pd.DataFrame({"id": ids, "links": near.astype(np.int64) @ count, "least": root})

    return run


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    trees: int = TREES, leaf: int = LEAF, levels: int = LEVELS, sample: int = SAMPLE, spill: float = SPILL,
                    block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``rows``.

    ``n_links`` is the number of other rows whose cosine with this one was found to
    reach ``threshold``; ``component_id`` the smallest id among the rows that links
    connect with it, itself included; ``kept`` whether that is its own. Rows
    without an id, and vectors that are null, empty, zero or hold null or
    non-finite components, have no links and are components of their own; so are
    vectors of different lengths to each other. Rows that repeat an id are rows of
    their own: repeats with an equal vector link, others do not by their id. An
    empty table gives no rows. Other columns are not read.

    Every link that is returned is exact. One can be missed only if all ``trees``
    part the pair; tests measure that against brute force.
    """
    element = rows.schema[vector_col].dataType.elementType
    fit = usable(rows, id_col, vector_col)
    # Counted before they are dealt out: a vector that is copied very often is one class from here on.
    same = fit.groupBy("a", "b").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    classes = materialize(same.withColumn("id", F.monotonically_increasing_id()), "vector_classes")
    forest = Forest(threshold, leaf, levels, spill)
    placed = forest_leaves(classes.select("id", "v"), forest, trees, sample)

    members = materialize(placed.join(classes.select("id", "n"), "id").select(
        "id", "n", "v", F.array_sort(F.array_distinct("leaves")).alias("leaves")), "vector_leaves")
    blocks = materialize(members.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("m")), "leaf_sizes")
    blocks = blocks.filter("m > 1").select("leaf", F.ceil(F.col("m") / block).cast("int").alias("parts"))
    dealt = members.select("id", "n", "v", "leaves", F.explode("leaves").alias("leaf")).join(blocks, "leaf").withColumn(
        "part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    pairs = dealt.select("leaf", "part", "id", "n", "v", "leaves", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        "leaf", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id", "n", "v", "leaves")
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    found = materialize(pairs.groupBy("leaf", "i", "j").applyInPandas(_linked(threshold, kind), "id bigint, links bigint, least bigint"), "vector_links")

    links = found.groupBy(F.col("id").alias("_id")).agg(F.sum("links").alias("links"))
    united = components(found.select(F.col("id").alias("u"), F.col("least").alias("v")).filter("u != v"), "vector_components")
    placed_in = classes.select("id", "a", "b", "n", "least_id").join(united, F.col("id") == F.col("node"), "left").join(
        links, F.col("id") == F.col("_id"), "left").select(
        "a", "b", F.coalesce("component", "id").alias("component"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least_id")
    placed_in = materialize(placed_in, "vector_classes_linked")
    least = placed_in.groupBy(F.col("component").alias("_c")).agg(F.min("least_id").alias("component_id"))
    judged = placed_in.join(least, F.col("component") == F.col("_c")).select("a", "b", "n_links", "component_id")
    usable_rows = fit.select("vec_id", "a", "b").join(judged, ["a", "b"]).select("vec_id", "n_links", "component_id")
    one = F.col(id_col).cast("bigint")
    alone = rows.filter(~_takes_part(id_col, vector_col)).select(one.alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), one.alias("component_id"))
    return usable_rows.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op13_embedding_dedup(spark, sf_dir):
    """Every vector of the whole ``embeddings`` with its links, its component and whether it stays."""
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


ORACLE_SQL = f"""
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, vec_id, cast(embedding AS double[]) AS v FROM embeddings),
fine AS (
  SELECT r, v FROM rows
  WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS x, b.r AS y FROM fine a JOIN fine b ON a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD}
), reach AS (
  SELECT r AS x, r AS y FROM rows
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT a.vec_id, (SELECT count(*) FROM links WHERE links.x = a.r) AS n_links, min(b.vec_id) AS component_id,
       a.vec_id = min(b.vec_id) AS kept
FROM reach JOIN rows a ON a.r = reach.x JOIN rows b ON b.r = reach.y
GROUP BY a.r, a.vec_id
"""
