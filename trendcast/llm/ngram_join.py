"""Operator 1: n-gram Jaccard join with signature trees.

Documents are sets of hashed 5-word shingles; two link at a Jaccard similarity of
``THRESHOLD`` percent or more. Links are exact (up to 64-bit hash collisions);
the result is each document's connected component.

1. One pass over the texts: (doc_id, set size, set key) of each document, and the
   shingles that are frequent in a stretch of documents. Equal sets are one class.
2. *Candidates.* Shingles are ordered, frequent ones last, and each document gives
   its first ``n - ceil(0.75 n) + k``: two linked documents share ``k`` of these
   whatever the order. Documents that share too few with others go. The rest are
   chained (not paired) where they share one and their sizes allow a link, and
   chains grow into candidate clusters.
3. *Signature trees.* The sets of clustered classes, and no others, are read again
   from the texts. A cluster is cut into blocks of bounded bytes along set size,
   and each pair of blocks whose sizes are compatible is one task's work: its
   documents form a tree whose nodes hold OR-combined token bitmaps, size ranges
   and bit counts. A dual traversal drops node pairs whose largest possible
   overlap is too small, or whose documents are already connected; what is left
   is intersected exactly. A task returns a spanning forest of its links.
4. Components of all links; ``component_id`` is the smallest doc_id.

Nothing is dropped at hot shingles or large clusters: they only make more block
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendcast.llm import bloom
from trendcast.llm.common import Seen, document_stage, materialize, parallelism, parts_for, table
from trendcast.llm.components import components, local_labels
from trendcast.llm.hashing import set_key, shingles

THRESHOLD = 75
# A shingle is frequent where this many of about STRETCH shingles in a row are it;
# the FREQUENT most frequent go last in the order. This is a matter of speed only.
STRETCH, STRETCH_LEAST, FREQUENT = 4_000_000, 2, 1 << 20
# A block of a cluster holds about this many shingles, and documents, at most.
BLOCK_SHINGLES, BLOCK_DOCS = 1 << 22, 1 << 12
# Of n shingles a document gives n // EXTRA more than one shared shingle would need.
EXTRA = 16
LEAF, FAN = 16, 8
MIN_BITS, MAX_BITS = 256, 1 << 15


def prefix_length(n: int, threshold: int = THRESHOLD) -> int:
    """How many shingles a document of n gives: linked ones share ``shared_least`` of these.

    Two linked sets have at least ``ceil(threshold * larger size)`` shingles in
    common. Of the first k of these in any order, each set has all among its
    first ``n - ceil(threshold * n) + k``. Here k is ``n // EXTRA + 1``; as the
    smaller set of a link has ``threshold`` of the larger one's size at least,
    both keep the number that ``shared_least`` asks for.
    """
    return min(n, n - -(-threshold * n // 100) + n // EXTRA + 1)


def shared_least(n: int, threshold: int = THRESHOLD) -> int:
    return threshold * n // 100 // EXTRA + 1


def linked(common: int, a: int, b: int, threshold: int = THRESHOLD) -> bool:
    return 100 * common >= threshold * (a + b - common)


# --- 1: sets and frequent shingles ---------------------------------------------------


def _measure(rows: DataFrame) -> DataFrame:
    """Rows of two kinds: documents (key = set key, n = set size) and frequent shingles (key, n = count)."""
    def frequent(held: list[np.ndarray]) -> pd.DataFrame:
        got, n = np.unique(np.concatenate(held), return_counts=True)
        keep = n >= STRETCH_LEAST
        return pd.DataFrame({"kind": 1, "doc_id": pd.Series([None] * int(keep.sum()), dtype="Int64"),
                             "key": got[keep].astype(np.int64), "n": n[keep]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, known = [], 0, set()
        for b in batches:
            keys, counts = [], []
            for text in b["text"]:
                s = shingles(text)
                keys.append(set_key(s))
                counts.append(len(s))
                if keys[-1] not in known:  # copies say nothing about other documents
                    known.add(keys[-1])
                    held.append(s)
                    size += len(s)
                if size >= STRETCH:
                    yield frequent(held)
                    held, size, known = [], 0, set()
            yield pd.DataFrame({"kind": 0, "doc_id": b["doc_id"].astype("Int64"), "key": keys, "n": counts})
        if held:
            yield frequent(held)

    return rows.mapInPandas(run, "kind int, doc_id bigint, key bigint, n bigint")


# --- 2: candidates -------------------------------------------------------------------


def _frequent(measured: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, by the upper half of their hash, and their places in the order; at most ``FREQUENT``."""
    counts = materialize(measured.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")), "ngram_frequent")
    room, least = FREQUENT, None
    for n, shingles_ in sorted(((r["n"], r["c"]) for r in counts.groupBy(F.least("n", F.lit(10_000)).alias("n"))
                                .agg(F.count(F.lit(1)).alias("c")).collect()), reverse=True):
        if shingles_ > room:
            break
        room, least = room - shingles_, n
    if least is None:
        return np.empty(0, np.uint32), np.empty(0, np.uint8)
    # The upper half of a hash and a rough count are enough for an order, and half the size.
    place = F.least(F.floor(4 * F.log2("n")), F.lit(255)).cast("int").alias("place")
    half = F.shiftrightunsigned("key", 32).alias("half")
    top = counts.filter(F.col("n") >= least).select(half, place).groupBy("half").agg(F.max("place").alias("place")).toArrow()
    hashes, place = top["half"].to_numpy().astype(np.uint32), top["place"].to_numpy().astype(np.uint8)
    order = np.argsort(hashes)
    return hashes[order], place[order]


def _prefixes(rows: DataFrame, frequent: tuple[np.ndarray, np.ndarray], threshold: int) -> DataFrame:
    """(token, key, n) of each document's first shingles in the common order."""
    hashes, places = frequent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Seen()  # copies of a document give its shingles once a task
        for b in batches:
            tokens, keys, sizes = [np.empty(0, np.uint64)], [], []
            for text in b["text"]:
                s = shingles(text)
                if not len(s) or not seen.fresh([set_key(s)])[0]:
                    continue
                p, late = prefix_length(len(s), threshold), np.zeros(len(s), dtype=np.uint8)
                if len(hashes):
                    upper = (s >> np.uint64(32)).astype(np.uint32)
                    at = np.minimum(np.searchsorted(hashes, upper), len(hashes) - 1)
                    late = np.where(hashes[at] == upper, places[at], np.uint8(0))
                tokens.append(s[np.argsort(late, kind="stable")[:p]])
                keys.append((set_key(s), p))
                sizes.append(len(s))
            counts = [p for _, p in keys]
            yield pd.DataFrame({"token": np.concatenate(tokens).astype(np.int64),
                                "key": np.repeat(np.array([k for k, _ in keys], dtype=np.int64), counts),
                                "n": np.repeat(np.array(sizes, dtype=np.int32), counts)})

    return rows.mapInPandas(run, "token bigint, key bigint, n int")


def _gathered(batches: Iterator[pd.DataFrame], threshold: int) -> tuple[np.ndarray, ...] | None:
    """A partition's rows as arrays (token, key, n) by token, size and key, each class once per token,
    and whether a row's successor shares its token and may link by size.

    Rows of a token stand in order of set size, so where one and the next are too
    far apart in size, so are all before and all after.
    """
    parts = [b for b in batches if len(b)]
    if not parts:
        return None
    t, k, n = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("token", "key", "n"))
    order = np.lexsort((k, n, t))
    t, k, n = t[order], k[order], n[order].astype(np.int64)
    once = np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])])
    t, k, n = t[once], k[once], n[once]
    return t, k, n, (t[1:] == t[:-1]) & (100 * n[:-1] >= threshold * n[1:])


def _shared(prefixes: DataFrame, threshold: int, parts: int) -> DataFrame:
    """(token, key, n): the prefix shingles that a class shares with one of a size that may link."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = _gathered(batches, threshold)
        if got is not None:
            t, k, n, near = got
            has = np.concatenate([near, [False]]) | np.concatenate([[False], near])
            yield pd.DataFrame({"token": t[has], "key": k[has], "n": n[has]})

    dealt = prefixes.repartition(parts, "token")
    return dealt.mapInPandas(run, "token bigint, key bigint, n int")


def _chains(shared: DataFrame, threshold: int, parts: int) -> DataFrame:
    """(u, v): stars over the classes that chains of equal shingles connect within a partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = _gathered(batches, threshold)
        if got is not None:
            _, k, _, near = got
            nodes, at = np.unique(np.concatenate([k[:-1][near], k[1:][near]]), return_inverse=True)
            half = int(near.sum())
            label = local_labels(at[:half], at[half:], len(nodes))
            other = label != np.arange(len(nodes))
            yield pd.DataFrame({"u": nodes[other], "v": nodes[label[other]]})

    dealt = shared.repartition(parts, "token")
    return dealt.mapInPandas(run, "u bigint, v bigint")


def _likely(shared: DataFrame, threshold: int) -> DataFrame:
    """``shared`` without the classes that share fewer shingles than any link of theirs would."""
    least = F.floor(F.floor(F.max("n") * threshold / 100) / EXTRA) + 1
    enough = shared.groupBy("key").agg(F.count(F.lit(1)).alias("_shared"), least.alias("_least")).filter("_shared >= _least")
    return shared.join(materialize(enough.select("key"), "ngram_likely"), "key")


# --- 3: signature trees --------------------------------------------------------------


class SignatureTree:
    """Documents in leaves of ``LEAF``, nodes of ``FAN`` children: OR-combined bitmaps, size ranges, counts.

    A document's *excess* is its set size less the number of its bits. The
    shingles that two documents have in common lie in common bits, so there are
    at most (common bits + the smaller excess) of them; for nodes the same holds
    with their combined bitmaps and largest excesses.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        bits = MIN_BITS
        while bits < 4 * sizes.mean() and bits < MAX_BITS:
            bits *= 2
        maps = np.zeros((len(sets), bits // 8), dtype=np.uint8)
        for i, s in enumerate(sets):
            row = np.zeros(bits, dtype=bool)
            row[(s & np.uint64(bits - 1)).astype(np.int64)] = True
            maps[i] = np.packbits(row)
        self.maps, self.sizes = maps.view(np.uint64), sizes
        self.excess = sizes - np.bitwise_count(self.maps).sum(axis=1, dtype=np.int64)
        self.levels, spans = [], [(i, min(i + LEAF, len(sets))) for i in range(0, len(sets), LEAF)]
        maps, low, high, over = self.maps, sizes, sizes, self.excess
        bounds = spans
        while True:
            maps = np.stack([np.bitwise_or.reduce(maps[a:b], axis=0) for a, b in bounds])
            low, high, over = (np.array([f(x[a:b]) for a, b in bounds])
                               for f, x in ((np.min, low), (np.max, high), (np.max, over)))
            self.levels.append((maps, low, high, over, spans))
            if len(bounds) == 1:
                break
            bounds = [(i, min(i + FAN, len(spans))) for i in range(0, len(spans), FAN)]
            spans = [(spans[a][0], spans[b - 1][1]) for a, b in bounds]


def _possible(common: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: int) -> np.ndarray:
    return (100 + threshold) * common >= threshold * (a + b)


def find_links(sets: list[np.ndarray], side: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets (sorted distinct hashes), as pairs of positions.

    ``side`` is 0 or 1; if both occur, only links across sides need to be found
    (others may be).
    """
    forest: list[tuple[int, int]] = []
    if len(sets) < 2:
        return forest
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    across = bool(side.min() != side.max())
    label = np.arange(len(sets))

    def verify(i: int, j: int) -> None:
        common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if linked(common, int(sizes[i]), int(sizes[j]), threshold):
            label[label == label[j]] = label[i]
            forest.append((i, j))

    # Documents with an equal least hash are likely to link: joining them first
    # leaves less for the tree. The first of these hashes also orders the leaves.
    least = None
    for seed in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93):
        h = np.array([(s * np.uint64(seed) ^ (s >> np.uint64(29))).min() for s in sets])
        least = h if least is None else least
        order = np.lexsort((sizes, h))
        for i, j in zip(order[:-1], order[1:], strict=True):
            if h[i] == h[j] and label[i] != label[j] and _possible(min(sizes[i], sizes[j]), sizes[i], sizes[j], threshold):
                verify(int(i), int(j))
    if len(sets) == 2:
        if label[0] != label[1] and _possible(sizes.min(), sizes[0], sizes[1], threshold):
            verify(0, 1)
        return forest

    place = np.lexsort((least, np.floor(np.log(sizes) / np.log(100 / threshold))))
    tree = SignatureTree([sets[i] for i in place], sizes[place])
    group, mine = label[place], side[place]
    todo = [(len(tree.levels) - 1, 0, 0)]
    while todo:
        level, x, y = todo.pop()
        maps, low, high, over, spans = tree.levels[level]
        (a0, a1), (b0, b1) = spans[x], spans[y]
        if x != y and not (100 * high[x] >= threshold * low[y] and 100 * high[y] >= threshold * low[x]):
            continue
        if across and mine[a0:a1].min() == mine[a0:a1].max() == mine[b0:b1].min() == mine[b0:b1].max():
            continue
        if x != y:
            common = int(np.bitwise_count(maps[x] & maps[y]).sum())
            if not _possible(min(common + min(over[x], over[y]), high[x], high[y]), low[x], low[y], threshold):
                continue
        group = label[place]
        if group[a0] == group[b0] and (group[a0:a1] == group[a0]).all() and (group[b0:b1] == group[b0]).all():
            continue
        if level:
            kids = len(tree.levels[level - 1][4])
            xs, ys = range(x * FAN, min(x * FAN + FAN, kids)), range(y * FAN, min(y * FAN + FAN, kids))
            todo += [(level - 1, i, j) for i in xs for j in ys if x != y or i <= j]
            continue
        shared = np.bitwise_count(tree.maps[a0:a1, None, :] & tree.maps[None, b0:b1, :]).sum(axis=2, dtype=np.int64)
        most = shared + np.minimum(tree.excess[a0:a1, None], tree.excess[None, b0:b1])
        most = np.minimum(most, np.minimum(tree.sizes[a0:a1, None], tree.sizes[None, b0:b1]))
        may = _possible(most, tree.sizes[a0:a1, None], tree.sizes[None, b0:b1], threshold)
        may &= group[a0:a1, None] != group[None, b0:b1]
        if across:
            may &= mine[a0:a1, None] != mine[None, b0:b1]
        for i, j in zip(*np.nonzero(np.triu(may, 1) if x == y else may), strict=True):
            i, j = int(place[a0 + i]), int(place[b0 + j])
            if label[i] != label[j]:
                verify(i, j)
    return forest


def _blocks(members: DataFrame, threshold: int) -> DataFrame:
    """``members`` with ``tasks``: the (i, j, side) pairs of blocks of its cluster that each takes part in."""
    share = F.greatest(F.col("n") / BLOCK_SHINGLES, F.lit(1 / BLOCK_DOCS))  # of a block
    by_size = members.groupBy("cluster", "n").agg(F.sum(share).alias("size"))
    before = F.sum("size").over(Window.partitionBy("cluster").orderBy("n")) - F.col("size")
    cut = by_size.select("cluster", "n", F.floor(F.round(before, 9)).alias("base"), F.ceil(F.round("size", 9)).alias("parts"))
    part = F.pmod(F.xxhash64("key"), F.col("parts"))
    placed = materialize(members.join(cut, ["cluster", "n"]).withColumn("block", F.col("base") * (1 << 24) + part)
                         .drop("base", "parts"), "ngram_placed")
    spans = placed.groupBy("cluster", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    i, j = spans.alias("i"), spans.alias("j")
    pairs = i.join(j, (F.col("i.cluster") == F.col("j.cluster")) & (F.col("i.block") <= F.col("j.block"))
                   & (100 * F.col("i.hi") >= threshold * F.col("j.lo")))
    pairs = pairs.select(F.col("i.cluster").alias("cluster"), F.col("i.block").alias("i"), F.col("j.block").alias("j"))
    left = pairs.select("cluster", F.col("i").alias("block"), "i", "j", F.lit(0).alias("side"))
    right = pairs.filter("i != j").select("cluster", F.col("j").alias("block"), "i", "j", F.lit(1).alias("side"))
    tasks = left.unionByName(right).groupBy("cluster", "block").agg(F.collect_list(F.struct("i", "j", "side")).alias("tasks"))
    return placed.join(tasks, ["cluster", "block"])


def _sets(rows: DataFrame, members: DataFrame, count: int) -> DataFrame:
    """(key, cluster, tasks, shingles) of the member classes, from their first document's text."""
    near = bloom.maybe_in(rows, "doc_id", members, count)
    joined = near.join(members, "doc_id").select("key", "cluster", "tasks", "text")
    kinds = joined.schema["tasks"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [shingles(t) for t in b["text"]]
            same = np.array([set_key(s) == k for s, k in zip(found, b["key"], strict=True)], dtype=bool)
            out = b.drop(columns="text")
            out["shingles"] = [s.tobytes() for s in found]
            yield out[same]

    return joined.mapInPandas(run, f"key bigint, cluster bigint, tasks {kinds}, shingles binary")


def _links(sets: DataFrame, threshold: int) -> DataFrame:
    """(u, v): a spanning forest of the links of each task."""
    def solve(rows: list[tuple]) -> pd.DataFrame:
        once = {key: (side, s) for key, side, s in rows}
        keys = list(once)
        side = np.array([once[k][0] for k in keys])
        found = find_links([np.frombuffer(once[k][1], np.uint64) for k in keys], side, threshold)
        return pd.DataFrame({"u": [keys[i] for i, _ in found], "v": [keys[j] for _, j in found]}, dtype="int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []
        for b in batches:
            out = []
            for cluster, i, j, *row in zip(b["cluster"], b["i"], b["j"], b["key"], b["side"], b["shingles"], strict=True):
                if (cluster, i, j) != now:
                    if len(held) > 1:
                        out.append(solve(held))
                    now, held = (cluster, i, j), []
                held.append(row)
            if out:
                yield pd.concat(out)
        if len(held) > 1:
            yield solve(held)

    each = sets.select("key", "cluster", F.explode("tasks").alias("t"), "shingles").select("key", "cluster", "t.*", "shingles")
    dealt = each.repartition(parallelism(sets.sparkSession), "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return dealt.mapInPandas(run, "u bigint, v bigint")


# --- 4: the operator -----------------------------------------------------------------


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    A set is the distinct 5-word shingles of the whole text, A-Z in lower case;
    with fewer words, all of them as one. Null, empty and blank texts have no
    shingle, link with nothing and are components of their own. Rows with equal
    ids are separate documents that share an id. A row without an id gets its
    size and a null component and links with nothing. An empty table stays
    empty. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    measured = materialize(_measure(rows), "ngram_measured")
    sizes = measured.filter("kind = 0").select("doc_id", "key", "n")
    linkable = sizes.filter("doc_id is not null and n > 0")

    tokens = _prefixes(rows.filter("doc_id is not null"), _frequent(measured), threshold)
    # As many parts as the prefixes need, which the set sizes tell.
    n = F.col("n")
    longest = F.least(n, n - F.ceil(n * threshold / 100) + F.floor(n / EXTRA) + 1)
    parts = parts_for(docs.sparkSession, linkable.agg(F.sum(longest)).first()[0] or 0)
    shared = materialize(_shared(tokens, threshold, parts), "ngram_shared")
    clusters = components(materialize(_chains(_likely(shared, threshold), threshold, parts), "ngram_chains"), "ngram_clusters")
    clustered = clusters.select(F.col("node").alias("key"), F.col("component").alias("cluster")).unionByName(
        clusters.select(F.col("component").alias("key"), F.col("component").alias("cluster")).distinct())
    classes = linkable.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    members = materialize(classes.join(clustered, "key"), "ngram_members")
    placed = materialize(_blocks(members, threshold), "ngram_blocks")
    links = materialize(_links(_sets(rows, placed, placed.count()), threshold), "ngram_links")

    found = components(links, "ngram_components").select(F.col("node").alias("key"), F.col("component").alias("label"))
    labels = materialize(classes.join(found, "key", "left").select(
        "key", "doc_id", F.coalesce("label", "key").alias("label")), "ngram_labels")
    first = labels.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_class = materialize(labels.select("key", "label").join(first, "label").select("key", "component_id"), "ngram_by_class")
    out = linkable.join(by_class, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    rest = sizes.filter("doc_id is null or n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(rest)


def op1_ngram_jaccard_join(spark, sf_dir):
    """Every document with its set's size and the smallest id that links lead to."""
    return ngram_join(table(spark, sf_dir, "documents"))


@document_stage
def one_of_each_group(spark, docs, sf_dir):
    """Pipeline stage: of each group of near copies the document with the smallest id."""
    groups = materialize(ngram_join(docs).filter("doc_id != component_id").select("doc_id").distinct(), "ngram_others")
    return docs.join(groups, "doc_id", "left_anti")


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
links AS (
  SELECT a.r AS x, b.r AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r
  JOIN sizes m ON m.r = a.r JOIN sizes n ON n.r = b.r
  GROUP BY a.r, b.r, m.n, n.n HAVING 100 * count(*) >= 75 * (m.n + n.n - count(*))
), reach AS (
  SELECT r AS x, r AS y FROM words
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT a.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(b.doc_id) AS component_id
FROM reach JOIN words a ON a.r = reach.x JOIN words b ON b.r = reach.y LEFT JOIN sizes ON sizes.r = a.r
GROUP BY a.r, a.doc_id
"""
