"""Operator 3: approximate nearest neighbours over balanced posting lists.

Largest inner product is turned into smallest distance: with M the largest norm,
a vector x becomes (x, sqrt(M^2 - |x|^2)) / M and a query (q / |q|, 0).

*Fit* (bounded sample): balanced halving splits the sample into clusters of equal
size, a few k-means rounds settle them; their means are the list centroids. The
same sample tells how far beyond its nearest centroid a query must look to meet
``AIM`` of its neighbours: the pruning ratio. *Graph*: the centroids are linked
to their nearest ones; a best-first search over this graph, kept in memory by
every task, finds all centroids within a ratio of the nearest. *Index*: every
vector goes to its nearest list and, if it lies near a boundary, also to further
ones whose centroid is within ``CLOSURE`` times the least distance. *Search*: a
query visits the lists whose centroid is within the pruning ratio, and more where
these hold too few vectors; there is no limit on their number.

Neighbouring lists form parts of ``LISTS_PER_PART``; a task compares a part's
vectors with the queries that visit it, list by list, and returns the best k of
each. A part is dealt out in chunks of about ``CHUNK`` vectors and its queries in
blocks, so neither a crowd of equal vectors nor a crowd of queries meets in one task. Scores are taken from the original
vectors in double precision, component by component in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendcast.llm.common import materialize, table
from trendcast.llm.embedding_dedup import unit_rows

K = 20
LIST_SIZE = 256
MAX_LISTS = 1 << 14
SAMPLE_PER_LIST = 64
SAMPLE_VALUES = 1 << 26  # components of all sample vectors: the task that fits holds half a gigabyte
CHUNK = 8192
QUERY_BLOCK = 1024
LISTS_PER_PART = 16
DEGREE = 24
BEAM = 16
CLOSURE, MAX_REPLICAS = 1.01, 4
AIM = 0.93
PROBES_FOR_AIM = 256
_ROWS = 256


@dataclass
class ListIndex:
    """What every task keeps in memory: centroids, their graph, the scale of the vectors, the pruning ratio."""
    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    scale: float
    ratio: float
    sizes: np.ndarray | None = None

    def nearest(self, points: np.ndarray, ratio: float, whole: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each point the lists whose distance is within ``ratio`` of the least: (distances, lists), nearest first.

        ``whole`` gives all lists that the search has seen, the further ones too.

        The search starts at the entry centroids. Each wave opens, for all points
        of a block at once, the centroids seen that are within the ratio or among
        the nearest ``BEAM``, and sees their neighbours, until none is left.
        """
        count = len(self.centroids)
        square = (self.centroids ** 2).sum(axis=1)
        for at in range(0, len(points), _ROWS):
            x = points[at:at + _ROWS]
            own = (x ** 2).sum(axis=1)
            dist = np.full((len(x), count), np.inf)
            opened = np.zeros((len(x), count), dtype=bool)
            who = np.repeat(np.arange(len(x)), len(self.entries))
            what = np.tile(self.entries, len(x))
            while len(who):
                d = own[who] + square[what] - 2 * np.einsum("ij,ij->i", x[who], self.centroids[what])
                dist[who, what] = np.sqrt(np.maximum(d, 0))
                edge = np.partition(dist, min(BEAM, count) - 1, axis=1)[:, min(BEAM, count) - 1]
                edge = np.where(np.isfinite(edge), edge, np.finfo(float).max)
                reach = np.maximum(edge, ratio * dist.min(axis=1))
                who, what = np.nonzero((dist <= reach[:, None]) & ~opened)
                opened[who, what] = True
                who, what = np.repeat(who, self.links.shape[1]), self.links[what].ravel()
                new = np.isinf(dist[who, what])
                pair = np.unique(who[new] * count + what[new])
                who, what = pair // count, pair % count
            for row in dist:
                order = np.argsort(row, kind="stable")
                order = order[np.isfinite(row[order]) if whole else row[order] <= ratio * row[order[0]] + 1e-12]
                yield row[order], order

    def homes(self, vectors: np.ndarray) -> Iterator[tuple[int, int]]:
        """(row, list) of each posting: the nearest list, and more for vectors near a boundary."""
        for i, (_, lists) in enumerate(self.nearest(_lift(vectors, self.scale), CLOSURE)):
            for c in lists[:MAX_REPLICAS]:
                yield i, int(c)

    def probes(self, queries: np.ndarray, least: int = 0) -> Iterator[tuple[int, int]]:
        """(row, list) of each list that a query visits.

        These are the lists within the pruning ratio, and further ones, next
        nearest first, until they hold ``least`` postings (or all are visited).
        """
        sizes = np.zeros(len(self.centroids), np.int64) if self.sizes is None else self.sizes
        for i, (dist, lists) in enumerate(self.nearest(_as_query(queries), self.ratio, whole=True)):
            count = int((dist <= self.ratio * dist[0] + 1e-12).sum())
            if sizes[lists].sum() < least:
                lists = np.concatenate([lists, np.setdiff1d(np.arange(len(sizes)), lists)])
            enough = int(np.searchsorted(np.cumsum(sizes[lists]), least)) + 1 if self.sizes is not None else 0
            for c in lists[:max(count, enough)]:
                yield i, int(c)


def _lift(x: np.ndarray, scale: float) -> np.ndarray:
    x = x / scale
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))])


def _as_query(x: np.ndarray) -> np.ndarray:
    return np.hstack([unit_rows(x), np.zeros((len(x), 1))])


def _centroids(x: np.ndarray, lists: int, rng: np.random.Generator, rounds: int = 5) -> np.ndarray:
    c = np.stack([x[m].mean(axis=0) for m in _balanced(x, lists, rng)])
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        home = np.concatenate([(x[i:i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        c = np.where((np.bincount(home, minlength=len(c)) > 0)[:, None], sums, c)
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def _pruning_ratio(x: np.ndarray, c: np.ndarray, neighbours: int, rng: np.random.Generator) -> float:
    """The ratio within which ``AIM`` of sample queries' neighbours have their list."""
    picked = rng.permutation(len(x))[:PROBES_FOR_AIM]
    q = x[picked].copy()
    q[:, -1] = 0
    q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
    near = q @ x.T
    near[np.arange(len(q)), picked] = -np.inf
    take = min(neighbours, len(x) - 1)
    if take < 1:
        return 2.0
    found = np.argpartition(-near, take - 1, axis=1)[:, :take]
    home = np.concatenate([(x[i:i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
    d = np.sqrt(np.maximum(0, 1 + (c ** 2).sum(axis=1)[None, :] - 2 * q @ c.T))
    ratios = np.take_along_axis(d, home[found], 1) / d.min(axis=1, keepdims=True)
    return float(np.quantile(ratios, AIM))


def _balanced(x: np.ndarray, lists: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Index arrays of ``lists`` clusters of near equal size: split in two by balanced 2-means, again and again."""
    out, todo = [], [(np.arange(len(x)), lists)]
    while todo:
        members, parts = todo.pop()
        if parts <= 1 or len(members) < 2:
            out.append(members)
            continue
        y = x[members]
        left_parts = parts // 2
        cut = len(members) * left_parts // parts
        a, b = y[rng.integers(len(y))], y[rng.integers(len(y))]
        for _ in range(8):
            lean = y @ (a - b)
            order = np.argsort(-lean, kind="stable")
            a, b = y[order[:cut]].mean(axis=0), y[order[cut:]].mean(axis=0)
        todo += [(members[order[:cut]], left_parts), (members[order[cut:]], parts - left_parts)]
    return [m for m in out if len(m)]


def _links(c: np.ndarray, degree: int) -> np.ndarray:
    """The nearest centroids of each, in blocks; half of the places go to random ones where lists are many,
    so that the graph has short ways across."""
    n, square, near = len(c), (c ** 2).sum(axis=1), []
    degree = min(degree, n)
    for at in range(0, n, 512):
        d = square[None, :] - 2 * c[at:at + 512] @ c.T
        near.append(np.argsort(d, axis=1, kind="stable")[:, :degree])
    links = np.vstack(near)
    if n > 4 * degree:
        links[:, -4:] = np.random.default_rng(7).integers(0, n, (n, 4))
    return links


def usable_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v, norm, tag) of the vectors that take part: with an id, not null, empty or zero, no null or non-finite component.

    Norms are taken of the vector over its largest component, so that no square
    over- or underflows. ``tag`` tells rows of one id with different vectors apart.
    """
    rows = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(fine)
    kept = kept.withColumn("_most", F.array_max(F.transform("v", F.abs))).filter(F.col("_most") > 0)
    scaled = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.col("_most")) * (x / F.col("_most"))))
    return kept.withColumn("norm", F.least(F.col("_most") * scaled, F.lit(np.finfo(float).max))).withColumn(
        "tag", F.xxhash64("v")).drop("_most")


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_list()).astype(np.float64)


def build_index(vectors: DataFrame, list_size: int = LIST_SIZE, max_lists: int = MAX_LISTS) -> ListIndex | None:
    """Fit centroids on at most ``lists * SAMPLE_PER_LIST`` vectors, fewer where they are long; None without vectors."""
    facts = vectors.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("m"), F.max(F.size("v")).alias("hi"),
                        F.min(F.size("v")).alias("lo")).first()
    if not facts["n"]:
        return None
    if facts["hi"] != facts["lo"]:
        raise ValueError("vectors of different lengths; search_each_length takes them apart")
    n, lists = facts["n"], max(1, min(max_lists, round(facts["n"] / list_size)))
    bound, scale = min(lists * SAMPLE_PER_LIST, max(lists, SAMPLE_VALUES // facts["hi"])), facts["m"]
    dice = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = vectors.filter(dice < min(1.0, bound / n)).select("vec_id", "v")
    neighbours = max(5, round(K * min(1.0, bound / n)))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        # The sample is bounded whatever the input, so one task may hold it.
        x = np.unique(_lift(_matrix(group.sort_values("vec_id")["v"].iloc[:2 * bound]), scale), axis=0)
        rng = np.random.default_rng(11)
        c = _centroids(x, min(lists, len(x)), rng)
        return pd.DataFrame({"i": np.arange(len(c)), "c": [r.tobytes() for r in c],
                             "ratio": _pruning_ratio(x, c, neighbours, rng)})

    schema = "i int, c binary, ratio double"
    got = sorted(sample.groupBy(F.lit(0).alias("all")).applyInPandas(fit, schema).collect())
    if not got:  # a tiny table of which the dice took none
        got = sorted(vectors.select("vec_id", "v").orderBy("vec_id").limit(1).groupBy(F.lit(0).alias("all"))
                     .applyInPandas(fit, schema).collect())
    c = np.stack([np.frombuffer(r["c"], np.float64) for r in got])
    entries = np.unique(np.linspace(0, len(c) - 1, min(len(c), 16)).astype(np.int64))
    return ListIndex(c, _links(c, DEGREE), entries, scale, got[0]["ratio"])


def _postings(vectors: DataFrame, index: ListIndex) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                got = np.array(list(index.homes(_matrix(b["v"]))))
                yield pd.DataFrame({"part": got[:, 1] // LISTS_PER_PART, "list": got[:, 1],
                                    "vec_id": b["vec_id"].to_numpy()[got[:, 0]], "tag": b["tag"].to_numpy()[got[:, 0]],
                                    "v": b["v"].to_numpy()[got[:, 0]]})

    return vectors.select("vec_id", "tag", "v").mapInPandas(run, "part int, list int, vec_id bigint, tag bigint, v array<double>")


def _visits(queries: DataFrame, index: ListIndex, k: int) -> DataFrame:
    """A row for each query and part of the index that it visits, with the lists it visits there."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                got = pd.DataFrame(list(index.probes(_matrix(b["v"]), (k + 1) * MAX_REPLICAS)), columns=["at", "list"])
                got["part"] = got["list"] // LISTS_PER_PART
                by_part = got.groupby(["at", "part"], sort=False)["list"].agg(list).reset_index()
                at = by_part["at"].to_numpy()
                yield pd.DataFrame({"part": by_part["part"], "lists": by_part["list"],
                                    "query_id": b["vec_id"].to_numpy()[at], "query_tag": b["tag"].to_numpy()[at],
                                    "v": b["v"].to_numpy()[at]})

    return queries.select("vec_id", "tag", "v").mapInPandas(run, "part int, lists array<int>, query_id bigint, query_tag bigint, v array<double>")


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row products, summed component by component in order: equal vectors give equal scores."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def _best_in_chunk(k: int):
    def run(key, queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            none = np.empty(0, np.int64)
            return pd.DataFrame({"query_id": none, "query_tag": none, "vec_id": none, "tag": none, "score": np.empty(0)})
        vectors = vectors.sort_values(["vec_id", "tag"], kind="stable")
        q, v = _matrix(queries["v"]), _matrix(vectors["v"])
        qid, vid = queries["query_id"].to_numpy(), vectors["vec_id"].to_numpy()
        qtag, vtag = queries["query_tag"].to_numpy(), vectors["tag"].to_numpy()
        # A vector may be in several lists here: one candidate, visited if any of its lists is.
        first = np.concatenate([[True], (vid[1:] != vid[:-1]) | (v[1:] != v[:-1]).any(axis=1)])
        at = np.cumsum(first) - 1
        base = int(key[0]) * LISTS_PER_PART
        holds = np.zeros((LISTS_PER_PART, int(at[-1]) + 1), dtype=np.float32)
        holds[vectors["list"].to_numpy() - base, at] = 1
        visits = np.zeros((len(q), LISTS_PER_PART), dtype=np.float32)
        for i, lists in enumerate(queries["lists"]):
            visits[i, np.asarray(lists) - base] = 1
        v, vid, vtag = v[first], vid[first], vtag[first]
        # The query's own row is no candidate; another row of the same id is.
        asked = (visits @ holds > 0) & ((qid[:, None] != vid[None, :]) | (qtag[:, None] != vtag[None, :]))
        with np.errstate(over="ignore", invalid="ignore"):
            rough = np.where(asked, q @ v.T, -np.inf)
        take = min(k, len(vid))
        edge = -np.partition(-rough, take - 1, axis=1)[:, take - 1:take]
        # All within rounding of the k-th are scored exactly, then ties go to the smaller id.
        least = np.where(np.isfinite(edge), edge - 1e-9 * np.maximum(1, np.abs(np.where(np.isfinite(edge), edge, 0))), edge)
        i, j = np.nonzero((rough >= least) & asked)
        score = inner_products(q[i], v[j])
        order = np.lexsort((vid[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        kept = np.arange(len(i)) - np.searchsorted(i, i) < k
        i, j, score = i[kept], j[kept], score[kept]
        return pd.DataFrame({"query_id": qid[i], "query_tag": qtag[i], "vec_id": vid[j], "tag": vtag[j], "score": score})

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = K, index: ListIndex | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each query, its own row left out.

    Both frames are as :func:`usable_vectors` returns, with vectors of one length.
    Ties go to the smaller vec_id. Rows that repeat an id are one if their vectors
    are equal too, else candidates, or queries, of their own. No vectors or no
    queries give no rows.
    """
    spark = vectors.sparkSession
    index = index or build_index(vectors)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    posted = materialize(_postings(vectors, index), "ann_postings")
    sizes = np.zeros(len(index.centroids), np.int64)  # at most MAX_LISTS numbers
    for r in posted.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["list"]] = r["n"]
    visits = materialize(_visits(queries, replace(index, sizes=sizes), k), "ann_visits")
    # At most MAX_LISTS rows: how finely each part and its queries are dealt out.
    chunks = posted.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    blocks = visits.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks"))
    plan = F.broadcast(chunks.join(blocks, "part"))

    v_side = posted.join(plan, "part").select(
        "part", F.pmod(F.xxhash64("vec_id", "tag"), F.col("chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "list", "vec_id", "tag", "v")
    q_side = visits.join(plan, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("block"), "query_id", "query_tag", "lists", "v")
    on = ["part", "chunk", "block"]
    hits = q_side.groupBy(*on).cogroup(v_side.groupBy(*on)).applyInPandas(
        _best_in_chunk(k), "query_id bigint, query_tag bigint, vec_id bigint, tag bigint, score double")
    # A vector found through two of its lists has one score; the window limit cuts before the shuffle.
    once = hits.groupBy("query_id", "query_tag", "vec_id", "tag").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id", "query_tag").orderBy(F.desc("score"), "vec_id", "tag"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_each_length(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """:func:`search` for vectors of several lengths: a query's candidates are the vectors of its own length.

    Each length has an index of its own; there are few of them, as a rule one.
    """
    lengths = sorted(r["n"] for r in vectors.select(F.size("v").alias("n")).distinct().collect())
    found = [search(vectors.filter(F.size("v") == n), queries.filter(F.size("v") == n), k) for n in lengths]
    return reduce(DataFrame.unionByName, found) if found else search(vectors, queries, k)


def op3_ann_search(spark, sf_dir):
    """The 20 nearest found for every row whose vec_id is divisible by 20, among all other rows."""
    vectors = usable_vectors(table(spark, sf_dir, "embeddings"))
    return search_each_length(vectors, vectors.filter(F.pmod("vec_id", F.lit(20)) == 0))
