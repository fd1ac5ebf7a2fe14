"""Operator 13 against all pairs of vectors."""

import math

import numpy as np
import pytest

from trendcast.llm import embedding_dedup as ed

VECTORS = "vec_id bigint, embedding array<double>, a int, node string"


def plain(rows, threshold=0.95):
    """[(vec_id, n_links, component_id, kept)] by comparing all pairs of rows."""
    fine = [i is not None and v is not None and any(v) and all(x is not None and math.isfinite(x) for x in v) for i, v in rows]
    unit = [ed.unit_rows(np.array([v]))[0] if ok else None for (_, v), ok in zip(rows, fine, strict=True)]
    near = [[b for b in range(len(rows)) if a != b and fine[a] and fine[b] and len(unit[a]) == len(unit[b])
             and unit[a] @ unit[b] >= threshold - 1e-12] for a in range(len(rows))]
    out = []
    for a, (i, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        least = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        out.append((i, len(near[a]), least, i is not None and i == least))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def cluster(rng, centre, n, noise):
    return [centre + noise * rng.standard_normal(len(centre)) / math.sqrt(len(centre)) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in rows], VECTORS)


def test_query_counts_every_link(spark, sf_dir):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = rows_of(ed.op13_embedding_dedup(spark, sf_dir))
    assert got == plain(rows) and len(got) == len(rows)


@pytest.mark.parametrize(("leaf", "levels", "block"), [(16, 2, 2048), (40, 8, 2048), (64, 3, 7), (100_000, 8, 50)])
def test_many_small_leaves_rounds_and_blocks(spark, leaf, levels, block):
    """Pairs at 0.99 and more, exact copies and a dense ball; several rounds of subtrees, several blocks a leaf."""
    rng = np.random.default_rng(1)
    points = [c for _ in range(60) for c in cluster(rng, rng.standard_normal(24), 3, 0.06)]
    points += cluster(rng, rng.standard_normal(24), 120, 0.08) + [points[0]] * 30 + [points[1] * 3]
    rows = [(int(i), p.tolist()) for i, p in zip(rng.permutation(10 * len(points))[:len(points)], points, strict=True)]
    got = rows_of(ed.near_duplicates(frame(spark, rows), leaf=leaf, levels=levels, sample=200, block=block))
    want = plain(rows)
    assert got == want and sum(r[1] for r in want) > 120 * 100


def test_chunks_without_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, p.tolist()) for i, p in enumerate(cluster(rng, rng.standard_normal(8), 60, 3.0))]
    classes = frame(spark, rows).selectExpr("vec_id * 1024 as id", "embedding as v")
    placed = ed.forest_leaves(classes, ed.Forest(0.95, 8, 2, 0.6), sample=40, chunk=1).collect()
    assert sorted(r["id"] for r in placed) == [1024 * i for i in range(60)] and all(r["leaves"] for r in placed)


def test_recall_at_the_threshold(spark):
    """Pairs whose cosine is just above 0.95, the hardest to keep together."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(1500):
        a, b = (x / np.linalg.norm(x) for x in rng.standard_normal((2, 64)))
        b -= (a @ b) * a
        c = rng.uniform(0.9501, 0.955)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (c * a + math.sqrt(1 - c * c) * b / np.linalg.norm(b)).tolist())]
    got = rows_of(ed.near_duplicates(frame(spark, rows), leaf=128))
    linked = sum(r[1] for r in got)
    assert linked >= 0.998 * 3000 and linked <= 3000


def test_odd_vectors_repeats_lengths_and_norms(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 0.0]),
            (7, [1e200, 0.0]), (8, [1e-200, 0.0]), (9, [5e-324, 0.0]), (9, [1.0, -0.0]), (9, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]),
            (11, [1.0]), (0, [-1.0, 0.0]), (12, [0.951, math.sqrt(1 - 0.951 ** 2)]), (7, [0.0, 3.0]), (13, [0.0, 3.0])]
    assert rows_of(ed.near_duplicates(frame(spark, rows))) == plain(rows)
    assert ed.near_duplicates(frame(spark, rows).limit(0)).collect() == []
    floats = frame(spark, rows).selectExpr("vec_id", "cast(embedding as array<float>) as embedding")
    assert {r["vec_id"] for r in ed.near_duplicates(floats).filter("n_links = 0").collect()} >= {1, 2, 3, 4, 5, 6, None}
