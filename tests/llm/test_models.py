"""Operators 3, 6 and 10: recall, held-out accuracy, marginals."""

import re

import numpy as np
import pandas as pd
import pytest
from helpers import DOCS, n_words, plain_targets
from pyspark.sql import functions as F

from trendcast.llm import ann_search, license_scan, source_mixing, topics

# --- 3: nearest neighbours -----------------------------------------------------------


def _exact(ids, v, queries, k):
    out = {}
    for q in queries:
        s = ann_search.inner_products(np.broadcast_to(v[ids == q][0], v.shape), v)
        s[ids == q] = -np.inf
        order = np.lexsort((ids, -s))[:min(k, len(ids) - 1)]
        out[int(q)] = [(int(ids[i]), s[i]) for i in order]
    return out


def test_ann_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(ann_search, "LIST_SIZE", 64)
    monkeypatch.setattr(ann_search, "CHUNK", 700)
    monkeypatch.setattr(ann_search, "QUERY_BLOCK", 30)
    rng = np.random.default_rng(2)
    v = np.repeat(rng.normal(size=(30, 16)), 60, axis=0) + rng.normal(size=(1800, 16)) * 0.5
    v[:600] = v[0]  # a third of the rows are equal
    ids = np.arange(1800)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": ids, "embedding": v.tolist(), "label": 1}))
    vectors = ann_search.usable_vectors(df)
    got = {}
    for r in ann_search.search(vectors, vectors.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = _exact(ids, v, ids[ids % 20 == 0], 20)
    assert set(got) == set(want)
    recall = np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    assert got[0] == want[0] and [a for a, _ in got[0]] == list(range(1, 21))  # ties go to smaller ids
    for q in got:
        exact = dict(want[q])
        assert all(exact[a] == s for a, s in got[q] if a in exact)


def test_ann_finds_k_where_the_near_lists_are_small(spark, monkeypatch):
    monkeypatch.setattr(ann_search, "LIST_SIZE", 2)
    rng = np.random.default_rng(5)
    v = np.vstack([rng.normal(size=(3, 8)) * 0.01 + 5, rng.normal(size=(60, 8)) - 5])
    vectors = ann_search.usable_vectors(spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(63), "embedding": v.tolist()})))
    got = ann_search.search(vectors, vectors.filter("vec_id in (0, 20)")).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in got} == {0: 20, 20: 20}


def test_ann_edges(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]),
            (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [3.0, 3.0])]
    vectors = ann_search.usable_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = ann_search.search(vectors, vectors.filter("vec_id % 20 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 6, 3.0), (0, 2, 20, 0.0), (20, 1, 6, 6.0), (20, 2, 0, 0.0)]
    none = vectors.filter("vec_id = -1")
    assert ann_search.search(none, none).count() == 0
    alone = vectors.filter("vec_id = 0")
    assert ann_search.search(alone, alone).count() == 0


def test_ann_norms_lengths_and_equal_ids(spark):
    """Very long and very short vectors take part; lengths are searched apart; an id's other vectors are candidates of their own."""
    rows = [(0, [1e200, 0.0]), (1, [1e-200, 0.0]), (2, [-1e200, 1e200]), (3, [5e-324, 0.0]), (20, [2.0, 1.0]), (20, [1.0, 3.0]), (20, [1.0, 3.0]),
            (40, [1.0, 2.0, 3.0]), (41, [1.0, 0.0, 0.0]), (60, [7.0]), (4, [])]
    vectors = ann_search.usable_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    assert vectors.count() == 10
    found = ann_search.search_each_length(vectors, vectors.filter("vec_id % 20 = 0")).collect()
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)
    q0 = [(0, 1, 20, 2e200), (0, 2, 20, 1e200), (0, 3, 1, 1.0), (0, 4, 3, 1e200 * 5e-324), (0, 5, 2, float("-inf"))]
    first = [(20, 0, 2e200), (20, 20, 5.0), (20, 1, 2e-200), (20, 3, 1e-323), (20, 2, -1e200)]
    second = [(20, 2, 2e200), (20, 0, 1e200), (20, 20, 5.0), (20, 1, 1e-200), (20, 3, 5e-324)]
    assert [g for g in got if g[0] == 0] == q0
    assert sorted((a, c, d) for a, _, c, d in got if a == 20) == sorted(first + second)
    assert [g for g in got if g[0] >= 40] == [(40, 1, 41, 1.0)]
    with pytest.raises(ValueError, match="lengths"):
        ann_search.search(vectors, vectors)


def test_ann_graph_search_is_complete_on_small_graphs():
    rng = np.random.default_rng(0)
    c = rng.normal(size=(200, 9))
    index = ann_search.ListIndex(c, ann_search._links(c, 24), np.array([0, 100]), 1.0, 1.2)
    x = rng.normal(size=(300, 9))
    d = np.linalg.norm(x[:, None] - c[None], axis=2)
    found = [set(lists.tolist()) for _, lists in index.nearest(x, 1.2)]
    want = [set(np.flatnonzero(r <= 1.2 * r.min()).tolist()) for r in d]
    assert np.mean([len(a & b) / len(b) for a, b in zip(found, want, strict=True)]) > 0.98


# --- 6: licences ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def license_model(spark):
    return license_scan.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_every_notice_has_a_cue(spark):
    assert license_scan.notices(spark).filter(~F.col("notice").rlike(license_scan.CUES)).filter(
        ~F.col("notice").startswith("Permission to use")).count() == 0


def test_license_held_out_accuracy(spark, license_model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = license_scan.training_rows(docs).filter("held").withColumnRenamed("family", "truth")
    got = license_model.predict(held).select("truth", "family").collect()
    assert len(got) > 200
    assert sum(r.truth == r.family for r in got) >= 0.95 * len(got)
    unknown = [r for r in got if r.truth == license_scan.UNKNOWN]
    assert sum(r.family != license_scan.UNKNOWN for r in unknown) <= 0.02 * len(unknown)


def test_license_scan_cases(spark, license_model):
    rows = [(1, "Some prose here.\nReleased under the MIT License."), (2, "Licensed under CC BY-NC 4.0."), (3, None), (4, ""),
            (5, "The driver lost a license on the road to the river."), (None, "Licensed under the Apache License, Version 2.0."),
            (6, "word " * 60_000 + "This work is licensed under the GNU General Public License, version 3."), (1, "MIT License")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).withColumn("line", F.lit(1))
    got = license_scan.scan_licenses(df, license_model).filter("confirmed").collect()
    found = {(r.doc_id, r.line, r.family) for r in got}
    assert {(1, 1, "MIT"), (2, 0, "CC-BY-NC"), (None, 0, "Apache"), (6, 0, "GPL")} <= found
    assert not [r for r in got if r.doc_id in (3, 4, 5)]
    assert license_scan.scan_licenses(df.limit(0), license_model).count() == 0


def test_license_scan_wrapped_notices(spark, license_model):
    mpl = ["/* This Source Code Form is subject to the terms of the Mozilla Public", " * License, v. 2.0. If a copy of the MPL was not distributed with this",
           " * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"]
    mit = ["// Permission is hereby granted, free of charge, to any person obtaining a copy", "// of this software and associated documentation files (the \"Software\"), to deal",
           "// in the Software without restriction, including without limitation the rights", "// to use, copy, modify, merge, publish, distribute, sublicense, and/or sell", "// copies of the Software"]
    bsd = ["# Redistribution and use in source and binary forms, with or without", "# modification, are permitted provided that the following conditions are met:",
           "# 1. Redistributions of source code must retain the above copyright", "#    notice, this list of conditions and the following disclaimer."]
    gpl = ["-- This program is free software: you can redistribute it and/or modify", "-- it under the terms of the GNU General Public License as published by",
           "-- the Free Software Foundation, either version 3 of the License, or", "-- (at your option) any later version."]
    free = ["This is free and unencumbered software released into the public", "domain."]
    rows = [(1, "\n".join(["int a;", "", *mpl, "", "int b;"])), (2, "\n".join([*mit, "//", "// more"])), (3, "\n".join(bsd)), (4, "\n".join(gpl)), (5, "\n".join(free))]
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string"), license_model).collect()
    confirmed = {(r.doc_id, r.family) for r in found if r.confirmed}
    assert {(1, "MPL"), (2, "MIT"), (3, "BSD"), (4, "GPL"), (5, "CC0")} <= confirmed, confirmed
    assert len({(r.doc_id, r.line, r.part) for r in found}) == len(found)


def test_license_scan_classifies_paragraphs_without_a_cue(spark, license_model):
    """A notice whose cue words are missing is found, and every line and joined paragraph gets its row."""
    isc = "Permission to use, copy, modify, and distribute this software for any purpose"
    bare = next(t for t in license_scan.NOTICES["ISC"] if t.startswith("Permission to use")) if "ISC" in license_scan.NOTICES else isc
    rows = [(1, "Some prose of the town.\nMore of it.\n\nAn end."), (2, "Released under the MIT"), (3, bare)]
    assert not any(re.search(license_scan.CUES, t) for _, t in rows[:2])
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string"), license_model).collect()
    assert sorted((r.line, r.part) for r in got if r.doc_id == 1) == [(0, 0), (0, 1), (1, 0), (3, 0)]
    assert {r.doc_id for r in got} == {1, 2, 3}
    assert [(r.family, r.confirmed, r.cue) for r in got if r.doc_id == 2] == [("MIT", True, False)]
    assert not [r for r in got if r.doc_id == 1 and r.confirmed]


def test_license_windows_are_scored_once(spark, license_model):
    """Windows are united by line before documents are counted: no copies of them for each kind of count."""
    long = "word " * 100 + "Released under the MIT License. " + "word " * 100
    rows = [(1, f"MIT License\nReleased under the MIT License.\n\n{long}"), (2, "All rights reserved.\nprose"), (None, "Copyright"), (None, "GNU GPL license"), (3, " ")]
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string"), license_model)
    lines = {}
    for r in found.collect():
        cue, families, best = lines.setdefault((r.doc_id, r.line), (set(), set(), set()))
        cue.add(r.cue)
        if r.confirmed:
            families.add(r.family)
            best.add(r.probability)
    want = set()
    for doc in {i for i, _ in lines}:
        own = [v for (i, _), v in lines.items() if i == doc]
        want.add((doc, sum(True in c for c, _, _ in own), sum(bool(f) for _, f, _ in own), ",".join(sorted(set().union(*[f for _, f, _ in own]))),
                  max(set().union(*[b for _, _, b in own]), default=None), len(own)))
    per_doc = license_scan.per_document(found)
    assert {tuple(r) for r in per_doc.select("doc_id", "n_cue", "n_confirmed", "families", "probability", "n_lines").collect()} == want
    assert any(n > 1 for _, _, n, *_ in want) and len({d for d, *_ in want}) == 3
    assert "Expand" not in per_doc._jdf.queryExecution().executedPlan().toString()


def test_license_marks_are_looked_for_in_lines_that_may_have_some(spark, license_model):
    """Lines without a mark at an end skip the expression and keep their result; families are united without sorting."""
    parts = ["", " ", "\t", "//", "/*", "*/", "**/", "<!--", "-->", "--", "#", ";;", "%", "!", "|", "rem", "REM ", "remark", "dnl", "x", "a b", "-", "/", ">", "\u2028", "\x85", "\r", "\x0b", "\xa0", "é"]
    lines = spark.createDataFrame([(a + "w" * k + b + c,) for a in parts for b in parts for c in parts for k in (0, 1)], "p string")
    p = F.col("p")
    assert lines.filter(license_scan.bare(p) != F.regexp_replace(p, license_scan.MARKS, "")).count() == 0
    found = license_scan.scan_licenses(spark.createDataFrame([(1, "MIT License")], "doc_id bigint, text string"), license_model)
    plan = license_scan.per_document(found)._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "bit_or" in plan


def test_license_plan_has_no_python(spark, license_model):
    df = spark.createDataFrame([(1, "MIT License")], "doc_id bigint, text string")
    plan = license_scan.scan_licenses(spark.range(1).select(F.col("id").alias("doc_id"), F.lit("MIT License").alias("text")),
                                      license_model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and df is not None


# --- 10: mixing ----------------------------------------------------------------------


def test_rake_meets_feasible_targets():
    rng = np.random.default_rng(4)
    cells = rng.uniform(50, 150, 24)
    keys = [np.arange(24) // 6, np.arange(24) % 6]
    shares = [np.array([0.3, 0.3, 0.2, 0.2]), np.full(6, 1 / 6)]
    w = source_mixing.rake(cells, keys, shares, budget=0.3)
    for key, share in zip(keys, shares, strict=True):
        assert np.allclose(np.bincount(key, weights=w), share, atol=1e-6)
    # Plain proportional fitting, a marginal at a time, gives the same weights.
    x = cells / cells.sum()
    for _ in range(2000):
        for key, share in zip(keys, shares, strict=True):
            x = x * (share / np.bincount(key, weights=x))[key]
    assert np.allclose(w, x, atol=1e-6)
    p = source_mixing.probabilities(cells, w, 0.3)
    assert p.max() <= 1 and abs((p * cells).sum() - 0.3 * cells.sum()) < 1e-6 * cells.sum()


def test_mix_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = source_mixing.mix(docs).select("doc_id", "text", F.col("lang").alias("l"), F.col("source").alias("s"), "mix.*").collect()
    assert len(rows) == docs.count()
    found = topics.fit(docs).predict([r.text for r in rows])
    assert [r.topic for r in rows] == [t or source_mixing.OTHER for t in found] and len(set(found)) == topics.TOPICS
    sizes = [n_words(r.text) for r in rows]
    derived = [plain_targets(v, sizes, source_mixing.POWER) for v in ([r.s for r in rows], found)]
    cells = {}
    for r, n in zip(rows, sizes, strict=True):
        assert r.tokens == n
        assert r.tokens == len(r.text.split()) or any(ord(c) > 127 for c in r.text)
        assert r.lang == (r.l if r.l in source_mixing.LANGUAGE_TARGETS else source_mixing.OTHER)
        cells[r.source, r.lang, r.topic] = cells.get((r.source, r.lang, r.topic), 0) + r.tokens
    order = sorted(k for k in cells if cells[k])
    a = np.array([cells[k] for k in order], dtype=float)
    keys, shares = [], []
    for d, targets in enumerate((derived[0], source_mixing.LANGUAGE_TARGETS, derived[1])):
        names = sorted({k[d] for k in order})
        total = {n: sum(cells[k] for k in order if k[d] == n) for n in names}
        want = source_mixing.wanted_shares(total, targets)
        keys.append(np.array([names.index(k[d]) for k in order]))
        shares.append(np.array([want.get(n, 0.0) for n in names]))
    w = source_mixing.rake(a, keys, shares)
    p = dict(zip(order, source_mixing.probabilities(a, w, source_mixing.BUDGET), strict=True))
    import hashlib

    for r in rows:
        assert abs(r.probability - p[r.source, r.lang, r.topic]) < 1e-9
        u = int(hashlib.md5(f"{r.doc_id}:0".encode()).hexdigest()[:13], 16) / float(1 << 52)
        assert r.sampled == (u < r.probability)
    assert abs(sum(r.tokens for r in rows if r.sampled) / a.sum() - source_mixing.BUDGET) < 0.1


def test_mix_edges(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "src1", 0), (3, "a b c", "xx", "elsewhere", 5), (3, "a b c", "xx", "elsewhere", 5),
            (None, "d e", "en", "src2", 3), (5, "w " * 100_000, "de", "src2", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("mix", F.lit("clash"))
    got = source_mixing.mix(df).collect()
    assert len(got) == len(rows) and all(0 <= r.mix.probability <= 1 for r in got)
    assert {r.mix.lang for r in got if r.doc_id == 3} == {source_mixing.OTHER}
    assert {r.mix.source for r in got} == {source_mixing.OTHER, "elsewhere", "src2"}  # src1 has no tokens
    assert len({r.mix.sampled for r in got if r.doc_id == 3}) == 1
    assert source_mixing.mix(df.limit(0)).count() == 0


def test_derived_targets_follow_the_largest_categories(spark):
    rows = [("a", 900), ("b", 100), ("a", 700), ("c", 100), (None, 50), (source_mixing.OTHER, 7), ("d", 0), ("e", 9), ("e", None)]
    sums = spark.createDataFrame(rows, "source string, tokens bigint")
    assert source_mixing.derived_targets(sums, "source") == {"a": 40.0, "b": 10.0, "c": 10.0, "e": 3.0}
    assert source_mixing.derived_targets(sums, "source", power=0.0, most=2) == {"a": 1.0, "b": 1.0}  # ties: smallest name
    assert source_mixing.derived_targets(sums.limit(0), "source") == {}


def test_many_sources_share_what_the_listed_leave(spark, monkeypatch):
    monkeypatch.setattr(source_mixing.derived_targets, "__defaults__", (0.5, 3))
    df = spark.createDataFrame([(i, "word " * (1 + i % 40), "en", f"s{i % 40}") for i in range(800)], "doc_id long, text string, lang string, source string")
    got = source_mixing.mix(df, [source_mixing.Marginal("source", F.col("source"))]).select("doc_id", "mix.*").collect()
    assert {r.source for r in got} == {"s37", "s38", "s39", source_mixing.OTHER} and len(got) == 800
    weights = {r.source: r.weight for r in got}
    assert abs(sum(weights.values()) - 1) < 1e-9 and abs(weights[source_mixing.OTHER] - 703 / 820) < 1e-9


def test_topics_part_texts_of_different_words(spark):
    rng = np.random.default_rng(1)
    vocabulary = [[f"{a}{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)] for a in ("kl", "mn", "pr")]
    truth = rng.integers(0, 3, 400)
    texts = [" ".join(rng.choice(vocabulary[t], 40)) for t in truth]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900 + i, texts[0]) for i in range(300)], "doc_id bigint, text string")
    model = topics.fit(df, topics=3)
    found = model.predict(texts)
    assert all(len({f for f, t in zip(found, truth, strict=True) if t == k}) == 1 for k in range(3)) and len(set(found)) == 3
    again = topics.fit(df.repartition(7), topics=3)
    assert (again.centroids == model.centroids).all() and again.predict(texts) == found
    got = df.select("text", model.topic().alias("topic")).collect()
    assert [r.topic for r in got] == model.predict([r.text for r in got])
    assert model.predict([None, "", "12 !", "é", texts[0] * 30_000]) == [None, None, None, model.predict(["é"])[0], found[0]]
    assert topics.fit(df.limit(0)).predict(["a"]) == [None]


def test_topics_learn_from_every_text(spark):
    """Weights, directions and the order by size are those of all 12,000 texts, restated in plain arrays."""
    rng = np.random.default_rng(2)
    words = np.array([f"{a}{chr(97 + i)}{chr(97 + j)}" for a in ("kl", "mn") for i in range(8) for j in range(8)])
    truth = (np.arange(12_000) % 3 == 0).astype(int)
    texts = [" ".join(words[64 * t + rng.integers(0, 64, 20)]) for t in truth]
    model = topics.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), topics=2)
    counts = np.unique(np.stack([topics.word_counts(t) for t in texts]), axis=0)
    assert np.allclose(model.weights, np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1)
    x = topics.unit(np.log1p(counts.astype(np.float64)) * model.weights)
    own = (x @ model.centroids.T).argmax(axis=1)
    want = topics.unit(np.stack([x[own == k].sum(axis=0) for k in (0, 1)]))
    assert np.abs(want - model.centroids).max() < 1e-4
    assert model.predict(texts) == [f"t{t}" for t in truth]


def test_word_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Wörter, words 12 und\nmehr; x " * 40
    whole = topics.word_counts(text)
    assert whole.sum() == 5 * 40
    assert (topics.word_counts(text.upper()) == whole).all()
    for chunk in (8, 11, 64):
        monkeypatch.setattr(topics, "_CHUNK", chunk)
        assert (topics.word_counts(text) == whole).all()
    assert topics.word_counts("a" * 100).sum() == 2 and topics.word_counts("12 " * 50) is None
