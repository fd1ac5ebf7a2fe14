"""Operators 1, 2 and 8 against brute force: copies, near copies, ties, nulls, empty tables."""

import random

import pandas as pd
import pytest
from helpers import DOCS, edit_distance, jaccard_components, repeated_lines, shingle_set
from oracle_check import compare
from pyspark.sql import functions as F

from trendcast.llm import common, exact_dedup, hashing, line_dedup, ngram_join
from trendcast.llm.common import table
from trendcast.llm.components import components


def _prose(rng, n, words=60):
    return " ".join(rng.choice(["ab", "cde", "Fgh", "ij", "klmno", "pq"]) + str(rng.randint(0, words)) for _ in range(n))


# --- 8: exact dedup ------------------------------------------------------------------


def test_exact_dedup_matches_oracle(spark, con, sf_dir):
    res = compare(spark, con, sf_dir, "op8", exact_dedup.op8_exact_dedup, exact_dedup.ORACLE_SQL)
    assert res["status"] == "ok" and res["rows"] > 0, res


@pytest.mark.parametrize("max_bits", [1 << 12, 1 << 26])
def test_exact_dedup_edges(spark, max_bits):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (9, "a b"), (3, "a b"), (None, "a b"), (None, "only"), (7, None), (8, ""),
            (10, " "), (11, "A b"), (12, "x" * 300_000)] + [(100 + i, f"t{i}") for i in range(3000)]
    df = spark.createDataFrame([(i, t, None, "s", 1) for i, t in rows], DOCS).withColumn("kept", F.lit("clash"))
    got = exact_dedup.exact_dedup(df, bits_per_row=1, max_bits=max_bits).collect()
    assert len(got) == len(rows)
    ab = [r for r in got if r.group_size == 6]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.kept) for r in ab) == [
        (False, 3, False), (False, 3, True), (False, 5, False), (False, 9, False), (False, 9, False), (True, 0, False)]
    assert {r.keep_id for r in ab} == {3}
    one = {r.doc_id: r for r in got if r.doc_id in (7, 8, 10, 11, 12)}
    assert (one[7].kept, one[8].kept, one[8].keep_id, one[8].group_size) == (True, False, 7, 2)
    assert one[10].group_size == one[11].group_size == one[12].group_size == 1
    lone = [r for r in got if r.doc_id is None and r.group_size == 1]
    assert len(lone) == 1 and lone[0].kept and lone[0].keep_id is None
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def test_ranges_of_digests_keep_the_filter_sharp(spark):
    """At forty times the load that one filter of this size is made for: right results, few unique rows shuffle."""
    n, max_bits = 10_240, 1 << 12                      # 16 bits a row: one filter is made for 256 rows
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.when(F.col("id") % 50 == 0, F.lit(0)).otherwise(
        F.col("id")).cast("string")).alias("text"))
    got = exact_dedup.exact_dedup(docs, max_bits=max_bits)
    counts = got.agg(F.count("*").alias("rows"), F.count_if("kept").alias("kept"), F.max("group_size").alias("most")).first()
    equal = -(-n // 50)
    assert tuple(counts) == (n, n - equal + 1, equal)
    keys = exact_dedup.text_keys(docs)
    flagged = exact_dedup._flagged(keys, n, exact_dedup.BITS_PER_ROW, max_bits, exact_dedup.HASHES)
    unique = flagged.join(docs.select("doc_id", "text"), "doc_id").filter("text != 'text 0'")
    share = unique.agg(F.avg(F.col("maybe").cast("int"))).first()[0]
    assert flagged.count() == n and share < 0.05
    assert flagged.filter("doc_id % 50 = 0 and not maybe").isEmpty()


def test_exact_dedup_unique_rows_do_not_shuffle(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id bigint, text string")
    keys = exact_dedup.text_keys(df)
    cells = exact_dedup.repeated_cells(keys, 1 << 16, 2)
    assert exact_dedup.probe(keys, cells, 1 << 16, 2).filter("maybe").count() <= 2


# --- 1: n-gram join ------------------------------------------------------------------


def _near_copies(seed, families=12, members=9):
    rng = random.Random(seed)
    out = []
    for _ in range(families):
        base = _prose(rng, rng.choice([3, 8, 40, 120, 300])).split()
        for _ in range(members):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5, 9])):
                if len(w) > 1:
                    w[rng.randrange(len(w))] = rng.choice(["zz", "yy", "xx"]) + str(rng.randint(0, 99))
            out.append(rng.choice([" ", "  ", "\n"]).join(w).upper() if rng.random() < 0.2 else " ".join(w))
    return [(3 * i + 1, t) for i, t in enumerate(out)]


def test_ngram_join_matches_brute_force(spark, monkeypatch):
    rows = _near_copies(4) + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE"), (1005, "é one")]
    long = " ".join(f"w{i}" for i in range(30_000))
    rows += [(2000, long), (2001, long + " tail"), (2002, long[: len(long) // 2])]
    df = spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows], DOCS).withColumn("key", F.lit(1))
    want = jaccard_components(rows)
    for block in (1 << 22, 400):  # also with clusters cut into many blocks
        monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df).collect()}
        assert got == want


def test_ngram_join_edges(spark):
    rows = [(None, "a b c d e"), (4, "a b c d e"), (2, "A B C D E"), (2, "A B C D E"), (6, "q r s t u v")]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [
        (0, 1, 0), (2, 1, 2), (2, 1, 2), (4, 1, 2), (6, 2, 6)]
    assert ngram_join.ngram_join(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_signature_tree_finds_all_links():
    rng = random.Random(7)
    docs = [t for _, t in _near_copies(9, families=30, members=12)]
    sets = [s for s in (hashing.shingles(t) for t in docs) if len(s)]
    rng.shuffle(sets)
    import numpy as np

    for side in (np.zeros(len(sets), np.int64), np.arange(len(sets)) % 2):
        label = list(range(len(sets)))
        for i, j in ngram_join.find_links(sets, side):
            a, b = label[i], label[j]
            label = [a if x == b else x for x in label]
        for i in range(len(sets)):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if side.max() == 0 and ngram_join.linked(common, len(sets[i]), len(sets[j])):
                    assert label[i] == label[j]


def test_shingle_hashes_follow_the_sets():
    rng = random.Random(1)
    for _ in range(50):
        t = _prose(rng, rng.randint(0, 30), words=3)
        assert len(hashing.shingles(t)) == len(shingle_set(t))
        assert hashing.set_key(hashing.shingles(t)) == hashing.set_key(hashing.shingles(" " + t.upper().replace(" ", "\t\n")))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7000), (7000, 200), (5, 5), (-3, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 7000: 100, 200: 100, 300: -3}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_components_of_few_edges_take_no_rounds(spark, monkeypatch):
    """A long chain that a task holds is one table more than its edges; dealt into parts it has the same components."""
    import trendcast.llm.components as module
    written, real = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: written.append(label) or real(df, label))
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 7000), (7000, 800)], "u bigint, v bigint")
    want = {**{i: 0 for i in range(1, 301)}, 7000: 800, 900: 800}
    assert {r.node: r.component for r in components(edges).collect()} == want and len(written) == 2
    assert {r.node: r.component for r in components(edges, rows_a_part=120).collect()} == want and len(written) > 4


def test_long_texts_come_in_small_batches(spark, tmp_path):
    """A worker never holds thousands of long texts at once."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("text "), 800).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"n": [int(b["text"].str.len().sum())]})

    got = [r.n for r in table(spark, str(tmp_path), "documents").select("text").mapInPandas(sizes, "n bigint").collect()]
    assert sum(got) == 3000 * 4000 and max(got) <= 5 << 20


# --- 2: line dedup -------------------------------------------------------------------


def _lines(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh  ") for _ in range(rng.randint(28, 70))) for _ in range(30)]
    docs = []
    for d in range(80):
        lines = []
        for _ in range(rng.randint(0, 5)):
            x = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                at = rng.randrange(len(x))
                x[at:at + rng.randint(0, 1)] = rng.choice(["", "é", "😀", "z"])
            lines.append("".join(x))
        docs.append((d * 3, "\n".join(lines)))
    return docs


def test_line_dedup_matches_brute_force(spark, monkeypatch):
    docs = _lines(2) + [(1, None), (2, ""), (4, "\n\n"), (None, "y" * 50), (5, "y" * 50 + "\r\n" + "y" * 51), (7, "z" * 200_000)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DOCS).withColumn("form", F.lit(0))
    want = repeated_lines(docs, line_dedup.MAX_EDITS, line_dedup.MIN_CHARS, line_dedup.TRIM)
    for block in (line_dedup.BLOCK, 3):  # also with every key crowded
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        removed = line_dedup.duplicate_lines(df)
        assert {(r.doc_id, r.line, r.near) for r in removed.collect()} == want
    cuts = {}
    for i, n, _ in want:
        cuts.setdefault(i, set()).add(n)
    cleaned = line_dedup.without_lines(df, removed).select("doc_id", "text", "form").collect()
    assert sorted(((r.doc_id is None, r.doc_id), r.text) for r in cleaned if r.doc_id is not None) == sorted(
        ((False, i), t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in cuts.get(i, ())))
        for i, t in docs if i is not None)
    assert len(cleaned) == len(docs)
    assert line_dedup.duplicate_lines(df.limit(0)).count() == 0


def test_line_dedup_takes_equal_lines_of_any_length(spark):
    rng = random.Random(6)
    short = ["".join(rng.choice("abcde ") for _ in range(rng.randint(1, 31))) for _ in range(40)] + ["}", "é", "to.", "of."]
    docs = [(d, "\n".join(rng.choice(short) + rng.choice(["", "", "", "z"]) for _ in range(6))) for d in range(60)]
    docs += [(100, "All rights reserved.\n}\n \n\n"), (101, "\t}\nAll rights reserved.\n"), (102, "All right reserved.")]
    equal = repeated_lines(docs, 0, 1, line_dedup.TRIM, lambda a, b, n: False)
    near = {x for x in repeated_lines(docs, line_dedup.MAX_EDITS, line_dedup.MIN_CHARS, line_dedup.TRIM) if x[2]}
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DOCS)
    got = {(r.doc_id, r.line, r.near) for r in line_dedup.duplicate_lines(df).collect()}
    assert got == equal | near
    assert (101, 1, False) in got and (101, 0, False) in got and (102, 0, True) in got


def test_edit_distance_limit():
    rng = random.Random(3)
    for _ in range(4000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "c"])
        b = "".join(b)
        for limit in range(5):
            assert line_dedup.within_edits(a, b, limit) == (edit_distance(a, b) <= limit)


def test_seen_numbers_and_parts(spark):
    seen = common.Seen(most=3)
    assert seen.fresh([1, 2, 1]) == [True, True, False] and seen.fresh([2, 3, 4]) == [False, True, True]
    assert seen.fresh([1]) == [True]                    # forgotten when there were more than three
    n = common.parallelism(spark)
    assert common.parts_for(spark, 0) == n and common.parts_for(spark, 10 ** 9) == -(-10 ** 9 // common.ROWS_A_PART)
