"""The pipeline's stages: column contract, decisions, empty and odd tables."""

import corpus_pipeline
import pytest
from helpers import DOCS, jaccard_components, n_words, plain_sample, plain_targets, repeated_lines, shingle_set
from pyspark.sql import functions as F

from trendcast.llm import language_id, line_dedup, source_mixing, topics
from trendcast.llm.common import discard, materialize, release
from trendcast.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def repeated_places(rows):
    """Equal lines of any length above 0, and near ones from ``MIN_CHARS`` characters on."""
    equal = repeated_lines(rows, 0, 1, line_dedup.TRIM, lambda a, b, n: False)
    return equal | repeated_lines(rows, line_dedup.MAX_EDITS, line_dedup.MIN_CHARS, line_dedup.TRIM, line_dedup.within_edits)


def test_stages_on_the_small_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "mixing", "packing"]
    counts = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"test_{name}")
        if i < 4:
            assert docs.columns == COLUMNS and docs.schema == before.schema
        counts.append(docs.count())
        if name == "near_duplicates":
            sets = [s for s in (shingle_set(r.text) for r in docs.collect()) if s]
            assert not [1 for k, a in enumerate(sets) for b in sets[:k] if 100 * len(a & b) >= 75 * len(a | b)]
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > counts[4] > 0
    assert counts[1] == counts[0]  # all of these are clean documents in known languages
    tokens = docs.selectExpr("sum(length) as n", "count(distinct sequence_id) as s").first()
    assert tokens.n > 0.95 * 1024 * tokens.s


def test_pipeline_matches_plain_python(spark, sf_dir):
    """run() against each stage's rule in plain loops (the language model keeps all of these documents)."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    gone = {(i, n) for i, n, _ in repeated_places([r[:2] for r in rows])}
    cut = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone), lang, source) for i, t, lang, source in rows]
    cut = [r for r in cut if r[1].strip(line_dedup.TRIM)]
    first = jaccard_components([r[:2] for r in cut])
    alone = [r for r in cut if first[r[0]][1] == r[0]]
    model = topics.fit(spark.createDataFrame([r[:2] for r in alone], "doc_id bigint, text string"))
    alone = [(*r, t) for r, t in zip(alone, model.predict([r[1] for r in alone]), strict=True)]
    sizes = [n_words(r[1]) for r in alone]
    derived = [plain_targets([r[k] for r in alone], sizes, source_mixing.POWER) for k in (3, 4)]
    targets = (derived[0], source_mixing.LANGUAGE_TARGETS, derived[1])
    taken = plain_sample(alone, targets, source_mixing.OTHER, source_mixing.BUDGET)

    encoder = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = {i: [*encoder.encode(t, add_special_tokens=False).ids, 0] for i, t, *_ in alone if i in taken}
    got = {}
    for r in sorted(corpus_pipeline.run(spark, sf_dir).collect(), key=lambda r: (r.doc_id, r.start)):
        got.setdefault(r.doc_id, []).extend(memoryview(bytes(r.ids)).cast("I").tolist())
    assert got == want and len(want) > 20


def test_line_stage_takes_equal_lines_of_any_length(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    gone = repeated_places(rows)
    assert any(len(t.split("\n")[n].strip(line_dedup.TRIM)) < line_dedup.MIN_CHARS for i, t in rows for j, n, _ in gone if i == j)
    places = {(i, n) for i, n, _ in gone}
    cut = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in places) for i, t in rows}
    got = {r.doc_id: r.text for r in line_dedup.without_repeats(spark, docs, sf_dir).collect()}
    assert got == {i: t for i, t in cut.items() if t.strip(line_dedup.TRIM)}


def test_language_stage_fills_missing_labels(spark, sf_dir):
    """A document without a label takes the predicted one; given labels stay, wrong ones too."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("lang is not null")
    changed = docs.withColumn("lang", F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") == 1, "de").otherwise(F.col("lang")))
    got = {r.doc_id: r.lang for r in language_id.keep_identified(spark, changed, sf_dir).collect()}
    want = {r.doc_id: "de" if r.doc_id == 1 else r.lang for r in docs.collect()}
    assert len(got) >= 0.95 * len(want) and all(got[i] is not None for i in got)
    assert {i: v for i, v in got.items() if i % 7} == {i: want[i] for i in got if i % 7}
    assert sum(got[i] == want[i] for i in got) >= 0.97 * len(got)


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "src1", 0), (3, "the and of the thing is with the", "en", None, 9),
            (3, "the and of the thing is with the", "en", None, 9), (None, "a the of and that", None, "src0", 1), (4, "123", "de", "src3", 3)]
    for name, data in (("odd", rows), ("empty", [])):
        spark.createDataFrame(data, DOCS).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert {"doc_id", "start", "length", "sequence_id"} <= set(out.columns)
        assert out.count() <= 2 * len(data)


def test_no_task_needs_a_second_kind_of_python_worker(spark, sf_dir):
    """An executor keeps as many workers as ever ran at once: languages are predicted once a row, cells need no Python rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plans = {name: dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)._jdf.queryExecution().executedPlan().toString()
             for name in ("language_id", "mixing")}
    assert plans["language_id"].count("ArrowEvalPython [predict(") == 1
    assert "ExistingRDD" not in plans["mixing"]


CLASHING = ["language", "mix", "_id", "_cut", "_maybe", "_had", "_cell", "_word", "_mask", "label", "key", "n", "component_id", "form",
            "_mix_0", "_mix_tokens", "tokens", "probability", "a`b", "x.y", "_columns_of_the_caller"]


@pytest.mark.parametrize("name", ["language_id", "line_dedup", "near_duplicates", "mixing"])
def test_columns_of_any_name_come_out_unchanged(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 60")
    given = docs.select(F.lit("mine").alias("first"), *docs.columns, *[F.concat(F.lit(f"{c}:"), "doc_id").alias(c) for c in CLASHING])
    got = stage(spark, given, sf_dir)
    assert got.columns == given.columns
    plain = {r["doc_id"]: r["text"] for r in stage(spark, docs, sf_dir).collect()}
    rows = got.collect()
    assert {r["doc_id"]: r["text"] for r in rows} == plain and plain
    assert all(r[c] == f"{c}:{r['doc_id']}" for r in rows for c in CLASHING) and {r["first"] for r in rows} == {"mine"}


def test_learned_vectors_leave_the_disk(spark, sf_dir):
    """The vectors that models are learned from go when the model is there; given tables stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 60")
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark, "llm", spark.sparkContext.applicationId))

    def scratch():
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return fs.getContentSummary(path).getFileCount() if fs.exists(path) else 0

    before = scratch()
    assert language_id.train(docs).languages and topics.fit(docs).names
    assert scratch() == before
    discard(docs)
    assert docs.count()


def test_release_deletes_scratch_tables(spark):
    path = shared_dir(spark, "llm", spark.sparkContext.applicationId)
    materialize(spark.range(3).toDF("x"), "scratch")
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path))
    release(spark)
    assert not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path))


def test_entry_registers_every_operator():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert [len([n for n in names if n.startswith(f"op{i}_")]) for i in range(1, 14)] == [1] * 13
    assert "op8_exact_dedup" in entry.oracle_sql()
