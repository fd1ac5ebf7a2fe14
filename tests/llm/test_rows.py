"""Operators 4, 5, 7 and 9: row-wise rules, round trips and held-out accuracy."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import DOCS, secret_bases
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendcast.llm import chat_format, language_id, packing, secret_scan

# --- 4: secret scan ------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "TOKEN", "api_key", "ApiKey", "secret", "=", ":", " ", '"', "'", "abcdef", "0123456789abcdef",
                                 "AKIA", "ABCDEFGHIJKLMNOP", "deadbeef", "é", "\n", "ſecret", "x", "$x", "{", "}"]), max_size=14).map("".join))
def test_base_spans_follow_the_patterns(text):
    got = [f"{s.kind}:{s.start}:{s.end}" for s in secret_scan.scan_text(text) if s.kind != "literal"]
    assert got == secret_bases(text)


@pytest.mark.parametrize(("text", "name", "literal"), [
    ('x = "abcdefgh12Q"\npassword = x\n', "password", "abcdefgh12Q"),
    ("export DB_PASSWD='s3cr3t-Value'\n", "DB_PASSWD", "s3cr3t-Value"),
    ('{"client_secret": "Zx9" + "kLmN0pQr"}', "client_secret", 'Zx9" + "kLmN0pQr'),
    ("aws:\n  secretAccessKey: wJalrXUtnFEMI/K7MDENG\n", "secretAccessKey", "wJalrXUtnFEMI/K7MDENG"),
    ("KEY=9f8e7d6c5b4a\nauth_token = ${KEY}\n", "auth_token", "9f8e7d6c5b4a"),
])
def test_assignment_lexer(text, name, literal):
    at = text.index(literal)
    found = [s for s in secret_scan.literal_spans(text) if (s.start, s.end) == (at, at + len(literal))]
    assert found and found[0].name == name


@pytest.mark.parametrize(("text", "name", "literal"), [
    ('config["password"] = "Zx9kLmN0pQr"', "password", "Zx9kLmN0pQr"),
    ("os.environ['API_KEY'] = 'q7Rt-55xyZ'", "API_KEY", "q7Rt-55xyZ"),
    ('password: str = "hunter2xyz"', "password", "hunter2xyz"),
    ('api_token: Optional[Dict[str, str]] = "hunter2xyz"', "api_token", "hunter2xyz"),
    ('val token: String = "hunter2xyz"', "token", "hunter2xyz"),
    ('const token: string | null = "hunter2xyz";', "token", "hunter2xyz"),
    ('var apiKey string = "hunter2xyz"', "apiKey", "hunter2xyz"),
    ('note: password = "hunter2xyz"', "password", "hunter2xyz"),
    ('password = (\n    "Zx9kLm"\n    "N0pQr7"\n)\n', "password", 'Zx9kLm"\n    "N0pQr7'),
    ('password = "Zx9kLm" +\n    "N0pQr7"\n', "password", 'Zx9kLm" +\n    "N0pQr7'),
    ('password = "Zx9kLm"\n  + "N0pQr7"\n', "password", 'Zx9kLm"\n  + "N0pQr7'),
    ('password = \\\n    "hunter2xyz"\n', "password", "hunter2xyz"),
    ('"password":\n    "hunter2xyz",\n', "password", "hunter2xyz"),
    ("password:\n  hunter2xyz\n", "password", "hunter2xyz"),
])
def test_lexer_subscripts_types_and_line_ends(text, name, literal):
    at = text.index(literal)
    found = secret_scan.literal_spans(text)
    assert [(s.name, s.start, s.end) for s in found] == [(name, at, at + len(literal))]


def test_lexer_does_not_run_lines_together():
    for text in ("credentials:\n  username: bob\n", 'token: String\n', 'x = "Zx9kLmN0pQr"\n"password": 5\n', "f(token: int, size = 'Zx9kLmN0pQr')"):
        assert not [s for s in secret_scan.literal_spans(text) if s.end - s.start > 6], text


def test_lexer_leaves_plain_values_alone():
    for text in ('color = "blue green"', "password = changeme", "title: The story of a secret", "a == b", "token: none"):
        assert not secret_scan.literal_spans(text)


def test_secret_spans_do_not_depend_on_line_or_type_length():
    literal = "q7Zx9LmP2vRt8Kw"
    for pad in (10, 5_000, 200_000):
        head = "f(1);" * (pad // 5)
        for text in (f'{head}password =\n    "{literal}"', f'{head}secret = "{literal[:7]}" +\n  "{literal[7:]}"',
                     f'password = ({" " * pad}\\\n  "{literal}"', f'{head}api_key = ("{literal[:7]}"\n "{literal[7:]}")'):
            at = text.index(literal[:7])
            assert [s for s in secret_scan.literal_spans(text) if s.start == at and s.end >= at + len(literal)], text[-80:]
    for n in (1, 10, 300):
        kind = "Map[str, " * n + "int" + "]" * n
        text = f'secret_token: {kind} = "{literal}"'
        assert [(s.name, s.start) for s in secret_scan.literal_spans(text)] == [("secret_token", text.index(literal))], n


def test_secret_lexer_takes_time_in_proportion_to_a_line():
    import time

    def seconds(text):
        start = time.perf_counter()
        secret_scan.scan_text(text)
        return time.perf_counter() - start

    for unit in ("a=b;", "= ", "=( ", "x:int=", "a:[b,", '"" +', "=   ", "' = \"", ":="):
        small = min(seconds(unit * (40_000 // len(unit))) for _ in range(3))
        assert seconds(unit * (320_000 // len(unit))) < 24 * small + 0.5, unit


def test_secret_query_shape(spark):
    rows = [(1, None), (2, ""), (3, "é token = abcdef1234"), (None, "AKIA" + "A" * 16), (5, "a" * 400_000)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).withColumn("secrets", F.lit(1))
    got = secret_scan.digest(secret_scan.scan_secrets(df)).collect()
    by = {r.doc_id: r for r in got}
    empty = hashlib.sha256(b"").hexdigest()
    assert by[1].base_sha256 == by[2].base_sha256 == empty and by[1].spans == ""
    assert (by[3].n_assign, by[3].spans) == (1, "assign:2:20,literal:10:20")
    assert by[3].base_sha256 == hashlib.sha256(b"assign:2:20").hexdigest()
    assert by[None].n_access == 1 and by[5].n_hex == 1
    assert secret_scan.scan_secrets(df.limit(0)).count() == 0


# --- 5: chat format ------------------------------------------------------------------

_CONTROLS = st.lists(st.sampled_from(["\\", "### ", "###", "</turn>", "\n", "a", " ", "Assistant: ", "role=", "é"]), max_size=9).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(_CONTROLS, _CONTROLS), max_size=4))
def test_turns_round_trip(turns):
    rendered = "".join(chat_format.render_turn(r, t) for r, t in turns)
    assert [(r, t) for r, t, _, _ in chat_format.parse(rendered)] == turns


def test_chat_read_back(spark):
    rows = [(1, 1, "assistant", "b </turn> é"), (1, 0, "user", None), (2, None, None, "x"), (2, 0, "assistant", ""),
            (None, 3, "assistant", "null id"), (3, 0, "assistant", "y" * 300_000), (1, 1, "assistant", "b </turn> é")]
    rows += [(4, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(2500)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, rendered int")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv in got:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat_format.render_turn(a, b)) for a, b in turns)
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).count() == 0


def test_chat_query_has_the_planted_conversation(spark, sf_dir):
    got = chat_format.op5_chat_format(spark, sf_dir).filter("conv_id = -7").collect()
    text = r"\### Assistant: </turn> ok"
    assert [(r.n_turns, r.loss_chars, r.loss_sha256) for r in got] == [(2, len(text), hashlib.sha256(text.encode()).hexdigest())]


# --- 7: packing ----------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 5000))
def test_cut_lengths(n):
    cuts = packing.cut_lengths(n)
    assert sum(cuts) == n and min(cuts) > 0
    assert all(1024 % c == 0 for c in cuts if c >= packing.GRAIN)


def test_packing_keeps_every_id_once(spark):
    rng = random.Random(5)
    words = ["the", "Éa", "ß", "12", "\n", "  ", "日本", "<|endoftext|>", "x" * 50]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 30, 700, 3000]))) for _ in range(60)] + [None, "", "a b " * 300_000]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, "no id", None, None, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("ids", F.lit("clash")).repartition(3)
    got = packing.pack(df).collect()
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc_id, text, *_ in rows:
        want = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        parts = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert [p.start for p in parts] == list(np.cumsum([0] + [p.length for p in parts])[:-1])
        assert b"".join(bytes(p.ids) for p in parts) == want.tobytes()
        assert {p.doc_tokens for p in parts} == {len(want)}
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding < 4 * 1024
    digests = packing.with_digest(packing.pack(df)).filter("doc_id = 3").collect()
    assert {(d.start, d.ids_crc32) for d in digests} == {(p.start, zlib.crc32(bytes(p.ids))) for p in by_doc[3]}
    assert packing.pack(df.limit(0)).count() == 0


# --- 9: language ID ------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.filter(~language_id.held_out()), sample_per_language=200)
    found = language_id.identify(docs, model).filter(language_id.held_out()).select("lang", "language.*").collect()
    assert len(found) > 150
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)
    assert sum(r.rejected for r in found) <= 0.01 * len(found)
    strange = [(1, "Съешь ещё этих мягких французских булок да выпей чаю " * 5), (2, None), (3, ""), (4, "123 !!"), (5, "é"),
               (6, "the and " * 300_000)]
    got = {r.doc_id: r.language for r in language_id.identify(
        spark.createDataFrame(strange, "doc_id bigint, text string").withColumn("language", F.lit(0)), model).collect()}
    assert got[1].rejected and got[1].lang_pred in model.languages
    for i in (2, 3, 4):
        assert got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0
    assert got[5].lang_pred != "und" and 0 <= got[6].score <= 1
    assert language_id.identify(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("left_out", ["de", "en", "es", "fr"])
def test_left_out_language_is_mostly_rejected(spark, left_out):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.filter(~language_id.held_out() & (F.col("lang") != left_out)))
    found = language_id.identify(docs, model).select("lang", language_id.held_out().alias("held"), "language.rejected").collect()
    strange = [r.rejected for r in found if r.lang == left_out]
    known = [r.rejected for r in found if r.lang != left_out and r.held]
    assert np.mean(strange) >= 0.8
    assert np.mean(known) <= 0.02


def test_language_query_against_plain_python(spark, sf_dir):
    """The registered query: every document, predictions restated from the model in plain loops."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.train(docs.filter(~language_id.held_out()))
    got = {r.doc_id: r for r in language_id.op9_language_id(spark, sf_dir).collect()}
    rows = docs.select("doc_id", "text", "lang").collect()
    assert len(got) == len(rows)
    for r in rows:
        vector = [float(np.float32(np.log1p(np.float32(n)))) * float(w) for n, w in zip(language_id.gram_counts(r.text), model.idf, strict=True)]
        norm = sum(x * x for x in vector) ** 0.5
        cosines = [sum(a * float(b) for a, b in zip(vector, c, strict=True) if a) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        q = got[r.doc_id]
        assert q.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert abs(q.score - cosines[best]) < 1e-4
        assert q.lang_pred in {model.languages[i] for i, c in enumerate(cosines) if cosines[best] - c < 1e-4}
    held = [r for r in rows if got[r.doc_id].held_out]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)


def test_language_learns_the_most_frequent_labels(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 2)
    rows = [(i, f"{w} {w}{w} text", w) for i, w in enumerate(["aba"] * 5 + ["cdc"] * 4 + ["bcb"] * 4 + ["zzz"])]
    docs = spark.createDataFrame(rows + rows[:3] + [(50, "q", None)], "doc_id bigint, text string, lang string")
    model = language_id.train(docs)
    assert set(model.languages) == {"aba", "bcb"}  # ties go to the smallest
    assert {r.language.lang_pred for r in language_id.identify(docs, model).collect()} <= {"aba", "bcb"}


def test_language_model_learns_from_every_text(spark):
    """Frequencies, centroids and limits are those of all 4,000 labelled texts of a language, restated in plain arrays."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join("".join(rng.choice(list(("abcdef", "stuvwx")[i % 2]), 5)) for _ in range(6)), "pq"[i % 2]) for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.train(df)
    again = language_id.train(df.repartition(5))
    assert (model.centroids == again.centroids).all() and (model.reject_below == again.reject_below).all()
    counts = np.stack([language_id.gram_counts(t) for _, t, _ in rows])
    assert np.allclose(model.idf, np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 1)
    one = language_id.train(df, centroids=1)
    x = one.vectors(counts).astype(np.float64)
    for k, lang in enumerate(one.languages):
        mean = x["pq".index(lang)::2].sum(axis=0)
        assert np.abs(one.centroids[k] - mean / np.linalg.norm(mean)).max() < 1e-4
    for q in (0.0, 0.01, 0.5, 0.9, 1.0):
        values, often = rng.integers(0, 50, 40) / 50, rng.integers(1, 9, 40)
        assert abs(language_id._quantile(values, np.zeros(40), often, 0, q) - np.quantile(np.repeat(values, often), q)) < 1e-12


def test_language_model_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    model = language_id.train(docs)
    assert model.languages == []
    assert {r.language.lang_pred for r in language_id.identify(docs, model).collect()} == {"und"}


def test_gram_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Wörter, words 12 und mehr; " * 40
    whole = language_id.gram_counts(text)
    for chunk in (1, 7, 64):
        monkeypatch.setattr(language_id, "_CHUNK", chunk)
        assert (language_id.gram_counts(text) == whole).all()
