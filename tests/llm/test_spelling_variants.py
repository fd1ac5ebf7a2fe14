"""Operator 12 against all pairs of words and a plain count of the words."""

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import DOCS, LOWER

from trendcast.llm import spelling_variants as sv


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    same = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[same + (len(a) == len(b)):] == b[same + 1:]


def plain_variants(count, factor=10):
    """{word: (form, root, n, n_near, form_n)}; near words through the words without one letter, checked."""
    holes = {}
    for w in count:
        for i in range(len(w) + 1):
            for key in {(i, w[:i] + w[i + 1:]) if i < len(w) else None, (i, w)} - {None}:
                holes.setdefault(key, []).append(w)
    near = {w: set() for w in count}
    for group in holes.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= factor * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), count[form[w]] if form[w] else None) for w, n in count.items()}


def plain_words(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                count[w] += 1
    return {w: n for w, n in count.items() if n >= 2}


def rows_of(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_query_matches_plain_python(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_variants(plain_words(docs))
    df = sv.op12_spelling_variants(spark, sf_dir)
    assert rows_of(df) == want and df.count() == len(want) > 1000
    assert any(v[0] for v in want.values())


@pytest.mark.parametrize(("max_words", "max_rest"), [(sv.MAX_WORDS, sv.MAX_REST), (3, 32), (1, 2)])
def test_all_pairs_of_dense_words(spark, max_words, max_rest):
    """Runs of one letter, shared halves, one hot beginning and one hot end; also with partitions that are passed on again and again."""
    rng = random.Random(2)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(2, 9))) for _ in range(150)}
    words |= {"a" * n for n in range(2, 14)} | {"prefixes" + "".join(rng.choice("xyz") for _ in range(rng.randrange(6))) for _ in range(60)}
    words |= {"".join(rng.choice("xyz") for _ in range(rng.randrange(1, 6))) + "endings" for _ in range(60)}
    count = {w: rng.choice([2, 3, 30, 400, 400, 5000]) for w in sorted(words)}
    vocab = spark.createDataFrame([(w, n, "clash") for w, n in count.items()], "word string, n bigint, head string")
    got = rows_of(sv.variants(vocab, max_words=max_words, max_rest=max_rest))
    assert got == plain_variants(count)


def test_near_pairs_come_once():
    rng = random.Random(4)
    longer = sorted({"".join(rng.choice("ab") for _ in range(6)) for _ in range(40)})
    shorter = sorted({"".join(rng.choice("ab") for _ in range(5)) for _ in range(25)})
    got = list(sv.near_pairs(shorter, longer, ""))
    want = {tuple(sorted((a, b))) for a in longer for b in longer + shorter if one_edit(a, b)}
    assert {tuple(sorted(p)) for p in got} == want and len(got) == len(want)


def test_acceptor_is_minimal():
    v = sv.Acceptor()
    words = sorted({a + b + c for a in "abc" for b in "xy" for c in "pq"})
    assert v.language(v.add(words)) == words and len(v.arcs) == 4


def test_words_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "Straße STRASSE ÀÉÎÕÜ×÷ab ab-cdefghi x1abcdefgh"), (None, "cdefghi abcdefgh Āabcdefg"),
            (4, "z" * 20000 + " " + "z" * 20000), (4, "z" * 20000 + "y"), (4, "z" * 20000 + "y")] + [(5, "Cdefghj " * 30)] * 2
    docs = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], DOCS)
    assert rows_of(sv.variants(sv.vocabulary(docs, damage_every=31))) == plain_variants(plain_words(rows))
    assert sv.variants(sv.vocabulary(docs.limit(0))).collect() == []
