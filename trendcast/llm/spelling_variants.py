"""Operator 12: spelling variants by finite-state composition.

The vocabulary as a minimised acceptor V and the one-edit transducer E: the pairs
that V o E o V accepts are the pairs of words that differ in one inserted, deleted
or replaced code point.

*Initial states.* Two near words are the same before the edit and the same after
it. The composition is enumerated from the states it can be in before an edit of
one half of a word: pairs whose edit is in the second half share the state after
the first half, so they are found among the words of that state's right language;
pairs whose edit is in the first half share it in the acceptor of the reversed
words. So a word is dealt to (longer length of the pair, half, shared part), four
partitions in all, and each pair is met in just one: that of its edit's place,
counted as far right as the letters allow.

*Hot states.* A task builds a partition's acceptor only up to ``MAX_WORDS`` words
of at most ``MAX_REST`` unshared letters. Beyond that it passes the partition on,
halved again, to the next round, until the unshared part is a single letter; so
memory is bounded and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast.llm.common import materialize, parallelism, table

MIN_LETTERS = 7
MIN_COUNT = 2
FORM_FACTOR = 10
MAX_WORDS = 20_000
MAX_REST = 32
# The letters of a word, and how often one is damaged.
LETTERS = "A-Za-zÀ-ÿ"
DAMAGE_EVERY = 31
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Acceptor:
    """Minimal acyclic acceptors: a state is the tuple of its arcs (letter, state), kept once."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.arcs: list[tuple] = []

    def _state(self, arcs: list) -> int:
        key = tuple(arcs)
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.arcs)
            self.arcs.append(key)
        return n

    def add(self, words: list[str]) -> int:
        """The initial state of an acceptor of ``words``: distinct, sorted, of one length."""
        open_states, before = [[]], ""
        for word in words:
            same = 0
            while same < len(before) and before[same] == word[same]:
                same += 1
            self._close(open_states, before, same)
            open_states.extend([] for _ in range(len(word) - same))
            before = word
        self._close(open_states, before, 0)
        return self._state(open_states[0])

    def _close(self, open_states: list, word: str, down_to: int) -> None:
        """Settle the states of ``word`` below depth ``down_to``: nothing more is added to them."""
        while len(open_states) - 1 > down_to:
            done = self._state(open_states.pop())
            open_states[-1].append((word[len(open_states) - 1], done))

    def common(self, p: int, q: int) -> list[str]:
        """The words that both states accept (all of one length)."""
        if p == q:
            return self.language(p)
        left, right = self.arcs[p], self.arcs[q]
        if not left or not right:
            return []
        there = dict(right)
        return [a + t for a, s in left if a in there for t in self.common(s, there[a])]

    def language(self, p: int) -> list[str]:
        if not self.arcs[p]:
            return [""]
        return [a + t for a, s in self.arcs[p] for t in self.language(s)]


def near_pairs(shorter: list[str], longer: list[str], after: str) -> Iterator[tuple[str, str]]:
    """Pairs of V o E o V: both from ``longer`` (one letter replaced), or one of each (one inserted).

    Both lists are sorted and distinct, the words of ``longer`` one letter longer.
    ``after`` is the letter that follows all of them, or empty: a letter inserted
    into a run of the same one counts at the run's end only.
    """
    v = Acceptor()
    top = v.add(longer) if longer else None
    # Replaced: one arc each, then what both states accept.
    walk = [(top, "")] if len(longer) > 1 else []
    while walk:
        state, path = walk.pop()
        arcs = v.arcs[state]
        for i, (a, p) in enumerate(arcs):
            walk.append((p, path + a))
            for b, q in arcs[i + 1:]:
                for rest in v.common(p, q):
                    yield path + a + rest, path + b + rest
    # Inserted: an arc of the longer words alone.
    both = [(v.add(shorter), top, "")] if shorter and longer else []
    while both:
        s, p, path = both.pop()
        here = dict(v.arcs[s])
        for a, q in v.arcs[p]:
            for rest in v.common(s, q):
                if (rest or after)[:1] != a:
                    yield path + rest, path + a + rest
            if a in here:
                both.append((here[a], q, path + a))


_PARTS = pa.schema([("size", pa.int64()), ("head", pa.string()), ("rest", pa.string()), ("tail", pa.string()), ("n", pa.int64()),
                    ("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
PARTS = "size bigint, head string, rest string, tail string, n bigint, word string, n_near bigint, best_n bigint, best string"
_NOTHING = dict.fromkeys(_PARTS.names)


def _halves(size: int, head: str, rest: str, tail: str, n: int) -> Iterator[dict]:
    """A word's two finer partitions: the first or the second half of the unshared letters is shared.

    An edit at one of the first ``half`` of the longer word's unshared places
    leaves the places after them alone, and the other way round.
    """
    wide = size - len(head) - len(tail)
    half = wide // 2
    same = wide - half
    yield _NOTHING | {"size": size, "head": head + rest[:half], "rest": rest[half:], "tail": tail, "n": n}
    yield _NOTHING | {"size": size, "head": head, "rest": rest[:len(rest) - same], "tail": rest[len(rest) - same:] + tail, "n": n}


def _partition(size: int, head: str, tail: str, rows: list[tuple[str, int]]) -> Iterator[dict]:
    """Per word of a partition how many near words it has there, and the most frequent of them (ties: the least)."""
    if len(rows) < 2:
        return
    count = dict(rows)
    wide = size - len(head) - len(tail)
    longer = sorted(r for r in count if len(r) == wide)
    shorter = sorted(r for r in count if len(r) == wide - 1)
    # After the unshared letters of the shorter word comes what both share.
    found: dict[str, list] = {}
    for pair in near_pairs(shorter, longer, tail[:1]):
        for me, other in (pair, pair[::-1]):
            best = (-count[other], other + tail)
            have = found.get(me)
            if have is None:
                found[me] = [1, best]
            else:
                have[0] += 1
                if best < have[1]:
                    have[1] = best
    for me, (near, (n, other)) in found.items():
        yield _NOTHING | {"word": head + me + tail, "n_near": near, "best_n": -n, "best": head + other}


def _explore(max_words: int, max_rest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            key, rows, passed_on = None, [], False
            for b in batches:
                cols = [b.column(c).to_pylist() for c in ("size", "head", "tail", "rest", "n")]
                for size, head, tail, rest, n in zip(*cols, strict=True):
                    if (size, head, tail) != key:
                        if key is not None and not passed_on:
                            yield from _partition(*key, rows)
                        key, rows, passed_on = (size, head, tail), [], False
                    if passed_on:
                        yield from _halves(size, head, rest, tail, n)
                        continue
                    rows.append((rest, n))
                    wide = size - len(head) - len(tail)
                    if wide > 1 and (len(rows) > max_words or wide > max_rest and len(rows) > 1):
                        for r, m in rows:
                            yield from _halves(size, head, r, tail, m)
                        rows, passed_on = [], True
            if key is not None and not passed_on:
                yield from _partition(*key, rows)

        held = []
        for row in each():
            held.append(row)
            if len(held) >= 5000:
                yield pa.RecordBatch.from_pylist(held, _PARTS)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, _PARTS)

    return run


def near_words(vocabulary: DataFrame, max_words: int = MAX_WORDS, max_rest: int = MAX_REST) -> DataFrame:
    """(word, n_near, best_n, best) of the words of ``vocabulary`` (word, n; words distinct) with a near word.

    ``best`` is the near word of largest n, ties to the smaller one in code-point
    order. Any two words of two or more code points that differ by one edit are
    near; words of one code point are not compared.
    """
    spark = vocabulary.sparkSession
    parts = parallelism(spark)
    # The pair's longer length is the word's own, or one more; first halves are taken here, without Python.
    wide = F.explode(F.array(F.char_length("word").cast("bigint"), (F.char_length("word") + 1).cast("bigint")))
    sized = vocabulary.filter(F.char_length("word") > 1).select("word", "n", wide.alias("size"))
    half = F.floor(F.col("size") / 2).cast("int")
    same = (F.col("size") - half).cast("int")
    long = F.char_length("word").cast("int")
    first = F.struct(F.substring("word", F.lit(1), half).alias("head"), F.substring("word", half + 1, long).alias("rest"), F.lit("").alias("tail"))
    second = F.struct(F.lit("").alias("head"), F.substring("word", F.lit(1), long - same).alias("rest"),
                      F.substring("word", long - same + 1, same).alias("tail"))
    todo = sized.select("size", "n", F.explode(F.array(first, second)).alias("p")).select("size", "p.head", "p.rest", "p.tail", "n")
    found = None
    while True:
        dealt = todo.repartition(parts, "size", "head", "tail").sortWithinPartitions("size", "head", "tail")
        got = materialize(dealt.mapInArrow(_explore(max_words, max_rest), PARTS), "near_words")
        pairs = got.filter("size is null").select("word", "n_near", "best_n", "best")
        found = pairs if found is None else found.unionByName(pairs)
        todo = got.filter("size is not null").select("size", "head", "rest", "tail", "n")
        if todo.isEmpty():
            break
    top = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    per_word = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("b"))
    return per_word.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): ``links`` (word, form) followed to their ends; forms never lead back.

    Each round doubles the steps that are known. A form is at least
    ``FORM_FACTOR`` times as frequent, so few rounds are needed.
    """
    now = links.select("word", F.col("form").alias("root"))
    while True:
        on = now.select(F.col("word").alias("_w"), F.col("root").alias("_next"))
        step = materialize(now.join(on, F.col("root") == F.col("_w"), "left")
                           .select("word", F.coalesce("_next", "root").alias("root"), F.col("_w").isNotNull().alias("moved")), "word_roots")
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def variants(vocabulary: DataFrame, factor: int = FORM_FACTOR, max_words: int = MAX_WORDS, max_rest: int = MAX_REST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``vocabulary`` (word, n; words distinct, not null).

    ``form`` is the near word of largest n (ties: the smallest in code-point
    order) if that n is at least ``factor`` (2 or more) times the word's own, else
    null; ``root`` is where forms lead in the end, the word itself without one.
    An empty vocabulary gives no rows. Other columns are not read.
    """
    if factor < 2:
        raise ValueError("with a factor under 2 forms could lead in a circle")
    words = vocabulary.select("word", F.col("n").cast("bigint").alias("n"))
    near = near_words(words, max_words, max_rest)
    is_form = F.col("best_n") >= factor * F.col("n")
    judged = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "word_forms")
    ends = roots(judged.filter("form is not null").select("word", "form"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
               min_count: int = MIN_COUNT, damage_every: int | None = None) -> DataFrame:
    """(word, n): the words of ``min_letters`` or more letters, A-Z in lower case, with ``min_count`` or more occurrences.

    A word is a maximal run of ``LETTERS``. Null and empty texts have none. With
    ``damage_every``, an occurrence whose checksum (of ``doc_id:word``; a null id
    is empty) it divides loses the letter that the checksum names, before lengths
    and occurrences are counted. Everything runs in the JVM.
    """
    run = F.translate("run", _UPPER, _LOWER)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{min_letters},}}"), F.lit(0))).alias("run"))
    words = runs.select("id", run.alias("word"))
    if damage_every:
        at = (F.col("h") % F.char_length("word")).cast("int")
        less = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
        words = words.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word"))).select(
            F.when(F.col("h") % damage_every == 0, less).otherwise(F.col("word")).alias("word"))
    counted = words.filter(F.char_length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


def op12_spelling_variants(spark, sf_dir):
    """Every word of the whole ``documents`` with its form, its root and its counts, after the contract's damage."""
    words = vocabulary(table(spark, sf_dir, "documents"), damage_every=DAMAGE_EVERY)
    return variants(materialize(words, "vocabulary"))
