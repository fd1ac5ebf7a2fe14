"""Operator 2: near-duplicate line removal by a segment-partition edit join.

A line (trimmed, not empty) is removed if a line that comes before it, by
(doc_id, line number), is equal or, from ``MIN_CHARS`` characters on, within
``max_edits`` edits of it. Lines are handled as distinct *forms*; a form's place
is that of its first occurrence.

1. One pass over the texts: each line's form (64-bit hash), place and signature.
   Equal lines of any length are told by the form alone.
2. *Segment join.* Each form of ``MIN_CHARS`` or more is cut into ``max_edits + 1`` segments: within that
   many edits at least one stays whole in the other form. A second pass gives the
   segments as index keys (length, segment number, content) and, for each length
   that a partner may have, the substrings at the places where an intact segment
   can lie. Keys that do not bring two forms together are dropped at once.
3. Forms that share a key are compared by signature: one edit flips at most four
   bits of the parities of a line's character pairs. Crowded keys are dealt out
   in pairs of blocks.
4. Surviving pairs fetch their lines and are verified by a banded bit-parallel
   edit distance; common beginnings and ends are cut off first.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast.llm import bloom
from trendcast.llm.common import Seen, apart, document_stage, materialize, parallelism, parts_for, table
from trendcast.llm.hashing import Substrings, mix, symbol_values

MAX_EDITS = 2
# Shortest lines that are compared by edits (equal ones go at any length). Among the lines of
# sf0.1 chance brings 2,005 pairs of 3 characters within two edits, 98 of 8, 13 of 12, 1 of 15
# and none of 16; the few pairs above are copies that differ in a sign or a word's ending.
MIN_CHARS = 16
BLOCK = 4096
FLIPS_PER_EDIT = 4
KEYS_A_FORM = 20  # about as many index and probe keys has a form
PORTION = 1 << 18
# Fixed value: the white space that lines are trimmed of.
TRIM = " \t\n\v\f\r"


PAIR = np.uint64(0xD6E8FEB86659FD93)
BIT = np.zeros((2, 128), dtype=np.uint64)  # the bit of each class of pairs in each half of a signature
BIT[0, :64] = BIT[1, 64:] = np.uint64(1) << np.arange(64, dtype=np.uint64)


# --- lines of a batch as one array ---------------------------------------------------


class Lines:
    """The lines of some texts from a length on: their numbers, and hashes over one array of code points."""

    def __init__(self, texts: list[str | None], min_chars: int):
        self.row, self.number, kept = [], [], []
        for r, text in enumerate(texts):
            for i, line in enumerate(text.split("\n") if text else ()):
                line = line.strip(TRIM)
                if len(line) >= min_chars:
                    self.row.append(r)
                    self.number.append(i)
                    kept.append(line)
        self.length = np.array([len(x) for x in kept], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        points = np.frombuffer("".join(kept).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.points = symbol_values(points)
        self.part = Substrings(self.points, values=True)

    def forms(self) -> np.ndarray:
        return self.part.hashes(self.start, self.start + self.length).astype(np.int64)

    def signatures(self) -> tuple[np.ndarray, np.ndarray]:
        """Parities of 128 classes of character pairs, as two numbers of 64 bits."""
        if not len(self.points):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        # Code points are random numbers already, so one step mixes a pair; its upper seven bits are its class.
        place = (self.points[:-1] * PAIR + self.points[1:]) >> np.uint64(57)
        out = []
        for half in (0, 1):
            run = np.zeros(len(place) + 1, dtype=np.uint64)
            np.bitwise_xor.accumulate(BIT[half][place], out=run[1:])
            out.append((run[self.start + self.length - 1] ^ run[self.start]).astype(np.int64))
        return out[0], out[1]

    def keys(self, edits: int, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(key, line, index?): the index keys and probe keys of the ``chosen`` lines, one kind at a time."""
        every = np.arange(len(self.length))
        for shorter in range(edits + 1):
            target = self.length - shorter
            for seg in range(edits + 1):
                begin, size = segment(target, seg, edits)
                tag = mix(target.astype(np.uint64) * np.uint64(edits + 1) + np.uint64(seg))
                low = np.maximum(begin - seg, begin + shorter - (edits - seg))
                high = np.minimum(begin + seg, begin + shorter + (edits - seg))
                low, high = np.maximum(low, 0), np.minimum(high, self.length - size)
                for shift in range(-edits, edits + 1):
                    at = begin + shift
                    ok = every[chosen & (at >= low) & (at <= high) & (target > edits)]
                    if len(ok):
                        s = self.start[ok] + at[ok]
                        # At its own length and place a probe is the index key itself.
                        yield mix(self.part.hashes(s, s + size[ok]) ^ tag[ok]).astype(np.int64), ok, not shorter and not shift


def _portions(b: pd.DataFrame, chars: int = PORTION) -> Iterator[pd.DataFrame]:
    """A batch in parts of about ``chars`` characters, so that a part's arrays stay small."""
    sizes = np.array([len(t) if t else 0 for t in b["text"]], dtype=np.int64)
    part = np.cumsum(sizes) // chars
    for at in np.split(np.arange(len(b)), np.flatnonzero(np.diff(part)) + 1):
        if len(at):
            yield b.iloc[at]


def segment(length: np.ndarray, number: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, size) of a segment: all as long as can be, the last ones one longer."""
    size, extra = length // (edits + 1), length % (edits + 1)
    long_before = np.maximum(0, number - (edits + 1 - extra))
    return number * size + long_before, size + (number >= edits + 1 - extra)


# --- edit distance -------------------------------------------------------------------


def within_edits(a: str, b: str, limit: int) -> bool:
    """Whether a and b are at most ``limit`` insertions, deletions and substitutions apart.

    After the common ends are cut off, the cells of the distance matrix within
    ``limit`` of the diagonal are kept as vertical differences in two bit
    vectors, one bit per diagonal, and advanced a column at a time.
    """
    head = len(os.path.commonprefix([a, b]))
    a, b = a[head:], b[head:]
    tail = len(os.path.commonprefix([a[::-1], b[::-1]]))
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if n - m > limit:
        return False
    if m == 0:
        return True
    # Before column j + 1, bit r of the vectors stands for row j + 1 + r - limit of a.
    width = 2 * limit + 1
    mask = (1 << width) - 1
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << (i + limit)
    plus, minus = mask & ~((1 << limit) - 1), 0  # down column 0 the distance rises by one a row
    score, end_bit = min(limit, m), width - 1  # at the band's lower edge, or at the last row of a
    for j in range(n):
        match = (where.get(b[j], 0) >> j) & mask
        zero = ((((match & plus) + plus) ^ plus) | match | minus) & mask
        rise = (minus | ~(zero | plus)) & mask
        fall = zero & plus
        if j + limit < m:
            score += not (zero >> end_bit) & 1
        else:
            # The band's edge is below the last row of a: follow that row along the columns.
            last = m - 1 - j + limit
            score += (rise >> last & 1) - (fall >> last & 1)
        down = zero >> 1
        plus, minus = (fall | ~(down | rise)) & mask, down & rise
    return score <= limit


# --- 2 and 3: candidates -------------------------------------------------------------


def _measure(rows: DataFrame) -> DataFrame:
    """Every line that is not empty: its form, place, size and signature."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (p for batch in batches for p in _portions(batch)):
            lines = Lines(b["text"].tolist(), 1)
            one, two = lines.signatures()
            yield pd.DataFrame({"form": lines.forms(), "doc_id": b["doc_id"].to_numpy()[lines.row],
                                "line": np.array(lines.number, dtype=np.int32), "size": lines.length.astype(np.int32),
                                "sig1": one, "sig2": two})

    return rows.mapInPandas(run, "form bigint, doc_id bigint, line int, size int, sig1 bigint, sig2 bigint")


def _shared_keys(rows: DataFrame, min_chars: int, edits: int, forms_count: int) -> DataFrame:
    """(key, form, index): members of the keys that bring an index form and another form together."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Seen()  # a line that occurs very often gives its keys once a task, not at each place
        for b in (p for batch in batches for p in _portions(batch)):
            lines = Lines(b["text"].tolist(), min_chars)
            forms = lines.forms()
            for key, at, index in lines.keys(edits, np.array(seen.fresh(forms.tolist()), dtype=bool)):
                yield pd.DataFrame({"key": key, "form": forms[at], "index": index})

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        key, form, index = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("key", "form", "index"))
        order = np.lexsort((~index, form, key))  # of equal rows of a form the index row comes first
        key, form, index = key[order], form[order], index[order]
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (form[1:] != form[:-1])])
        key, form, index = key[once], form[once], index[once]
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        use = (np.bincount(group) > 1) & (np.bincount(group, weights=index) > 0)
        keep = use[group]
        yield pd.DataFrame({"key": key[keep], "form": form[keep], "index": index[keep]})

    schema = "key bigint, form bigint, index boolean"
    dealt = rows.mapInPandas(emit, schema).repartition(parts_for(rows.sparkSession, forms_count * KEYS_A_FORM), "key")
    return dealt.mapInPandas(shared, schema)


def _candidates(shared: DataFrame, forms: DataFrame, edits: int) -> DataFrame:
    """(a, b): forms that share a key and whose sizes and signatures allow ``edits``; each once, a < b."""
    crowds = shared.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > BLOCK).select(
        "key", F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks"))
    full = shared.join(forms.select("form", "size", "sig1", "sig2"), "form").join(materialize(crowds, "line_crowds"), "key", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("form"), blocks).cast("int")
    dealt = full.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "form", "index", "size", "sig1", "sig2")

    def compare(g: tuple[np.ndarray, ...]) -> np.ndarray:
        own, form, index, size, one, two = g
        out = []
        first = np.flatnonzero(own == own.min())
        second = np.flatnonzero(own == own.max())
        for at in range(0, len(first), 512):
            x = first[at:at + 512]
            ok = (index[x][:, None] | index[second][None, :]) & (np.abs(size[x][:, None] - size[second][None, :]) <= edits)
            i, j = np.nonzero(ok)
            i, j = x[i], second[j]
            flips = np.bitwise_count(one[i] ^ one[j]).astype(np.int64) + np.bitwise_count(two[i] ^ two[j])
            keep = (flips <= FLIPS_PER_EDIT * edits) & (form[i] != form[j])
            out.append(np.stack([np.minimum(form[i[keep]], form[j[keep]]), np.maximum(form[i[keep]], form[j[keep]])], axis=1))
        return np.concatenate(out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by (key, i, j); a group may go on in the next batch.
        rest: pd.DataFrame | None = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            if not len(b):
                continue
            k, i, j = (b[c].to_numpy() for c in ("key", "i", "j"))
            new = np.flatnonzero((k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            last = new[-1] if len(new) else 0
            yield pairs_of(b.iloc[:last], np.concatenate([[0], new]) if last else np.zeros(1, np.int64))
            rest = b.iloc[last:]
        if rest is not None and len(rest):
            yield pairs_of(rest, np.array([0, len(rest)]))

    def pairs_of(b: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        cols = [b[c].to_numpy() for c in ("own", "form", "index", "size", "sig1", "sig2")]
        cols[4], cols[5] = cols[4].astype(np.uint64), cols[5].astype(np.uint64)
        found = [np.empty((0, 2), np.int64)]
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if e - s > 1:
                found.append(compare(tuple(c[s:e] for c in cols)))
        got = np.unique(np.concatenate(found), axis=0)
        return pd.DataFrame({"a": got[:, 0], "b": got[:, 1]})

    n = parallelism(shared.sparkSession)
    ordered = dealt.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInPandas(run, "a bigint, b bigint").distinct()


# --- 4: verification -----------------------------------------------------------------


def _verified(rows: DataFrame, pairs: DataFrame, forms: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b) of forms that are within ``edits`` edits, from the texts of their first lines."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("form")).distinct().join(forms, "form")
    by_doc = materialize(wanted.groupBy("doc_id").agg(F.collect_list(F.struct("line", "form")).alias("want")), "line_wanted")
    texts = bloom.maybe_in(rows, "doc_id", by_doc, by_doc.count()).join(by_doc, "doc_id").select("text", "want")

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, want in zip(b["text"], b["want"], strict=True):
                lines = (text or "").split("\n")
                out += [(w["form"], lines[w["line"]].strip(TRIM)) for w in want if w["line"] < len(lines)]
            for part in _portions(pd.DataFrame(out, columns=["form", "text"])):
                # Rows that share an id may give a form another row's line: the hash tells.
                own = Lines(part["text"].tolist(), 0).forms() == part["form"].to_numpy(np.int64)
                yield part[own].rename(columns={"text": "content"})

    contents = materialize(texts.mapInPandas(pick, "form bigint, content string").dropDuplicates(["form"]), "line_contents")

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within_edits(x, y, edits) for x, y in zip(a, b, strict=True)], dtype=bool)

    left = contents.select(F.col("form").alias("a"), F.col("content").alias("x"))
    right = contents.select(F.col("form").alias("b"), F.col("content").alias("y"))
    return pairs.join(left, "a").join(right, "b").filter(near("x", "y")).select("a", "b")


# --- the operator --------------------------------------------------------------------


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, line, near): the lines to remove; near is false for a repeat of an equal line.

    Lines are the parts of a text between line feeds, numbered from 0. Texts
    without lines, null or empty ones and rows without an id give none. Equal lines
    count at every length above 0, near ones from ``min_chars`` characters on.
    Rows with equal ids count as one document: their lines at the same place are
    no duplicates of each other. Other columns of ``docs`` are not read.
    """
    if min_chars <= 2 * max_edits:
        raise ValueError("lines must be longer than twice the edits")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null")
    lines = materialize(_measure(rows), "lines")
    firsts = lines.groupBy("form").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.max("size").alias("size"),
                                       F.max("sig1").alias("sig1"), F.max("sig2").alias("sig2"))
    forms = materialize(firsts.select("form", "first.doc_id", "first.line", "size", "sig1", "sig2"), "line_forms")

    shared = materialize(_shared_keys(rows, min_chars, max_edits, forms.count()), "line_keys")
    pairs = materialize(_candidates(shared, forms, max_edits), "line_pairs")
    links = materialize(_verified(rows, pairs, forms, max_edits), "line_links")

    place = forms.select("form", F.struct("doc_id", "line").alias("place"))
    at_a, at_b = place.select(F.col("form").alias("a"), F.col("place").alias("pa")), place.select(F.col("form").alias("b"), F.col("place").alias("pb"))
    later = links.join(at_a, "a").join(at_b, "b").select(F.when(F.col("pa") > F.col("pb"), F.col("a")).otherwise(F.col("b")).alias("form"))
    near = later.distinct().withColumn("near", F.lit(True))
    facts = materialize(forms.select("form", F.col("doc_id").alias("first_doc"), F.col("line").alias("first_line"))
                        .join(near, "form", "left"), "line_facts")
    told = lines.select("form", "doc_id", "line").join(facts, "form")
    first = (F.col("doc_id") == F.col("first_doc")) & (F.col("line") == F.col("first_line"))
    return told.filter(~first | F.col("near")).select("doc_id", "line", first.alias("near")).distinct()


def without_lines(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines in ``removed`` cut out of their texts, the other lines as they were.

    Documents that lose nothing are not shuffled: a small filter lets them pass.
    Other columns come out as they were, whatever their names.
    """
    return apart(docs, [id_col, text_col], lambda df: _without_lines(df, removed, id_col, text_col))


def _without_lines(docs: DataFrame, removed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    lists = materialize(removed.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("line").alias("_cut")), "line_cuts")
    count = lists.count()

    @F.pandas_udf("string")
    def cut(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for text, gone in zip(texts, cuts, strict=True):
            if text is not None and gone is not None:
                drop = set(gone.tolist())
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
            out.append(text)
        return pd.Series(out, dtype=object)

    cut = cut.asNondeterministic()  # else each later use of the text would run it again
    keyed = docs.withColumn("_id", F.col(id_col).cast("bigint"))
    flagged = bloom.flag(keyed, "_id", lists, count)
    same = flagged.filter("not _maybe").select(*docs.columns)
    touched = flagged.filter("_maybe").join(lists, "_id", "left")
    changed = touched.withColumn(text_col, F.when(F.col("_cut").isNull(), F.col(text_col)).otherwise(cut(F.col(text_col), F.col("_cut"))))
    return same.unionByName(changed.select(*docs.columns))


def op2_line_dedup(spark, sf_dir):
    """One row per document: how many lines it loses as equal and as near repeats, and their numbers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = duplicate_lines(docs)
    per_doc = removed.groupBy(F.col("doc_id").alias("_id")).agg(
        F.sum((~F.col("near")).cast("bigint")).alias("n_equal"), F.sum(F.col("near").cast("bigint")).alias("n_near"),
        F.array_join(F.array_sort(F.collect_list("line")), ",").alias("removed_lines"))
    return docs.select("doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("bigint").alias("n_lines")).join(
        per_doc, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "n_lines", F.coalesce("n_equal", F.lit(0)).alias("n_equal"), F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.coalesce("removed_lines", F.lit("")).alias("removed_lines"))


def _has_words():
    return F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


@document_stage
def without_repeats(spark, docs, sf_dir):
    """Pipeline stage: documents without the lines that repeat earlier ones; those that lose all their text go.

    ``n_chars`` is counted anew. Documents that had no text to begin with stay.
    """
    kept = without_lines(docs.withColumn("_had", _has_words()), duplicate_lines(docs))
    left = _has_words()
    counted = kept.filter(left | ~F.col("_had")).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return counted.select(*docs.columns)
