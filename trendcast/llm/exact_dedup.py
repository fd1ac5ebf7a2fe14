"""Operator 8: exact deduplication with two passes of a Bloom filter.

Pass one sets, for every row, ``hashes`` cells of a filter of ``bits`` cells and
keeps the cells that more than one row set. Pass two probes every row against
those cells: a row of which any cell was set by itself alone has no equal and
passes straight through; only the others ("possibly repeated") are shuffled by
their exact digest. A false positive costs a shuffled row, never a result.

Everything is DataFrame expressions. The filter that is broadcast holds one bit
per cell, packed 32 to an integer, so it is at most ``bloom.MAX_BITS / 32`` rows of 12
bytes whatever the input. Where the rows need a larger one, the digests are cut
into ranges: their keys (digest and id, not the texts) are written by range without
a shuffle, and each range is filtered by itself with a filter of that size. So the
share of unique rows that shuffle does not grow with the input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendcast.llm import bloom
from trendcast.llm.common import SPACE_CLASS, materialize, table, text_or_empty

BITS_PER_ROW = 16
HASHES = 2


def text_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256) of the text with each run of white space as one blank; null is empty."""
    normal = F.regexp_replace(text_or_empty(text_col), f"{SPACE_CLASS}+", " ")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.sha2(normal, 256).alias("text_sha256"))


def repeated_cells(keys: DataFrame, bits: int, hashes: int) -> DataFrame:
    """The filter of pass one: (word, mask) of the cells that two or more rows set."""
    cells = keys.select(F.explode(F.array(*_cells(bits, hashes))).alias("cell"))
    # The partial aggregate runs before the shuffle, so a hot text sends one row per task.
    twice = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return bloom.bit_words(twice)


def _cells(bits: int, hashes: int):
    # The i-th cell comes from its own 15 hexadecimal digits of the digest.
    digits = [F.conv(F.substring("text_sha256", 1 + 15 * i, 15), 16, 10).cast("bigint") for i in range(hashes)]
    return [d.bitwiseAND(F.lit(bits - 1)) for d in digits]


def probe(keys: DataFrame, cells: DataFrame, bits: int, hashes: int) -> DataFrame:
    """Pass two: ``keys`` with ``maybe``, true when all cells of a row were set more than once."""
    out = keys.withColumns({f"_c{i}": c for i, c in enumerate(_cells(bits, hashes))})
    for i in range(hashes):
        side = cells.select(F.col("word").alias(f"_w{i}"), F.col("mask").alias(f"_m{i}"))
        out = out.join(F.broadcast(side), F.shiftright(f"_c{i}", 5) == F.col(f"_w{i}"), "left")
    hit = None
    for i in range(hashes):
        one = F.expr(f"coalesce(_m{i}, 0L) & shiftleft(1L, cast(_c{i} & 31 as int))") != 0
        hit = one if hit is None else hit & one
    return out.select("doc_id", "text_sha256", hit.alias("maybe"))


def _flagged(keys: DataFrame, rows: int, bits_per_row: int, max_bits: int, hashes: int) -> DataFrame:
    """Both passes, over one range of digests or over several."""
    ranges = max(1, -(-rows * bits_per_row // max_bits))
    bits = bloom.filter_bits(-(-rows // ranges), bits_per_row, max_bits)
    if ranges == 1:
        return probe(keys, repeated_cells(keys, bits, hashes), bits, hashes)
    # The last four digits of a digest are in none of its cells.
    by_range = F.conv(F.substring("text_sha256", 61, 4), 16, 10).cast("int") % ranges
    cut = materialize(keys.withColumn("_range", by_range), "exact_dedup_ranges", ["_range"])
    done = []
    for i in range(ranges):
        part = cut.filter(F.col("_range") == i).drop("_range")
        done.append(materialize(probe(part, repeated_cells(part, bits, hashes), bits, hashes), "exact_dedup_flagged"))
    return reduce(DataFrame.unionByName, done)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bits_per_row: int = BITS_PER_ROW, max_bits: int = bloom.MAX_BITS, hashes: int = HASHES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space became one
    blank; null counts as empty, so null and empty texts form one group. The
    row with the smallest ``doc_id`` stays. Rows that repeat both id and text
    are counted in ``group_size`` and returned as often as they occur; exactly
    one of them is ``kept``. Null ids sort last: such a row stays only if no
    row of its text has an id, and then ``keep_id`` is null. An empty table
    gives an empty result. Other columns of ``docs`` are not read.
    """
    if not 1 <= hashes <= 4:
        raise ValueError("hashes must be 1 to 4: each takes 15 digits of the digest")
    keys = materialize(text_keys(docs, id_col, text_col), "exact_dedup_keys")
    flagged = _flagged(keys, keys.count(), bits_per_row, max_bits, hashes)

    alone = flagged.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")

    # Only possibly repeated rows shuffle. Equal (digest, id) rows are counted first;
    # the group facts are written so that the join back has plain scans on both
    # sides and AQE can split the digest of a hot text.
    counted = flagged.filter("maybe").groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("_copies"))
    rows = materialize(counted, "exact_dedup_maybe")
    groups = materialize(rows.groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.sum("_copies").alias("group_size")), "exact_dedup_groups")
    joined = rows.join(groups, "text_sha256")
    again = joined.select(
        "doc_id", "keep_id", "group_size", "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_i"))
    maybe = again.select("doc_id", "keep_id", "group_size",
                         (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_i") == 1)).alias("kept"),
                         "text_sha256")
    return alone.unionByName(maybe)


def op8_exact_dedup(spark, sf_dir):
    """Every document with the one that stays of its equals."""
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH keyed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept,
       text_sha256
FROM keyed
"""
