"""A Bloom filter as a small table of bit words, built and probed with DataFrame expressions.

Its size is fixed by the caller (``bits`` cells, 32 to a row), so broadcasting it
is bounded whatever it was built from. A false positive lets a row through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 26


def filter_bits(rows: int, bits_per_row: int = 16, max_bits: int = MAX_BITS) -> int:
    bits = 1 << 12
    while bits < rows * bits_per_row and bits < max_bits:
        bits *= 2
    return bits


def bit_words(cells: DataFrame) -> DataFrame:
    """(word, mask) from rows of ``cell`` numbers."""
    bit = F.expr("shiftleft(1L, cast(cell & 31 as int))")
    return cells.select(F.shiftright("cell", 5).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("mask"))


def key_cell(key: Column, bits: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(bits - 1))


def flag(rows: DataFrame, key: str, members: DataFrame, count: int) -> DataFrame:
    """``rows`` with ``_maybe``: whether ``key`` may be among ``members`` (``count`` rows); null keys are not."""
    bits = filter_bits(count)
    words = bit_words(members.select(key_cell(F.col(key), bits).alias("cell")))
    side = F.broadcast(words.select(F.col("word").alias("_word"), F.col("mask").alias("_mask")))
    celled = rows.withColumn("_cell", key_cell(F.col(key), bits))
    one = F.expr("shiftleft(1L, cast(_cell & 31 as int))")
    hit = F.col(key).isNotNull() & (F.coalesce("_mask", F.lit(0)).bitwiseAND(one) != 0)
    return celled.join(side, F.shiftright("_cell", 5) == F.col("_word"), "left").withColumn(
        "_maybe", hit).drop("_word", "_mask", "_cell")


def maybe_in(rows: DataFrame, key: str, members: DataFrame, count: int) -> DataFrame:
    """The ``rows`` whose ``key`` may be among ``members`` (``count`` of them): all that are, few others."""
    return flag(rows, key, members, count).filter("_maybe").drop("_maybe")
