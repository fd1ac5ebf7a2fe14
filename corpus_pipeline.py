"""Training-data pipeline over ``documents``, from raw texts to packed token sequences.

Each stage calls one operator of ``trendcast.llm`` on all rows its predecessor
kept; its result is written as Parquet and reread as the next stage's input.
All but the last return the columns of ``documents``.

* ``language_id``: documents whose language the model does not know go.
* ``line_dedup``: lines that repeat earlier ones are cut out; documents without
  any text left go.
* ``near_duplicates``: of each group of near copies (5-word shingles, Jaccard
  0.75) the document with the smallest id stays.
* ``mixing``: a sample whose tokens meet the source, language and topic targets.
* ``packing``: pieces of token ids in sequences of at most 1024.

Null or empty texts go in the first stage. Null languages and sources are kept
(null languages are not learned from; null sources are mixed as "other"). An
empty table gives empty results in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trendcast.llm import language_id, line_dedup, ngram_join, packing, source_mixing
from trendcast.llm.common import materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id.keep_identified),
    ("line_dedup", line_dedup.without_repeats),
    ("near_duplicates", ngram_join.one_of_each_group),
    ("mixing", source_mixing.sampled),
    ("packing", packing.packed),
]

# Language models, edit distance, set similarity and tokenizers have no plain SQL
# statement; tests/llm holds the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
