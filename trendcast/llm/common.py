"""Shared helpers of the corpus operators: scratch tables in the shared folder,
partition counts that follow the input, and the text rules several operators
have in common."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendcast.session import fit_batches, shared_dir

# Fixed value: the white space of the operators' contracts (blank, \t \n \v \f \r).
SPACE_CLASS = r"[\x20\x09-\x0D]"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    fit_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: an executor lost later re-reads files instead of
    recomputing, and both sides of a later join are plain scans that AQE can
    split. Each call uses a fresh folder; :func:`release` deletes them all.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", spark.sparkContext.applicationId, label, fresh=True)
    df.write.partitionBy(*partition_by or []).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every scratch table this application wrote through :func:`materialize`.

    Call it when the results that were derived from them have been written.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(
        shared_dir(spark, "llm", spark.sparkContext.applicationId))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(scratch: DataFrame) -> None:
    """Delete one table of :func:`materialize`, when all that was derived from it has been written or collected.

    Scratch tables would otherwise count against the disk of every later step. Other tables are left alone.
    """
    spark, files = scratch.sparkSession, scratch.inputFiles()
    if files and f"/llm/{spark.sparkContext.applicationId}/" in files[0]:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(files[0])).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def parallelism(spark: SparkSession) -> int:
    """The session's shuffle partition count: how finely work is dealt out."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


_OTHERS = "_columns_of_the_caller"


ROWS_A_PART = 1_500_000
KNOWN = 1 << 18


def parts_for(spark: SparkSession, rows: int, rows_a_part: int = ROWS_A_PART) -> int:
    """How many parts to deal ``rows`` small rows into, so that a task can hold a part: more rows, more parts."""
    return max(parallelism(spark), -(-rows // rows_a_part))


class Seen:
    """Which numbers a task has met before, as far as ``KNOWN`` of them go back; forgetting one costs a repeated row."""

    def __init__(self, most: int = KNOWN):
        self.most, self.known = most, set()

    def fresh(self, numbers: list[int]) -> list[bool]:
        out = []
        for x in numbers:
            out.append(x not in self.known)
            self.known.add(x)
        if len(self.known) > self.most:
            self.known.clear()
        return out


def apart(df: DataFrame, needed: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``df`` while all columns but ``needed`` are out of its way in one struct, whatever their names.

    ``work`` returns the columns it was given.
    """
    others = [c for c in df.columns if c not in needed]
    if not others:
        return work(df)
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in others]
    done = work(df.select(*needed, F.struct(*quoted).alias(_OTHERS)))
    back = [F.col(c) if c in needed else F.col(_OTHERS).getField(c).alias(c) for c in df.columns]
    return done.select(*back)


def document_stage(stage):
    """A pipeline stage that returns the columns it was given: its own names can't clash with a caller's columns."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        fit_batches(spark)
        return apart(docs, ["doc_id", "text", "lang", "source", "n_chars"], lambda df: stage(spark, df, sf_dir))
    return run


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
