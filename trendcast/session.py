"""Session construction and the shared working folder.

Library code never builds its own session; callers pass one in. ``build_session``
is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package is written against.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app: str = "trendcast",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name a shared file system. Only a local-mode
    session without the setting (tests, laptops) gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf lookup raises when unset
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS, S3, ...) before running snapshot or ranking jobs"
            )
        configured = tempfile.mkdtemp(prefix="trendcast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, *parts: str, fresh: bool = False) -> str:
    """A path below the shared checkpoint folder.

    ``fresh=True`` appends a unique component so repeated runs never see each
    other's files.
    """
    root = _checkpoint_root(spark).rstrip("/")
    pieces = [root, "trendcast", *parts]
    if fresh:
        pieces.append(uuid.uuid4().hex)
    return "/".join(pieces)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, a write's shuffle files go when it ends.

    They would otherwise count against the disk of every later step until the
    driver happens to collect its garbage.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


# What is worked on in rounds takes one for each ROUND_BYTES of its files, and so many at most:
# a round's shuffles are gone when the next begins, and a large cluster has enough to do in each.
ROUND_BYTES, MOST_ROUNDS = 512 << 20, 16


def rounds_for(size: int) -> int:
    return max(1, min(MOST_ROUNDS, -(-size // ROUND_BYTES)))


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files a scan reads; 0 for rows that come from no files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) if df.inputFiles() else 0


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for what this application needs until its results are written (:func:`release_scratch`)."""
    return shared_dir(spark, "scratch", spark.sparkContext.applicationId, label, fresh=True)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete everything below :func:`scratch_dir`, once the results that were derived from it have been written."""
    delete_path(spark, shared_dir(spark, "scratch", spark.sparkContext.applicationId))


# A shuffle of a table's rows begins with a partition for so many bytes of its files.
BYTES_A_PART = 4 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# A task that sorts what it scans holds a multiple of the compressed bytes, so it scans few of them.
_SCAN, SCAN_BYTES = "spark.sql.files.maxPartitionBytes", "32m"

# Whole texts go to Python in batches of about so many bytes; a worker holds a batch several times over.
_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def fit_batches(spark: SparkSession) -> None:
    """Let batches of long rows end at ``BATCH_BYTES``, unless the session has a number of its own."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_BYTES)


def fit_shuffles(spark: SparkSession, path: str) -> None:
    """Let shuffles begin with enough partitions for the files at ``path``; AQE merges small ones again.

    A fixed number would let a task's rows grow with the input. The session's
    numbers are never lowered, and inputs they are enough for change nothing.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    now = int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if size // BYTES_A_PART > now:
        spark.conf.set(_INITIAL, str(size // BYTES_A_PART))
        if spark.conf.get(_SCAN, None) is None:
            spark.conf.set(_SCAN, SCAN_BYTES)
