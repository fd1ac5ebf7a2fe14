"""Scheduled loads: landed pages of one dataset -> this month's snapshot, each file once.

A load is one incremental run over a landing folder (a streaming checkpoint
remembers the files it has taken): pages are flattened, rolled into the month
and the month is compacted, the newest capture winning. Pages that do not fit
their schema are kept in a reject folder beside the store, and a report of what
each batch did in another. A run without new files changes nothing; a batch that
is run again after a failure neither.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendcast import constants as K
from trendcast import schemas
from trendcast.functions.timeparts import month_tag
from trendcast.operators.joins import semi_on_folded
from trendcast.plans.rollover import compacted, rollover, rollover_merge
from trendcast.sources import landing
from trendcast.sources.snapshots import Batch, RulesBroken, SnapshotStore, not_null
from trendcast.streaming.ingest import MAX_BYTES_PER_TRIGGER, TABLE, Pages, batch_dir, merge_batch, parsed_once, run_available, source

# Dimensions by name: subreddits, countries, regions, categories (as the flatteners take them).
Dimensions = dict[str, DataFrame]


@dataclass(frozen=True)
class Load:
    payload: T.StructType
    items: str
    flatten: Callable[[DataFrame, dt.datetime, Dimensions], DataFrame]
    ts_col: str
    order: str
    day_col: str | None


LOADS: dict[str, Load] = {
    "trends": Load(schemas.TRENDS_PAYLOAD, "trending_searches", lambda p, at, d: landing.flatten_trends(p),
                   "start_date", "captured_at", "start_date"),
    # A job's key holds no time, so its rows lie in buckets of the key instead of days.
    "jobs": Load(schemas.JOBS_PAYLOAD, "jobs_results", lambda p, at, d: landing.flatten_jobs(p, at),
                 "scraped_at", "scraped_at", None),
    "posts": Load(schemas.POSTS_PAYLOAD, "posts", lambda p, at, d: landing.flatten_posts(p, d["subreddits"], at),
                  "created", "today_date", "created"),
    "popular": Load(schemas.VIDEOS_PAYLOAD, "items",
                    lambda p, at, d: landing.flatten_popular(p, d["categories"], d["countries"], d["regions"]),
                    "published_ts", "captured_at", "published_ts"),
}


JOB_BUCKETS = 256
DETAIL_BUCKETS = 256


def store_of(spark: SparkSession, dataset: str, base: str) -> SnapshotStore:
    day_col = "published_ts" if dataset == "keyword_videos" else LOADS[dataset].day_col
    buckets = (K.KEYS[dataset], JOB_BUCKETS) if day_col is None else None
    return SnapshotStore(spark, base, schemas.DATASETS[dataset], day_col, buckets=buckets)


REPORT = ("dataset string, month string, action string, pages bigint, rejected_pages bigint, lost_pages bigint, "
          "rows bigint, duplicates bigint, broken_rules string")


def _report(spark: SparkSession, base: str, by: Batch, dataset: str, month: str, action: str, pages: Pages,
            rows: int = 0, duplicates: int = 0, broken: str | None = None) -> None:
    """One row on what a batch did, from counts taken while it was written; a batch run again writes its row again."""
    row = (dataset, month, action, pages.count, pages.rejected, pages.lost, rows, duplicates, broken)
    spark.createDataFrame([row], REPORT).coalesce(1).write.mode("overwrite").parquet(batch_dir(f"{base.rstrip('/')}_loads", by))


def load_reports(spark: SparkSession, base: str) -> DataFrame:
    """What every batch of the loads into a store did: pages read, rejected and lost, rows written, duplicates removed."""
    return spark.read.parquet(f"{base.rstrip('/')}_loads")


def load(spark: SparkSession, dataset: str, landing_dir: str, base: str, checkpoint: str, as_of: dt.datetime,
         dimensions: Dimensions | None = None, when_present: str = "append", required: list[str] | None = None,
         max_bytes: int = MAX_BYTES_PER_TRIGGER) -> dict:
    """One run of the flag-form load of ``dataset``; what it did, per micro-batch (see :func:`load_reports`).

    The run decides once whether the month starts anew, is added to or is left
    alone, and all its micro-batches follow. Rows without a value in one of the
    ``required`` columns are not published: the run ends with
    :class:`RulesBroken`, the month stays as it was, and the files of that batch
    are taken again by the next run.
    """
    spec, store, month, actions = LOADS[dataset], store_of(spark, dataset, base), month_tag(as_of), []

    def each(batch: DataFrame, by: Batch) -> None:
        with parsed_once(batch, spec.items, f"{base.rstrip('/')}_rejects", by) as pages:
            if not pages.count:
                return
            again = store.applied(by)
            rows = Observation()
            flat = spec.flatten(pages.rows, as_of, dimensions or {}).observe(rows, F.count(F.lit(1)).alias("n"))
            try:
                action = rollover(store, flat, as_of, spec.ts_col, K.GRACE_DAYS[dataset], when_present, guard_empty=False,
                                  by=by, rules=not_null(required or []))
            except RulesBroken as e:
                _report(spark, base, by, dataset, month, "refused", pages, broken=str(e))
                raise
            removed = compacted(store, month, K.KEYS[dataset], [spec.order])
            actions.append(action)
            if not again:
                written = 0 if action == "skipped" else rows.get["n"]
                _report(spark, base, by, dataset, month, action, pages, written, removed)

    store.end_run(run_available(source(spark, landing_dir, spec.payload, max_bytes), each, checkpoint))
    return {"dataset": dataset, "month": month, "actions": actions or ["no_data"]}


DETAILS = T.StructType([
    T.StructField(n, t) for n, t in (
        ("captured_at", T.TimestampNTZType()), ("video_id", T.StringType()), ("title", T.StringType()),
        ("channel_title", T.StringType()), ("category_id", T.StringType()), ("published_at", T.StringType()),
        ("published_ts", T.TimestampNTZType()), ("tags", T.ArrayType(T.StringType())), ("duration", T.StringType()),
        ("view_count", T.LongType()), ("like_count", T.LongType()), ("comment_count", T.LongType()),
        ("ingest_batch", T.LongType()))])


def load_keyword_videos(spark: SparkSession, search_dir: str, details_dir: str, base: str, checkpoint: str,
                        as_of: dt.datetime, categories: DataFrame, keywords: DataFrame | None = None) -> dict:
    """One run of the count-form load: new details go into a keyed store, new search hits join it.

    ``keywords`` (column ``query``) limits the hits to recently trending ones.
    """
    store = store_of(spark, "keyword_videos", base)
    details = SnapshotStore(spark, f"{base.rstrip('/')}_details", DETAILS, buckets=(["video_id"], DETAIL_BUCKETS))
    rejects, actions = f"{base.rstrip('/')}_rejects", []

    def keep_details(batch: DataFrame, by: Batch) -> None:
        with parsed_once(batch, "items", rejects, by) as pages:
            if pages.count:
                merge_batch(landing.video_rows(pages.rows).drop("region_code"), by, details, ["video_id"])

    def take_hits(batch: DataFrame, by: Batch) -> None:
        with parsed_once(batch, "items", rejects, by) as pages:
            if not pages.count:
                return
            hits = pages.rows if keywords is None else semi_on_folded(pages.rows, "keyword", keywords, "query")
            # At most one row per bucket: which parts of the details the hits need.
            parts = landing.search_hits(hits).select(details.day_of().alias("part")).distinct().collect()
            known = details.load_days(TABLE, [r["part"] for r in parts]).drop("ingest_batch")
            videos = landing.join_keyword_videos(hits, known, categories)
            action = rollover_merge(store, videos, as_of, "published_ts", guard_empty=False, by=by)
            removed = compacted(store, month_tag(as_of), K.KEYS["keyword_videos"], ["captured_at"])
            actions.append(action)
            if action != "replayed":
                _report(spark, base, by, "keyword_videos", month_tag(as_of), action, pages, duplicates=removed)

    run_available(source(spark, details_dir, schemas.DETAILS_PAYLOAD), keep_details, f"{checkpoint}/details")
    run_available(source(spark, search_dir, schemas.SEARCH_PAYLOAD), take_hits, f"{checkpoint}/search")
    return {"dataset": "keyword_videos", "month": month_tag(as_of), "actions": actions or ["no_data"]}


def dimensions_from(spark: SparkSession, folder: str | None) -> Dimensions:
    """The parquet tables below ``folder`` that the loads look names up in; absent ones are left out."""
    if not folder:
        return {}
    out = {}
    for name in ("subreddits", "countries", "regions", "categories"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            out[name] = spark.read.parquet(str(path))
    return out


def distinct_pairs(categories: DataFrame) -> DataFrame:
    """(category_id, category_title) of a list that may be given per country: the lowest title."""
    return categories.groupBy("category_id").agg(F.min("category_title").alias("category_title"))
