"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads whole tables of the test data (through the adapters in
``trendcast.sources.fixtures``) and runs one operator or pipeline of the
library. ``trendcast.oracle.QUERIES`` holds the DuckDB statement of the same
result for every one of them.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as _T

from trendcast import constants as K
from trendcast import functions as fn
from trendcast import operators as op
from trendcast import schemas
from trendcast.plans import dashboards, gap_chain, loads, marts, quality, refresh, staging, views
from trendcast.plans import partials as pt
from trendcast.plans import rollover as ro
from trendcast.session import shared_dir
from trendcast.sources import fixtures as fx
from trendcast.sources import landing
from trendcast.sources import landing_fixtures as lf
from trendcast.sources.snapshots import RulesBroken, SnapshotStore, conform, not_null
from trendcast.streaming import ingest as si

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(query: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = query
        return query
    return deco


# Seconds spent on making the state that a query starts from (stores of earlier
# runs, landed files), since the last reset: the bench reports them apart.
SETUP = {"secs": 0.0}


@contextmanager
def setting_up():
    began = time.perf_counter()
    try:
        yield
    finally:
        SETUP["secs"] += time.perf_counter() - began


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_trending_now(fx.trends(spark, sf_dir), fx.AS_OF)


@register("stg_trending_now")
def q_stg(spark, sf_dir):
    return stg(spark, sf_dir)


@register("mart_trending_topics")
def q_topics(spark, sf_dir):
    return marts.mart_trending_topics(stg(spark, sf_dir))


@register("mart_category_pulse")
def q_pulse(spark, sf_dir):
    return marts.mart_category_pulse(stg(spark, sf_dir))


@register("mart_keyword_recurrence")
def q_recur(spark, sf_dir):
    return marts.mart_keyword_recurrence(stg(spark, sf_dir), fx.AS_OF)


@register("mart_gap_analysis")
def q_gap(spark, sf_dir):
    return marts.mart_gap_analysis(fx.keyword_videos(spark, sf_dir), fx.trends(spark, sf_dir), fx.AS_OF)


# --- projections and scalar functions -------------------------------------------------


@register("recommendation_score")
def q_score(spark, sf_dir):
    return stg(spark, sf_dir).select("query", "start_date", "search_volume", "increase_percentage",
                                     "active", "trend_duration_hrs",
                                     fn.recommendation_score().alias("recommendation_score"))


@register("content_window")
def q_window(spark, sf_dir):
    return stg(spark, sf_dir).select("query", "start_date", "active", "trend_duration_hrs",
                                     fn.content_window().alias("content_window"))


@register("urgency_tier")
def q_tier(spark, sf_dir):
    return stg(spark, sf_dir).select("query", "start_date", "search_volume", "active",
                                     fn.urgency_tier().alias("urgency_tier"))


@register("time_of_day")
def q_tod(spark, sf_dir):
    return stg(spark, sf_dir).select("query", "start_date", "start_hour_eat",
                                     fn.time_of_day().alias("time_of_day"))


@register("local_time_parts")
def q_local(spark, sf_dir):
    return stg(spark, sf_dir).select("query", "start_date", "trend_date", "start_hour_eat",
                                     "day_of_week", "month_name", "week_number")


@register("recurrence_label")
def q_recur_label(spark, sf_dir):
    agg = stg(spark, sf_dir).groupBy("query", "categories").agg(
        F.count(F.lit(1)).alias("times_trended"),
        F.datediff(F.max("trend_date"), F.min("trend_date")).cast("bigint").alias("active_span_days"))
    return agg.withColumn("recurrence_label", fn.recurrence_label())


@register("scheduling_tip")
def q_tip(spark, sf_dir):
    agg = (stg(spark, sf_dir).withColumn("_tod", fn.time_of_day())
           .groupBy("query", "categories").agg(*marts.common_time_counts()))
    return marts.with_common_times(agg).withColumn("scheduling_tip", fn.scheduling_tip())


def _gap(spark, sf_dir):
    return marts.mart_gap_analysis(fx.keyword_videos(spark, sf_dir), fx.trends(spark, sf_dir), fx.AS_OF)


@register("gap_score")
def q_gap_score(spark, sf_dir):
    return _gap(spark, sf_dir).select("keyword", "search_volume", "median_views", "gap_score")


@register("opportunity")
def q_opportunity(spark, sf_dir):
    return _gap(spark, sf_dir).select("keyword", "gap_score", "opportunity")


@register("engagement_rate")
def q_eng_rate(spark, sf_dir):
    return fx.posts(spark, sf_dir).select(
        "id", "score", "num_comments", "subscribers", fn.engagement_rate().alias("engagement_rate"))


@register("engagement_intensity")
def q_eng_intensity(spark, sf_dir):
    return fx.posts(spark, sf_dir).select(
        "id", "score", "upvote_ratio", "num_comments", "awards",
        fn.engagement_intensity().alias("engagement_intensity"))


@register("round_values")
def q_round(spark, sf_dir):
    return stg(spark, sf_dir).groupBy("categories").agg(
        F.round(F.avg("search_volume"), 0).alias("avg_sv_0"),
        F.round(F.avg("search_volume") / F.lit(1000.0), 2).alias("avg_sv_k_2"),
        F.round(F.avg("trend_duration_hrs"), 1).alias("avg_dur_1"),
        F.round(F.avg("increase_percentage") / F.lit(7.0), 3).alias("avg_inc_7_3"))


@register("duration_secs")
def q_duration(spark, sf_dir):
    return fx.duration_texts(spark, sf_dir).withColumn(
        "duration_secs", fn.iso_duration_secs("duration"))


@register("tags_text")
def q_tags(spark, sf_dir):
    videos = fx.keyword_videos(spark, sf_dir).select(
        "video_id", F.split(F.lower(F.col("keyword")), " ").alias("tags"))
    return fn.tags_text(videos, "tags")


@register("defaults_fill")
def q_defaults(spark, sf_dir):
    posts = fx.posts(spark, sf_dir).select(
        "id", F.when(F.col("awards") == 0, F.lit(None)).otherwise(F.col("awards")).alias("awards"),
        F.when(F.col("num_comments") == 0, F.lit(None))
        .otherwise(F.col("num_comments").cast("string")).alias("num_comments_text"))
    filled = fn.fill_defaults(posts, {"awards": 0, "over_18": False, "spoiler": False})
    return filled.withColumn("num_comments", fn.int_or_zero("num_comments_text")).drop("num_comments_text")


# --- filters ---------------------------------------------------------------------------

@register("filter_watchable")
def q_watchable(spark, sf_dir):
    return op.watchable(fx.keyword_videos(spark, sf_dir)).select(
        "keyword", "video_id", "duration_secs", "view_count")


@register("keywords_last_24h")
def q_last24(spark, sf_dir):
    return staging.keywords_last_hours(stg(spark, sf_dir), fx.AS_OF, K.KEYWORD_WINDOW_HOURS)


@register("rows_in_month")
def q_rows_in_month(spark, sf_dir):
    return op.rows_in_month(fx.posts(spark, sf_dir), "created", fx.ROLLOVER_AS_OF).select("id", "created")


@register("month_presence")
def q_presence(spark, sf_dir):
    posts = fx.posts(spark, sf_dir)
    cnt = F.count_if(op.in_month(posts, "created", fx.ROLLOVER_AS_OF))
    return posts.agg(F.lit(fn.month_tag(fx.ROLLOVER_AS_OF)).alias("snapshot_month"),
                     cnt.alias("cnt"), (cnt > 0).alias("present"))


@register("snapshot_month")
def q_snapshot_month(spark, sf_dir):
    return fx.posts(spark, sf_dir).select("id", "created", fn.month_suffix("created").alias("snapshot_month"))


# --- aggregations ----------------------------------------------------------------------

@register("top_value_per_group")
def q_top_value(spark, sf_dir):
    return op.top_value_per_group(fx.keyword_videos(spark, sf_dir), ["keyword"], "like_count",
                                  out="top_like_count")


@register("median_views")
def q_median(spark, sf_dir):
    return op.watchable(fx.keyword_videos(spark, sf_dir)).groupBy("keyword").agg(
        fn.approx_median("view_count").alias("median_views"))


@register("top_keyword")
def q_top_keyword(spark, sf_dir):
    return op.arg_max_per_group(stg(spark, sf_dir), ["categories", "trend_date"], "query", "search_volume", "top_keyword")


@register("keyword_peak_volume")
def q_peak(spark, sf_dir):
    return marts.keyword_peak_volume(fx.trends(spark, sf_dir))


@register("jobs_dedupe")
def q_jobs_dedupe(spark, sf_dir):
    return op.keep_one(fx.jobs(spark, sf_dir), K.KEYS["jobs"], [F.col("scraped_at").desc_nulls_last()])


@register("duplicate_count")
def q_dup_count(spark, sf_dir):
    return op.duplicate_count(fx.jobs(spark, sf_dir), K.KEYS["jobs"])


# --- windows ---------------------------------------------------------------------------

@register("rank_in_category")
def q_rank(spark, sf_dir):
    return marts.mart_trending_topics(stg(spark, sf_dir)).select(
        "query", "start_date", "categories", "recommendation_score", "rank_in_category")


@register("sorted_topics")
def q_sorted_topics(spark, sf_dir):
    """The mart in its published order (a range-partitioned global sort)."""
    return marts.mart_trending_topics(stg(spark, sf_dir), sort=True)


@register("sorted_recurrence")
def q_sorted_recurrence(spark, sf_dir):
    return marts.mart_keyword_recurrence(stg(spark, sf_dir), fx.AS_OF, sort=True)


@register("daily_category_rank")
def q_daily_rank(spark, sf_dir):
    return marts.mart_category_pulse(stg(spark, sf_dir)).select(
        "categories", "trend_date", "total_search_volume", "daily_category_rank")


@register("keyword_count_vs_7d_avg")
def q_vs_avg(spark, sf_dir):
    return marts.mart_category_pulse(stg(spark, sf_dir)).select(
        "categories", "trend_date", "total_keywords", "keyword_count_vs_7d_avg")


# --- dashboards ------------------------------------------------------------------------

@register("top5_per_category")
def q_top5(spark, sf_dir):
    return dashboards.top_n_per_category(stg(spark, sf_dir), K.TOP_PER_CATEGORY)


@register("leaderboard")
def q_leaderboard(spark, sf_dir):
    return dashboards.leaderboard(stg(spark, sf_dir), 20)


@register("category_hour_heatmap")
def q_heatmap(spark, sf_dir):
    return dashboards.category_hour_heatmap(stg(spark, sf_dir))


@register("category_wow_growth")
def q_wow(spark, sf_dir):
    return dashboards.category_wow_growth(stg(spark, sf_dir))


# --- lookups ---------------------------------------------------------------------------

@register("lookup_category")
def q_lookup_category(spark, sf_dir):
    return op.lookup(fx.video_category_ids(spark, sf_dir), fx.video_categories(spark, sf_dir),
                     on="category_id", value="category_title", out="category_name")


@register("lookup_country")
def q_lookup_country(spark, sf_dir):
    cust = fx.customer_countries(spark, sf_dir)
    named = op.lookup(cust, fx.countries(spark, sf_dir), on="country_code", value="country_name")
    return op.lookup(named, fx.country_regions(spark, sf_dir), on="country_code", value="region")


# --- data quality ----------------------------------------------------------------------

@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    """The not-null rules over the tables that a refresh has written."""
    with setting_up():
        paths = refresh.refresh_marts(spark, fx.trends(spark, sf_dir), fx.keyword_videos(spark, sf_dir), fx.AS_OF,
                                      shared_dir(spark, "refresh", fresh=True))
    return refresh.not_null_report(spark, paths)


@register("dq_accepted_values")
def q_dq_accepted(spark, sf_dir):
    s = stg(spark, sf_dir)
    labels = lambda pairs: [label for _, label in pairs]
    return quality.combine(
        quality.check_accepted(s, "stg_trending_now", {"increase_percentage": K.INCREASE_LADDER}),
        quality.check_accepted(marts.scored_topics(s), "mart_trending_topics", {
            "urgency_tier": labels(K.URGENCY_TIERS) + [K.URGENCY_ACTIVE_REST, K.URGENCY_ENDED],
            "content_window": labels(K.CONTENT_WINDOWS) + [K.CONTENT_WINDOW_ACTIVE_REST,
                                                           K.CONTENT_WINDOW_ENDED],
        }),
        quality.check_accepted(marts.mart_keyword_recurrence(s, fx.AS_OF), "mart_keyword_recurrence", {
            "recurrence_label": [K.RECUR_SERIES[2], K.RECUR_RECURRING[1], K.RECUR_TWICE[1],
                                 K.RECUR_ONE_OFF],
        }),
    )


# --- sources: landed JSON -> rows -----------------------------------------------------


def _landed(spark, pages: DataFrame, name: str, schema, sf_dir: str | None = None):
    return landing.read_landing(spark, lf.land(pages, name, key=sf_dir), schema)


@register("ingest_trends")
def q_ingest_trends(spark, sf_dir):
    return landing.flatten_trends(_landed(spark, lf.trends_pages(spark, sf_dir), "trends",
                                          schemas.TRENDS_PAYLOAD, sf_dir))


@register("ingest_jobs")
def q_ingest_jobs(spark, sf_dir):
    return landing.flatten_jobs(_landed(spark, lf.jobs_pages(spark, sf_dir), "jobs", schemas.JOBS_PAYLOAD, sf_dir),
                                fx.AS_OF)


@register("ingest_posts")
def q_ingest_posts(spark, sf_dir):
    pages = _landed(spark, lf.posts_pages(spark, sf_dir), "posts", schemas.POSTS_PAYLOAD, sf_dir)
    return landing.flatten_posts(pages, fx.subreddits(spark, sf_dir), fx.AS_OF)


@register("ingest_popular")
def q_ingest_popular(spark, sf_dir):
    pages = _landed(spark, lf.popular_pages(spark, sf_dir), "popular", schemas.VIDEOS_PAYLOAD, sf_dir)
    return landing.flatten_popular(pages, fx.country_categories(spark, sf_dir), fx.countries(spark, sf_dir),
                                   fx.country_regions(spark, sf_dir))


@register("ingest_keyword_videos")
def q_ingest_kw_videos(spark, sf_dir):
    hits = _landed(spark, lf.search_pages(spark, sf_dir), "search", schemas.SEARCH_PAYLOAD, sf_dir)
    details = _landed(spark, lf.detail_pages(spark, sf_dir), "details", schemas.DETAILS_PAYLOAD, sf_dir)
    return landing.flatten_keyword_videos(hits, details, fx.video_categories(spark, sf_dir))


@register("ingest_rejects")
def q_ingest_rejects(spark, sf_dir):
    """Pages that do not fit: how many, whether they are lost, and how many rows the others still give."""
    path = shared_dir(spark, "landing", "damaged", fresh=True)
    lf.damaged_trends_pages(spark, sf_dir).write.text(path)
    pages = landing.read_landing(spark, path, schemas.TRENDS_PAYLOAD)
    lost = landing.rejected_pages(pages, "trending_searches").groupBy("lost").agg(F.count(F.lit(1)).alias("n"))
    rows = landing.flatten_trends(pages)
    return lost.select(F.when(F.col("lost"), "pages lost").otherwise("pages with bad values").alias("what"), "n").unionByName(
        rows.groupBy(F.when(F.col("search_volume").isNull(), "rows without a volume").otherwise("rows").alias("what"))
        .agg(F.count(F.lit(1)).alias("n")))


# --- snapshots, rollover, compaction -----------------------------------------------------


_AUG = _dt.datetime(1998, 8, 1)


def _posts_before_aug(spark, sf_dir):
    p = fx.posts(spark, sf_dir)
    return p.where(F.col("created") < fn.ntz_literal(_AUG)).withColumn("today_date", F.col("created"))


def _posts_batch(spark, sf_dir, run_at, upto=None):
    p = fx.posts(spark, sf_dir).where(F.col("created") >= fn.ntz_literal(_AUG))
    if upto is not None:
        p = p.where(F.col("created") < fn.ntz_literal(upto))
    return p.withColumn("today_date", fn.ntz_literal(run_at))


MONTHLY = "yyyy_MM"   # the orders span seven years, a few a day


def _new_posts_store(spark) -> SnapshotStore:
    return SnapshotStore(spark, shared_dir(spark, "store", "posts", fresh=True), schemas.POSTS, "created", MONTHLY)


def _posts_store(spark, sf_dir) -> SnapshotStore:
    """The previous month's snapshot: all history before August."""
    store = _new_posts_store(spark)
    with setting_up():
        store.append(_posts_before_aug(spark, sf_dir), "1998_jul")
    return store


def _posts_after_two_runs(spark, sf_dir, when_present="append") -> SnapshotStore:
    store = _posts_store(spark, sf_dir)
    grace = K.GRACE_DAYS["posts"]
    ro.rollover(store, _posts_batch(spark, sf_dir, fx.ROLLOVER_AS_OF), fx.ROLLOVER_AS_OF, "created", grace)
    second = _posts_batch(spark, sf_dir, fx.SECOND_RUN_AS_OF, upto=_dt.datetime(1998, 8, 2))
    ro.rollover(store, second, fx.SECOND_RUN_AS_OF, "created", grace, when_present=when_present)
    return store


@register("conform_schema")
def q_conform(spark, sf_dir):
    return conform(fx.posts(spark, sf_dir), schemas.POSTS)


@register("scan_snapshot")
def q_scan_snapshot(spark, sf_dir):
    """A full scan of one month, and of one that was never written."""
    store = _new_posts_store(spark)
    store.append(fx.posts(spark, sf_dir).withColumn("today_date", F.col("created")), "1998_jul")
    return op.union_all(store.load("1998_jul"), store.load("1998_sep"))


@register("append_then_scan")
def q_append_scan(spark, sf_dir):
    store = _new_posts_store(spark)
    store.append(_posts_before_aug(spark, sf_dir), "1998_aug")
    store.append(_posts_batch(spark, sf_dir, fx.ROLLOVER_AS_OF), "1998_aug")
    return store.load("1998_aug")


@register("rollover_empty_batch")
def q_rollover_empty(spark, sf_dir):
    """An empty batch does nothing, on the first day of a month too."""
    store = _posts_store(spark, sf_dir)
    nothing = _posts_batch(spark, sf_dir, fx.ROLLOVER_AS_OF).where("false")
    action = ro.rollover(store, nothing, fx.ROLLOVER_AS_OF, "created", K.GRACE_DAYS["posts"])
    return store.row_counts().withColumn("action", F.lit(action))


@register("rollover_union")
def q_rollover_union(spark, sf_dir):
    prev = conform(_posts_before_aug(spark, sf_dir), schemas.POSTS)
    batch = fx.posts(spark, sf_dir).where(F.col("created") >= fn.ntz_literal(_AUG))
    return op.union_all(prev, batch)


@register("rollover_flag")
def q_rollover_flag(spark, sf_dir):
    return _posts_after_two_runs(spark, sf_dir, "append").load("1998_aug")


@register("rollover_flag_skip")
def q_rollover_flag_skip(spark, sf_dir):
    return _posts_after_two_runs(spark, sf_dir, "skip").load("1998_aug")


@register("snapshot_dedupe")
def q_snapshot_dedupe(spark, sf_dir):
    store = _posts_after_two_runs(spark, sf_dir, "append")
    return ro.compact(store, "1998_aug", K.KEYS["posts"], [F.col("today_date").desc_nulls_last()])


@register("snapshot_rewrite")
def q_snapshot_rewrite(spark, sf_dir):
    store = _posts_after_two_runs(spark, sf_dir, "append")
    ro.compact(store, "1998_aug", K.KEYS["posts"], [F.col("today_date").desc_nulls_last()])
    return store.scan()


@register("row_counts")
def q_row_counts(spark, sf_dir):
    return _posts_after_two_runs(spark, sf_dir, "append").row_counts()


@register("snapshot_retention")
def q_retention(spark, sf_dir):
    store = _new_posts_store(spark)
    store.append_by_month(fx.posts(spark, sf_dir))
    store.expire(fx.ROLLOVER_AS_OF, K.SNAPSHOT_RETENTION_DAYS)
    store.vacuum()
    return store.row_counts()


def _videos_split(spark, sf_dir):
    v = fx.keyword_videos(spark, sf_dir).withColumn("published_ts", fn.parse_iso_ts("published_at"))
    ts = F.col("published_ts")
    return v.where(ts < fn.ntz_literal(_AUG)), v.where(ts >= fn.ntz_literal(_AUG))


def _new_videos_store(spark) -> SnapshotStore:
    return SnapshotStore(spark, shared_dir(spark, "store", "keyword_videos", fresh=True), schemas.KEYWORD_VIDEOS,
                         "published_ts", MONTHLY)


@register("rollover_antijoin")
def q_rollover_antijoin(spark, sf_dir):
    prev, _ = _videos_split(spark, sf_dir)
    leaked = prev.where(F.col("like_count") > 40).select(*K.ROLLOVER_MATCH_KEYS)
    return op.not_yet_present(prev.drop("published_ts"), leaked, K.ROLLOVER_MATCH_KEYS)


@register("rollover_merge")
def q_rollover_merge(spark, sf_dir):
    prev, batch = _videos_split(spark, sf_dir)
    store = _new_videos_store(spark)
    with setting_up():
        store.append(prev, "1998_jul")
        store.append(prev.where(F.col("like_count") > 40), "1998_aug")
    ro.rollover_merge(store, batch, fx.MERGE_AS_OF, "published_ts", against="leaked")
    return store.load("1998_aug")


@register("rollover_merge_twice")
def q_rollover_merge_twice(spark, sf_dir):
    """Two daily runs of the grace week, each with half of the new videos: history comes over once."""
    prev, batch = _videos_split(spark, sf_dir)
    store = _new_videos_store(spark)
    with setting_up():
        store.append(prev, "1998_jul")
        store.append(prev.where(F.col("like_count") > 40), "1998_aug")
    for half, as_of in ((0, fx.MERGE_AS_OF), (1, fx.MERGE_AS_OF + _dt.timedelta(days=1))):
        ro.rollover_merge(store, batch.where(F.col("like_count") % 2 == half), as_of, "published_ts")
    return store.load("1998_aug")


@register("compact_jobs")
def q_compact_jobs(spark, sf_dir):
    """A capture of all jobs, then one of every second: in buckets of the key, the newest capture stays."""
    store = SnapshotStore(spark, shared_dir(spark, "store", "jobs", fresh=True), schemas.JOBS, buckets=(K.KEYS["jobs"], 32))
    pages = _landed(spark, lf.jobs_pages(spark, sf_dir), "jobs", schemas.JOBS_PAYLOAD, sf_dir)
    later = landing.flatten_jobs(pages, fx.AS_OF + _dt.timedelta(hours=4)).where("cast(job_id as bigint) % 2 = 0")
    for rows in (landing.flatten_jobs(pages, fx.AS_OF), later):
        store.append(rows, "2024_jan")
        ro.compact(store, "2024_jan", K.KEYS["jobs"], ["scraped_at"])
    return store.load("2024_jan")


@register("refused_batch")
def q_refused_batch(spark, sf_dir):
    """Rules run on a written batch before it is published: the month stays, the rule is named."""
    store = SnapshotStore(spark, shared_dir(spark, "store", "ruled", fresh=True), schemas.TRENDS, "start_date")
    trends = fx.trends(spark, sf_dir)
    store.append(trends.where("end_date is not null"), "2024_jan", rules=not_null(["query", "end_date"]))
    try:
        store.append(trends, "2024_jan", rules=not_null(["query", "end_date"]))
    except RulesBroken as e:
        broken = spark.createDataFrame(sorted(e.counts.items()), "what string, n bigint")
    return store.load("2024_jan").agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("what"), "n").unionByName(broken)


@register("compact_trends")
def q_compact_trends(spark, sf_dir):
    """Two captures of all trends, the later one with larger volumes: it stays."""
    store = SnapshotStore(spark, shared_dir(spark, "store", "trends", fresh=True), schemas.TRENDS, "start_date")
    for at in (lf.SECOND_CAPTURE, lf.FIRST_CAPTURE):
        pages = landing.read_landing(spark, lf.land(lf.trends_pages(spark, sf_dir, captured_at=at), "capture"), schemas.TRENDS_PAYLOAD)
        store.append(landing.flatten_trends(pages), "2024_jan")
    return ro.compact(store, "2024_jan", K.KEYS["trends"], ["captured_at"])


@register("compact_keyword_videos")
def q_compact_videos(spark, sf_dir):
    """Two loads of the keyword videos, the second captured later with more views: it stays."""
    store = _new_videos_store(spark)
    videos = fx.keyword_videos(spark, sf_dir).withColumn("published_ts", fn.parse_iso_ts("published_at"))
    store.append(videos.withColumn("captured_at", fn.ntz_literal(fx.SECOND_RUN_AS_OF)).withColumn(
        "view_count", F.col("view_count") + 5000), "1998_aug")
    store.append(videos.withColumn("captured_at", fn.ntz_literal(fx.ROLLOVER_AS_OF)), "1998_aug")
    return ro.compact(store, "1998_aug", K.KEYS["keyword_videos"], ["captured_at"])


# --- end-to-end keyword gap ----------------------------------------------------------------


@register("gap_end_to_end")
def q_gap_end_to_end(spark, sf_dir):
    search = _landed(spark, lf.search_pages(spark, sf_dir), "search", schemas.SEARCH_PAYLOAD, sf_dir)
    details = _landed(spark, lf.detail_pages(spark, sf_dir), "details", schemas.DETAILS_PAYLOAD, sf_dir)
    store = _new_videos_store(spark)
    return gap_chain.keyword_gap(stg(spark, sf_dir), search, details, fx.video_categories(spark, sf_dir),
                                 fx.trends(spark, sf_dir), store, fx.AS_OF)


# --- marts from stored partials --------------------------------------------------------------


def _trend_partials(spark, sf_dir, day, name: str) -> SnapshotStore:
    """Partials after two refreshes: of all days but the last two, then of the days that came or changed since."""
    trends = fx.trends(spark, sf_dir)
    source = SnapshotStore(spark, shared_dir(spark, "store", f"{name}_trends", fresh=True), schemas.TRENDS, "start_date")
    rows = stg(spark, sf_dir)
    partial = pt.partial_store(spark, shared_dir(spark, "partials", name, fresh=True), day, rows, "trend_date")
    last_days = F.col("start_date") >= fn.ntz_literal(fx.AS_OF - _dt.timedelta(days=3))
    for part, as_of in ((trends.where(~last_days | F.col("start_date").isNull()), fx.AS_OF - _dt.timedelta(days=3)),
                        (trends.where(last_days), fx.AS_OF)):
        source.append(part, "2024_jan")
        pt.refresh_trend_partials(source, "2024_jan", partial, day, as_of)
    return partial


@register("pulse_by_partials")
def q_pulse_by_partials(spark, sf_dir):
    return pt.mart_category_pulse(_trend_partials(spark, sf_dir, pt.pulse_day, "pulse").load(si.TABLE))


@register("recurrence_by_partials")
def q_recurrence_by_partials(spark, sf_dir):
    return pt.mart_keyword_recurrence(_trend_partials(spark, sf_dir, pt.recurrence_day, "recurrence").load(si.TABLE), fx.AS_OF)


@register("top_hours_by_states")
def q_top_hours(spark, sf_dir):
    """Most frequent start hour per category over daily heavy-hitter states; trends without a time count as NULL."""
    nulled = stg(spark, sf_dir).withColumn("start_hour_eat", F.when(F.col("search_volume") % 3 != 0, F.col("start_hour_eat")))
    return pt.top_hours(pt.hours_day(nulled))


@register("gap_by_partials")
def q_gap_by_partials(spark, sf_dir):
    """The gap mart with medians from quantile sketches of the days, stored and merged."""
    recurrence = _trend_partials(spark, sf_dir, pt.recurrence_day, "gap").load(si.TABLE)
    videos = fx.keyword_videos(spark, sf_dir).withColumn("published_ts", fn.parse_iso_ts("published_at"))
    source = _new_videos_store(spark)
    supply = SnapshotStore(spark, shared_dir(spark, "partials", "supply", fresh=True), pt.supply_day(videos.limit(0)).schema,
                           "published_day", MONTHLY)
    first = F.col("published_ts") < fn.ntz_literal(_AUG)
    for part in (videos.where(first), videos.where(~first | first.isNull())):
        source.append(part, "1998_aug")
        pt.refresh_supply_partials(source, "1998_aug", supply)
    return pt.mart_gap_analysis(supply.load(si.TABLE), recurrence, fx.AS_OF)


# --- streaming ---------------------------------------------------------------------------


def _append_landing(pages: DataFrame, path: str) -> None:
    with setting_up():
        pages.write.mode("append").json(path)


def _stream_folders(spark, name: str) -> tuple[str, str, SnapshotStore]:
    """(landing folder, checkpoint, keyed store of trends)"""
    schema = _T.StructType([*schemas.TRENDS.fields, _T.StructField(si.BATCH_COL, _T.LongType())])
    target = SnapshotStore(spark, shared_dir(spark, "store", name, fresh=True), schema, "start_date")
    return shared_dir(spark, "landing", name, fresh=True), shared_dir(spark, "checkpoints", name, fresh=True), target


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Two scheduled runs: a full capture, then a re-capture of the 'view' trends (now ended)."""
    land_dir, ckpt, target = _stream_folders(spark, "stream_ingest")
    for pages in (lf.trends_pages(spark, sf_dir), lf.trends_pages(spark, sf_dir, rescrape_views=True)):
        _append_landing(pages, land_dir)
        si.stream_upsert(spark, land_dir, schemas.TRENDS_PAYLOAD, "trending_searches", landing.flatten_trends, target,
                         K.KEYS["trends"], ckpt)
    return target.load(si.TABLE).drop(si.BATCH_COL)


def _trend_loads(spark, sf_dir, name: str):
    """(load, folder of its store, checkpoint): a load of trends over damaged pages that has run once."""
    land_dir, ckpt, target = _stream_folders(spark, name)
    with setting_up():
        lf.damaged_trends_pages(spark, sf_dir).write.text(land_dir)
    run = lambda: loads.load(spark, "trends", land_dir, target.base, ckpt, fx.AS_OF)
    run()
    return run, target.base, ckpt, land_dir


@register("stream_replay")
def q_stream_replay(spark, sf_dir):
    """A load whose last batch runs again, as after a failure: rows, rejects and reports stay as they were."""
    run, base, ckpt, _ = _trend_loads(spark, sf_dir, "stream_replay")
    commit = spark._jvm.org.apache.hadoop.fs.Path(f"{ckpt}/commits/0")
    commit.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commit, False)
    action = run()["actions"][0]
    rows = loads.store_of(spark, "trends", base).load("2024_jan")
    counted = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("what"), "n")
    rejects = spark.read.parquet(f"{base}_rejects").groupBy(F.when(F.col("lost"), "pages lost").otherwise("pages with bad values").alias("what"))
    reports = loads.load_reports(spark, base).agg(F.count(F.lit(1)).alias("n")).select(F.lit("reports").alias("what"), "n")
    return counted.unionByName(rejects.agg(F.count(F.lit(1)).alias("n"))).unionByName(reports).withColumn("second_run", F.lit(action))


@register("load_report")
def q_load_report(spark, sf_dir):
    """What two loads did: of damaged pages, then of sound ones that capture the same trends later."""
    run, base, _, land_dir = _trend_loads(spark, sf_dir, "load_report")
    _append_landing(lf.trends_pages(spark, sf_dir, captured_at=lf.SECOND_CAPTURE), land_dir)
    run()
    return loads.load_reports(spark, base).select("dataset", "month", "action", "pages", "rejected_pages", "lost_pages", "rows", "duplicates")


@register("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    """Two runs whose captures overlap: by (query, start_date) the later capture, with larger volumes, replaces;
    what comes more than seven days behind the first run is returned as late."""
    land_dir, ckpt, target = _stream_folders(spark, "stream_dedupe")
    late = shared_dir(spark, "sinks", "stream_dedupe", fresh=True)
    counts = []
    for pages in (lf.trends_pages(spark, sf_dir, where="start_date < timestamp_ntz'2024-01-25 00:00:00'"),
                  lf.trends_pages(spark, sf_dir, where="start_date >= timestamp_ntz'2024-01-10 00:00:00'",
                                  captured_at=lf.SECOND_CAPTURE)):
        _append_landing(pages, land_dir)
        counts.append(si.stream_newest(spark, land_dir, schemas.TRENDS_PAYLOAD, landing.flatten_trends, K.KEYS["trends"],
                                       "start_date", "captured_at", "7 days", target, late, ckpt, ttl_ms=30 * 86400 * 1000))
    kept = target.load(si.TABLE).drop(si.BATCH_COL).withColumn("late", F.lit(False))
    behind = spark.read.schema(schemas.TRENDS).parquet(late).drop("writer", "batch") if counts[1] else spark.createDataFrame([], schemas.TRENDS)
    return kept.unionByName(behind.withColumn("late", F.lit(True))).withColumn("late_rows", F.lit(counts[1]).cast("bigint"))


@register("stream_category_pulse")
def q_stream_pulse(spark, sf_dir):
    """Two runs: the later days first, then late and overlapping pages of the earlier ones, captured
    anew. Every day of the batch pulse comes out, each keyword counted once at its newest volume."""
    land_dir, ckpt, target = _stream_folders(spark, "stream_pulse")
    pulse = SnapshotStore(spark, shared_dir(spark, "store", "pulse", fresh=True), si.PULSE, "trend_date")
    for pages in (lf.trends_pages(spark, sf_dir, where="start_date >= timestamp_ntz'2024-01-12 00:00:00'"),
                  lf.trends_pages(spark, sf_dir, where="start_date < timestamp_ntz'2024-01-20 00:00:00'",
                                  captured_at=lf.SECOND_CAPTURE)):
        _append_landing(pages, land_dir)
        si.stream_category_pulse(spark, land_dir, schemas.TRENDS_PAYLOAD, "trending_searches", landing.flatten_trends,
                                 target, pulse, K.KEYS["trends"], ckpt)
    return pulse.load(si.TABLE)


# --- published views ---------------------------------------------------------------------


@register("published_views")
def q_published_views(spark, sf_dir):
    """Refreshed marts published as views and queried with SQL, as a dashboard would."""
    out = shared_dir(spark, "refresh", fresh=True)
    views.publish_views(spark, refresh.refresh_marts(
        spark, fx.trends(spark, sf_dir), fx.keyword_videos(spark, sf_dir), fx.AS_OF, out))
    return spark.sql("""
        select 'topics' as mart, urgency_tier as label, count(*) as n, max(recommendation_score) as best
        from mart_trending_topics group by urgency_tier
        union all select 'pulse', day_of_week, count(*), cast(max(total_search_volume) as double)
        from mart_category_pulse group by day_of_week
        union all select 'recurrence', recurrence_label, count(*), cast(max(times_trended) as double)
        from mart_keyword_recurrence group by recurrence_label
        union all select 'gap', opportunity, count(*), max(gap_score) from mart_gap_analysis group by opportunity
        union all select 'staging', month_name, count(*), cast(max(search_volume) as double)
        from stg_trending_now group by month_name""")


def prepare_inputs(spark: SparkSession, sf_dir: str) -> None:
    """Land every API-shaped input once for this application (later queries reuse the files)."""
    for pages, name in ((lf.trends_pages(spark, sf_dir), "trends"), (lf.jobs_pages(spark, sf_dir), "jobs"),
                        (lf.posts_pages(spark, sf_dir), "posts"), (lf.popular_pages(spark, sf_dir), "popular"),
                        (lf.search_pages(spark, sf_dir), "search"), (lf.detail_pages(spark, sf_dir), "details")):
        lf.land(pages, name, key=sf_dir)
