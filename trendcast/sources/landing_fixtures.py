"""API-shaped JSON pages built from the given tables, for the landing sources.

Pages hold a bounded number of items, grouped by a key range (larger than a
real API page, to keep the number of small files down), so no page collects an
unbounded group. ``land`` writes pages as JSON lines into
a folder below the shared checkpoint folder.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendcast.functions.timeparts import epoch_seconds
from trendcast.session import shared_dir, shuffles_freed
from trendcast.sources.fixtures import CATEGORY_ID, POSTS_COLUMNS, TRENDS_COLUMNS, VIDEO_COLUMNS
from trendcast.sources.tables import read_table

# When the pages were fetched: the first capture of a day, and a later one.
FIRST_CAPTURE, SECOND_CAPTURE = 1706659200, 1706673600

# Strings in the place of a nested part: text that reads like JSON, and an empty one.
PLAIN_PARTS = ["5 days ago", "true story", "[draft] offer", "0", "null", ""]

# Orders per landed page: pages are bounded by a key range, never by a whole group.
PAGE_ORDERS = 2000

# Landed pages repeat their field names in every item: compressed they are a fraction of the size.
PAGES_CODEC = "deflate"


def _epoch_secs(col: str):
    return epoch_seconds(col)


_LANDED: dict[tuple, str] = {}


def land(df: DataFrame, name: str, key: tuple | None = None) -> str:
    """Write pages as JSON lines; with a ``key``, pages already landed in this
    application (same builder, same tables) are reused, as files that arrived
    once stay in a landing folder."""
    spark = df.sparkSession
    cache_key = (spark.sparkContext.applicationId, name, key) if key is not None else None
    if cache_key in _LANDED:
        return _LANDED[cache_key]
    path = shared_dir(spark, "landing", name, fresh=True)
    with shuffles_freed(spark):
        df.write.option("compression", PAGES_CODEC).json(path)
    if cache_key is not None:
        _LANDED[cache_key] = path
    return path


def trends_pages(spark: SparkSession, sf_dir: str, where: str | None = None,
                 rescrape_views: bool = False, captured_at: int = FIRST_CAPTURE) -> DataFrame:
    """Trending-searches pages from the events table.

    ``where`` keeps a time slice (a scrape's look-back); ``rescrape_views`` is a
    later capture of the 'view' trends, now ended (inactive, end = start + 2 h
    when it had none). ``captured_at`` stamps the pages; a later one has larger volumes.
    """
    ev = read_table(spark, sf_dir, "events").selectExpr(*TRENDS_COLUMNS, "event_id", "event_type",
                                                       "event_id div 1000 as page")
    if where:
        ev = ev.where(where)
    if rescrape_views:
        ev = ev.where(F.col("event_type") == "view").withColumns({
            "active": F.lit(False),
            "end_date": F.coalesce(F.col("end_date"), F.col("start_date") + F.expr("INTERVAL 2 HOURS")),
        })
    end_text = (F.when(F.col("end_date").isNotNull(), _epoch_secs("end_date").cast("string"))
                .when(F.col("event_id") % 8 == 0, F.lit("")))
    item = F.struct(
        F.col("query"),
        _epoch_secs("start_date").cast("string").alias("start_timestamp"),
        end_text.alias("end_timestamp"),
        F.col("active"),
        (F.col("search_volume") + (0 if captured_at == FIRST_CAPTURE else 7)).alias("search_volume"),
        F.col("increase_percentage"),
        F.transform(F.split("categories", ", "),
                    lambda x: F.struct(F.lit(7).alias("id"), x.alias("name"))).alias("categories"),
        F.split("trend_breakdown", ", ").alias("trend_breakdown"),
        F.concat(F.lit("trends?q="), F.col("query")).alias("serpapi_google_trends_link"),
    )
    return ev.groupBy("page").agg(F.lit(captured_at).cast("bigint").alias("captured_at"),
                                  F.collect_list(item).alias("trending_searches")).drop("page")


def damaged_trends_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as JSON text: of every three by number one is cut off in the middle, one has a
    volume with letters in it, and one is sound."""
    pages = trends_pages(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    kind = F.get_json_object("value", "$.trending_searches[0].start_timestamp").cast("bigint") % 3
    return pages.select(F.when(kind == 0, F.expr("left(value, length(value) div 2)"))
                        .when(kind == 1, F.regexp_replace("value", r'"search_volume":(\d+)', r'"search_volume":"$1K+"'))
                        .otherwise(F.col("value")).alias("value"))


def jobs_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    item = F.struct(
        F.col("lang").alias("title"),
        F.concat(F.lit("co "), F.col("lang")).alias("company_name"),
        F.col("source").alias("location"),
        F.concat(F.lit("via "), F.col("lang")).alias("via"),
        F.col("text").alias("description"),
        F.array(F.struct(F.lit("Qualifications").alias("title"),
                         F.array(F.col("lang")).alias("items"))).alias("job_highlights"),
        # A list as a rule; some pages give a plain string there, and such strings may look like JSON.
        F.parse_json(F.coalesce(F.get(F.array(*[F.lit(json.dumps(p)) for p in PLAIN_PARTS]), (F.col("doc_id") % 10).cast("int")),
                                F.when(F.col("n_chars") % 2 == 0, F.to_json(F.array(F.col("source")))).otherwise("[]"))).alias("extensions"),
        F.when(F.col("n_chars") % 3 == 0,
               F.struct(F.col("n_chars").cast("string").alias("posted_at"))).alias("detected_extensions"),
        F.array(F.struct(F.concat(F.lit("Apply on "), F.col("source")).alias("title"))).alias("apply_options"),
        F.col("doc_id").cast("string").alias("job_id"),
    )
    # Here and below, rows meet before an item is made of them, so that its repeated parts do not shuffle.
    return (d.withColumn("page", F.col("doc_id").cast("bigint") / F.lit(200)).withColumn("page", F.floor("page")).repartition("page")
            .groupBy("page").agg(F.collect_list(item).alias("jobs_results")).drop("page"))


def posts_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").withColumn("page", F.expr("o_orderkey div 2000")).repartition(
        "o_orderpriority", "page").selectExpr(*POSTS_COLUMNS, "o_orderstatus", "o_custkey", "o_orderkey", "page")
    item = F.struct(
        F.concat(F.lit("post "), F.col("id")).alias("title"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("link_flair_text"),
        F.col("score"),
        F.col("id"),
        F.col("subreddit"),
        F.concat(F.lit("/r/"), F.col("subreddit"), F.lit("/"), F.col("id")).alias("url"),
        F.col("num_comments"),
        F.concat(F.lit("status "), F.col("o_orderstatus")).alias("selftext"),
        F.col("upvote_ratio"),
        F.when(F.col("awards") != 0, F.col("awards")).alias("total_awards_received"),
        F.when(F.col("o_custkey") % 7 != 0,
               F.concat(F.lit("u"), F.col("o_custkey").cast("string"))).alias("author"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(True)).alias("over_18"),
        F.lit(False).alias("spoiler"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit(True)).alias("is_self"),
        _epoch_secs("created").cast("double").alias("created"),
    )
    return (o.groupBy("subreddit", "page")
            .agg(F.lit("rising").alias("genre"), F.collect_list(item).alias("posts")).drop("page"))


def _video_source(spark: SparkSession, sf_dir: str, *page: str) -> DataFrame:
    """Lines as videos; those of a page meet before the video's texts are made from them, so that only short rows shuffle."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
        "l_linestatus", "l_shipdate", F.floor(F.col("l_orderkey") / F.lit(PAGE_ORDERS)).alias("page"))
    return lines.withColumn("country_code", F.expr("cast(l_suppkey % 30 as string)")).repartition(*page).selectExpr(
        *VIDEO_COLUMNS, "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus",
        CATEGORY_ID, "country_code", "page")


def _video_item(later: bool = False):
    """An item of a details page; ``later`` is a second capture, with more views."""
    views = F.col("view_count") + (5000 if later else 0)
    return F.struct(
        # Details of returned lines come back under an id that no search has given.
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("gone_"), F.col("video_id"))).otherwise(F.col("video_id")).alias("id"),
        F.struct(
            F.concat(F.lit("video "), F.col("video_id")).alias("title"),
            F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("description"),
            F.concat(F.lit("ch "), F.col("l_suppkey").cast("string")).alias("channelTitle"),
            F.col("category_id").alias("categoryId"),
            F.col("published_at").alias("publishedAt"),
            F.split(F.lower(F.col("keyword")), " ").alias("tags"),
        ).alias("snippet"),
        F.struct(
            views.cast("string").alias("viewCount"),
            F.when(F.col("like_count") % 10 != 0, F.col("like_count").cast("string")).alias("likeCount"),
            F.col("comment_count").cast("string").alias("commentCount"),
        ).alias("statistics"),
        F.struct(F.col("duration")).alias("contentDetails"),
    )


def popular_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _video_source(spark, sf_dir, "country_code", "page")
    return (v.groupBy(F.col("country_code").alias("region_code"), "page")
            .agg(F.lit(FIRST_CAPTURE).cast("bigint").alias("captured_at"), F.collect_list(_video_item()).alias("items")).drop("page"))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search results per keyword; line 7 items point at a channel (no video id)."""
    v = _video_source(spark, sf_dir, "page")
    item = F.struct(F.struct(
        F.when(F.col("l_linenumber") == 7, F.lit("youtube#channel")).otherwise(F.lit("youtube#video")).alias("kind"),
        F.when(F.col("l_linenumber") != 7, F.col("video_id")).alias("videoId")).alias("id"))
    return v.groupBy("keyword", "page").agg(F.collect_list(item).alias("items")).drop("page")


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video details; second lines are fetched again later, with more views."""
    v = _video_source(spark, sf_dir, "page")
    once = v.groupBy("page").agg(F.lit(FIRST_CAPTURE).cast("bigint").alias("captured_at"),
                                             F.collect_list(_video_item()).alias("items"))
    again = v.where(F.col("l_linenumber") == 2).groupBy("page").agg(
        F.lit(SECOND_CAPTURE).cast("bigint").alias("captured_at"), F.collect_list(_video_item(later=True)).alias("items"))
    return once.unionByName(again).withColumn("region_code", F.lit("KE")).drop("page")
