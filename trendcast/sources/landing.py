"""Landed API payloads (JSON lines) -> typed, flat rows.

Each payload is one page of an API response. ``read_landing`` scans a landing
folder with a declared schema (no inference pass); ``parse_payloads`` does the
same for JSON text already in a column. The flatteners are plain
``explode`` + ``select`` plans: no Python per row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendcast import constants as K
from trendcast import schemas
from trendcast.functions.text import int_or_zero, iso_duration_secs, join_names, tags_text
from trendcast.functions.timeparts import from_epoch, ntz_literal, parse_iso_ts
from trendcast.functions.scoring import engagement_intensity, engagement_rate
from trendcast.operators.dedupe import keep_one
from trendcast.operators.filters import watchable, with_id
from trendcast.operators.joins import attach_stats, lookup
from trendcast.session import delete_path, file_bytes, rounds_for, scratch_dir, shuffles_freed


CORRUPT = "_corrupt_record"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Pages of a landing folder. A page that does not fit the schema keeps its text in
    ``_corrupt_record``: truncated ones have nothing else, ones with a bad value have
    NULL there and all other values. See :func:`rejected_pages`."""
    return (spark.read.schema(with_corrupt_column(schema)).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def rejected_pages(payloads: DataFrame, items: str) -> DataFrame:
    """(payload, lost) of the pages that did not fit: ``lost`` when no item could be read,
    else only single values are missing and the page's rows are among the flattened ones."""
    return (payloads.select(CORRUPT, items).where(F.col(CORRUPT).isNotNull())
            .select(F.col(CORRUPT).alias("payload"), F.col(items).isNull().alias("lost")))


def parse_payloads(df: DataFrame, text_col: str, schema: T.StructType) -> DataFrame:
    """Pages from JSON text in a column, with ``_corrupt_record`` as :func:`read_landing` has it."""
    parsed = F.from_json(F.col(text_col), with_corrupt_column(schema), {"columnNameOfCorruptRecord": CORRUPT})
    return df.select(parsed.alias("_p")).select("_p.*")


_EMPTY = r"^\s*(\[\s*\]|\{\s*\})\s*$"


def _nested_json(name: str, text: Column, whole: Column) -> Column:
    """Field ``name`` as JSON text; NULL when it is absent or falsy by its value (empty, null, false, 0, "").

    ``text`` is the field as the reader has it: the raw text of arrays, objects,
    numbers and booleans, and the bare characters of a string. Which of them it is
    says ``whole``, the VARIANT of all fields; a string is quoted again.
    """
    part = F.try_variant_get(whole, f"$.{name}", "variant")
    kind = F.schema_of_variant(part)
    quoted = F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    number = F.try_variant_get(part, "$", "double")
    falsy = ((kind == "VOID") | ((kind == "STRING") & (text == "")) | ((kind == "BOOLEAN") & (text == "false"))
             | (kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & (number == 0)) | (kind.rlike("^(ARRAY|OBJECT)") & text.rlike(_EMPTY)))
    return F.when(text.isNotNull() & ~F.coalesce(falsy, F.lit(False)), F.when(kind == "STRING", quoted).otherwise(text))


def malformed_jobs(payloads: DataFrame) -> DataFrame:
    """(job): entries of job pages that are no JSON objects; :func:`flatten_jobs` leaves them out."""
    j = payloads.select(F.explode("jobs_results").alias("job"))
    return j.where(F.col("job").isNull() | ~F.coalesce(F.schema_of_variant(F.try_parse_json("job")).startswith("OBJECT"), F.lit(False)))


def malformed_counts(payloads: DataFrame) -> DataFrame:
    """(video_id, counter, value) of counters that are present but no whole numbers.

    :func:`video_rows` takes them as 0, so a bad view count removes the video
    from the watchable ones; this is where it can be seen.
    """
    v = payloads.select(F.explode("items").alias("v"))
    counters = ["viewCount", "likeCount", "commentCount"]
    each = v.select(F.col("v.id").alias("video_id"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("counter"), F.col(f"v.statistics.{c}").alias("value")) for c in counters])).alias("c"))
    return each.select("video_id", "c.*").where(F.col("value").isNotNull() & F.col("value").try_cast("bigint").isNull())


def flatten_trends(payloads: DataFrame) -> DataFrame:
    """Trending-searches pages -> trends rows (links dropped, names joined, epochs parsed)."""
    t = payloads.select("captured_at", F.explode("trending_searches").alias("t")).select("captured_at", "t.*")
    return t.select(
        F.col("query"),
        from_epoch("start_timestamp").alias("start_date"),
        from_epoch("end_timestamp", falsy_null=True).alias("end_date"),
        F.coalesce(F.col("active"), F.lit(False)).alias("active"),
        F.col("search_volume"),
        F.col("increase_percentage"),
        join_names("categories", "name").alias("categories"),
        join_names("trend_breakdown").alias("trend_breakdown"),
        from_epoch("captured_at").alias("captured_at"),
    )


def flatten_jobs(payloads: DataFrame, scraped_at: dt.datetime) -> DataFrame:
    """Job-search pages -> job rows; nested parts kept as JSON text, stamped with the run time.

    Entries that are no JSON objects are left out (:func:`malformed_jobs`).
    """
    parsed = payloads.select(F.explode("jobs_results").alias("job")).select(
        F.from_json("job", schemas.JOB_ITEM).alias("j"), F.try_parse_json("job").alias("v"))
    j = parsed.where(F.schema_of_variant("v").startswith("OBJECT"))
    nested = ["job_highlights", "extensions", "detected_extensions", "apply_options"]
    return j.select(
        *[F.col(f"j.{c}").alias(c) for c in ("title", "company_name", "location", "via", "description")],
        *[_nested_json(c, F.col(f"j.{c}"), F.col("v")).alias(c) for c in nested],
        F.col("j.job_id").alias("job_id"),
        ntz_literal(scraped_at).alias("scraped_at"),
    )


def flatten_posts(payloads: DataFrame, subreddits: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Forum listing pages -> 20-column post rows with engagement metrics.

    Subscribers come from the subreddit dimension; one row is kept per post id.
    """
    p = payloads.select("genre", F.posexplode("posts").alias("_at", "p")).select("genre", "_at", "p.*")
    rows = p.select(
        "_at",
        "genre", "title", F.col("link_flair_text").alias("flair"), "score", "id", "subreddit", "url",
        "num_comments", F.col("selftext").alias("body"), "upvote_ratio",
        F.coalesce(F.col("total_awards_received"), F.lit(0).cast("bigint")).alias("awards"),
        F.coalesce(F.col("author"), F.lit("None")).alias("author"),
        F.coalesce(F.col("over_18"), F.lit(False)).alias("over_18"),
        F.coalesce(F.col("spoiler"), F.lit(False)).alias("spoiler"),
        "is_self",
        from_epoch(F.floor(F.col("created"))).alias("created"),
        ntz_literal(as_of).alias("today_date"),
    )
    subs = subreddits.select("subreddit", F.col("subscribers").cast("bigint").alias("subscribers"))
    with_subs = rows.join(subs, "subreddit", "left")
    out = with_subs.select(
        "_at", *[c for c in schemas.POSTS.fieldNames() if c not in ("engagement_rate", "engagement_intensity")],
        engagement_rate().alias("engagement_rate"),
        engagement_intensity().alias("engagement_intensity"),
    )
    # The listing's first occurrence stays, as it is met first.
    return keep_one(out, K.KEYS["posts"], [F.col("_at"), F.col("genre")]).drop("_at")


def video_rows(payloads: DataFrame) -> DataFrame:
    """Video-detail pages -> one row per item, counts as numbers (missing -> 0).

    Pages read without descriptions (``schemas.DETAILS_PAYLOAD``) give rows without them.
    """
    snippet = payloads.schema["items"].dataType.elementType["snippet"].dataType
    described = [F.col("v.snippet.description").alias("description")] if "description" in snippet.fieldNames() else []
    v = payloads.select("region_code", "captured_at", F.explode("items").alias("v"))
    return v.select(
        "region_code",
        from_epoch("captured_at").alias("captured_at"),
        F.col("v.id").alias("video_id"),
        F.col("v.snippet.title").alias("title"),
        *described,
        F.col("v.snippet.channelTitle").alias("channel_title"),
        F.col("v.snippet.categoryId").alias("category_id"),
        F.col("v.snippet.publishedAt").alias("published_at"),
        parse_iso_ts("v.snippet.publishedAt").alias("published_ts"),
        F.col("v.snippet.tags").alias("tags"),
        F.col("v.contentDetails.duration").alias("duration"),
        int_or_zero("v.statistics.viewCount").alias("view_count"),
        int_or_zero("v.statistics.likeCount").alias("like_count"),
        int_or_zero("v.statistics.commentCount").alias("comment_count"),
    )


def newest_first() -> list:
    """The order of a dedupe in which the newest capture wins."""
    return [F.col("captured_at").desc_nulls_last()]


def flatten_popular(payloads: DataFrame, categories: DataFrame, countries: DataFrame,
                    regions: DataFrame) -> DataFrame:
    """Most-popular pages per country -> popular-video rows with country, region and category names.

    Category titles are looked up per country (``categories``: country_code,
    category_id, category_title), as each country has its own list.
    """
    v = video_rows(payloads).withColumnRenamed("region_code", "country_code")
    v = lookup(v, countries, on="country_code", value="country_name")
    v = lookup(v, regions, on="country_code", value="region")
    v = lookup(v, categories, on=["country_code", "category_id"], value="category_title", out="category_name")
    v = tags_text(v, "tags").withColumn("duration_secs", iso_duration_secs("duration"))
    out = watchable(v).select(*schemas.POPULAR.fieldNames())
    return keep_one(out, K.KEYS["popular"], newest_first())


def search_hits(payloads: DataFrame) -> DataFrame:
    """Search pages -> distinct (keyword, video_id); items without a video id are dropped."""
    return _hit_rows(payloads).distinct()


def _hit_rows(payloads: DataFrame) -> DataFrame:
    h = payloads.select("keyword", F.explode("items").alias("i")).select(
        "keyword", F.col("i.id.videoId").alias("video_id"))
    return with_id(h, "video_id")


def flatten_keyword_videos(hits: DataFrame, stats: DataFrame, categories: DataFrame,
                           region_code: str = "KE") -> DataFrame:
    """Keyword search hits x video details -> keyword-video rows (watchable only).

    Details are cut to the stored columns and reduced to one row per video (the
    newest capture) before the join, so each hit matches at most once; hits
    without details drop out. Many details are joined in rounds, whose results
    are written (:func:`keyword_video_rounds`).
    """
    n = rounds_for(file_bytes(stats))
    rounds = keyword_video_rounds(hits, stats, categories, region_code, n)
    if n == 1:
        return next(rounds)
    path = scratch_dir(stats.sparkSession, "keyword_videos")
    for rows in rounds:
        with shuffles_freed(stats.sparkSession):
            rows.write.mode("append").option("compression", "zstd").parquet(path)
    return stats.sparkSession.read.schema(rows.schema).parquet(path)


_ROUND = "_round"


def keyword_video_rounds(hits: DataFrame, stats: DataFrame, categories: DataFrame, region_code: str = "KE",
                         n: int | None = None) -> Iterator[DataFrame]:
    """The rows of :func:`flatten_keyword_videos` in rounds: each has the videos of a hash range, hits and details.

    The shuffles of whole rows for the dedupe, the join and the lookup would
    together take several times the disk of the pages. So pages are read once,
    their rows dealt to the rounds as compressed columns, and these go when the
    next round is asked for: write one before that.
    """
    spark, n = stats.sparkSession, n or rounds_for(file_bytes(stats))
    rows, found = video_rows(stats).drop("region_code", "description"), _hit_rows(hits)
    if n == 1:
        yield _keyword_videos(found, rows, categories, region_code)
        return
    folders = [(scratch_dir(spark, name), df) for name, df in (("hits", found), ("details", rows))]
    try:
        for path, df in folders:
            dealt = df.where(F.col("video_id").isNotNull()).withColumn(_ROUND, F.pmod(F.xxhash64("video_id"), F.lit(n)).cast("int"))
            with shuffles_freed(spark):
                dealt.write.partitionBy(_ROUND).option("compression", "zstd").parquet(path)
        for i in range(n):
            mine = [spark.read.schema(T.StructType([*df.schema.fields, T.StructField(_ROUND, T.IntegerType())])).parquet(path)
                    .where(F.col(_ROUND) == i).drop(_ROUND) for path, df in folders]
            yield _keyword_videos(*mine, categories, region_code)
            for path, _ in folders:
                delete_path(spark, f"{path}/{_ROUND}={i}")
    finally:
        for path, _ in folders:
            delete_path(spark, path)


def _keyword_videos(found: DataFrame, rows: DataFrame, categories: DataFrame, region_code: str) -> DataFrame:
    return _joined(found.distinct(), keep_one(rows, ["video_id"], newest_first()), categories, region_code)


def join_keyword_videos(hits: DataFrame, details: DataFrame, categories: DataFrame, region_code: str = "KE") -> DataFrame:
    """Search pages x one details row per video (as :func:`video_rows` has them) -> keyword-video rows."""
    return _joined(search_hits(hits), details, categories, region_code)


def _joined(found: DataFrame, details: DataFrame, categories: DataFrame, region_code: str) -> DataFrame:
    joined = attach_stats(found, details, "video_id")
    joined = lookup(joined, categories, on="category_id", value="category_title", out="category_name")
    joined = (tags_text(joined, "tags")
              .withColumn("duration_secs", iso_duration_secs("duration"))
              .withColumn("region_code", F.lit(region_code)))
    return watchable(joined).select(*schemas.KEYWORD_VIDEOS.fieldNames())
