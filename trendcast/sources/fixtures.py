"""Reference-like inputs derived from the given tables.

The given tables are TPC-H-like; these adapters re-shape them into the datasets
the analytics run on (trends, keyword videos, jobs, posts, lookups). Every
adapter is a plain projection of a whole table (or a small dimension), so the
work grows with the data. The DuckDB twins live in ``trendcast.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendcast.sources.tables import read_table

# The events table covers 2024-01-01 .. 2024-01-30, so "now" for the marts is:
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)

# Snapshot scenarios over orders / lineitem dates (1995 .. 2001). The flag-form rollover
# runs on day 1 of a month (inside every grace window), the count form on day 3; the
# previous month's snapshot holds all earlier history.
ROLLOVER_AS_OF = dt.datetime(1998, 8, 1, 12, 0, 0)
SECOND_RUN_AS_OF = dt.datetime(1998, 8, 1, 16, 0, 0)
MERGE_AS_OF = dt.datetime(1998, 8, 3, 12, 0, 0)

TRENDS_COLUMNS = [
    """case when event_id % 50 = 0 then concat('rare ', cast(event_id div 100 as string))
            else concat(event_type, ' ', cast(user_id % 40 as string)) end as query""",
    "ts as start_date",
    """case when event_id % 4 = 0 then null
            else ts + make_dt_interval(0, cast(event_id % 37 as int)) end as end_date""",
    "event_id % 4 <= 1 as active",
    "(event_id * 7919 % 211) * 100 as search_volume",
    """cast(element_at(array(50,75,100,200,500,1000,2000,5000,10000,20000,50000),
                       cast(event_id % 11 as int) + 1) as bigint) as increase_percentage""",
    "case when event_id % 3 = 0 then concat(event_type, ', Other') else event_type end as categories",
    "concat(event_type, ', ', event_type, ' today') as trend_breakdown",
]

VIDEO_COLUMNS = [
    """concat(upper(element_at(array('click','error','view','purchase','signup'),
                               cast(l_suppkey % 5 as int) + 1)),
              ' ', cast(l_partkey % 40 as string)) as keyword""",
    "concat('v', cast(l_orderkey as string), '_', cast(l_linenumber as string)) as video_id",
    """date_format(l_shipdate, "yyyy-MM-dd'T'HH:mm:ss'Z'") as published_at""",
    "concat('PT', cast(l_linenumber - 1 as string), 'M', cast(l_suppkey % 60 as string), 'S') as duration",
    "cast((l_linenumber - 1) * 60 + l_suppkey % 60 as bigint) as duration_secs",
    """case when l_partkey % 17 = 0 then 0
            else cast(floor(l_extendedprice / element_at(array(1.0D,10.0D,40.0D,100.0D,1000.0D),
                                                         cast(l_partkey % 5 as int) + 1)) as bigint)
       end as view_count""",
    "cast(floor(l_quantity) as bigint) as like_count",
    "cast(l_linenumber as bigint) as comment_count",
    "'KE' as region_code",
]

# One part in nine has no category, so that lookups can miss.
CATEGORY_ID = "case when l_partkey % 9 = 0 then concat('none', cast(l_partkey as string)) else cast(l_partkey as string) end as category_id"

JOBS_COLUMNS = [
    "lang as title",
    "concat('co ', lang) as company_name",
    "concat('via ', lang) as via",
    "text as description",
    "cast(doc_id as string) as job_id",
    "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(doc_id as int)) as scraped_at",
]

POSTS_COLUMNS = [
    "concat('p', cast(o_orderkey as string)) as id",
    "o_orderpriority as subreddit",
    "o_orderkey % 500 as score",
    "o_custkey % 50 as num_comments",
    """case when o_orderkey % 10 = 0 then null
            else cast(o_orderkey % 100 as double) / cast(100 as double) end as upvote_ratio""",
    "o_orderkey % 3 as awards",
    "50000 + 1000 * (o_custkey % 7) as subscribers",
    "o_orderdate as created",
]


def trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").selectExpr(*TRENDS_COLUMNS)


def keyword_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").selectExpr(*VIDEO_COLUMNS)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").selectExpr(*JOBS_COLUMNS)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").selectExpr(*POSTS_COLUMNS)


def subreddits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subreddit dimension (name -> subscribers), one row per distinct order priority."""
    return (read_table(spark, sf_dir, "orders")
            .select(F.col("o_orderpriority").alias("subreddit")).distinct()
            .withColumn("subscribers",
                        F.lit(50000) + F.lit(1000) * F.substring("subreddit", 1, 1).cast("bigint")))


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country code -> name."""
    return read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("country_code"), F.col("n_name").alias("country_name"))


def customer_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a country code; one in ten has a code that no country has."""
    return read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "case when c_custkey % 10 = 0 then '99' else cast(c_nationkey as string) end as country_code")


def country_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country code -> region name (region -> countries mapping, inverted)."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("string").alias("country_code"),
                    F.col("r_name").alias("region")))


def video_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category id -> title from the part table."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("category_id"), F.col("p_type").alias("category_title"))


def country_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country code, category id) -> title, as each country names its categories; from the
    (supplier, part) pairs that occur."""
    pairs = read_table(spark, sf_dir, "lineitem").selectExpr("cast(l_suppkey % 30 as string) as country_code", "l_partkey").distinct()
    part = read_table(spark, sf_dir, "part")
    return pairs.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "country_code", F.col("p_partkey").cast("string").alias("category_id"),
        F.concat_ws(" / ", "p_type", "country_code").alias("category_title"))


# Duration texts covering every ISO-8601 part handled, plus calendar parts, signs and bad values.
DURATION_VARIANT = """
case l_linenumber
  when 1 then concat('PT', cast(l_suppkey % 60 as string), 'M', cast(l_partkey % 60 as string), 'S')
  when 2 then concat('PT', cast(l_suppkey % 5 as string), 'H', cast(l_partkey % 60 as string), 'M')
  when 3 then concat('P', cast(l_suppkey % 3 as string), 'DT', cast(l_partkey % 24 as string), 'H')
  when 4 then concat('PT', cast(l_partkey % 90 as string), '.', cast(l_suppkey % 10 as string), 'S')
  when 5 then concat('P', cast(l_suppkey % 2 + 1 as string), 'W')
  when 6 then case when l_partkey % 2 = 0 then 'n/a' else 'P1Y2M' end
  when 7 then element_at(array('P1M2DT3H', '-PT5M', 'P1DT', 'P', 'PT', '+PT1,5S'), cast(l_partkey % 6 as int) + 1)
end as duration"""


def duration_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").selectExpr(
        "concat('v', cast(l_orderkey as string), '_', cast(l_linenumber as string)) as video_id",
        DURATION_VARIANT)


def video_category_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").selectExpr(
        "concat('v', cast(l_orderkey as string), '_', cast(l_linenumber as string)) as video_id",
        CATEGORY_ID)
