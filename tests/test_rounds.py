"""Large inputs are worked on in rounds, and shuffle files go with the write they were for."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendcast import schemas, session
from trendcast.plans import gap_chain, staging
from trendcast.plans import rollover as ro
from trendcast.session import shared_dir
from trendcast.sources import fixtures as fx
from trendcast.sources import landing
from trendcast.sources import landing_fixtures as lf
from trendcast.sources.snapshots import RulesBroken, SnapshotStore, not_null


def _pages(spark, sf_dir):
    search = landing.read_landing(spark, lf.land(lf.search_pages(spark, sf_dir), "t-search"), schemas.SEARCH_PAYLOAD)
    odd = spark.createDataFrame([("KE", None, None), ("KE", 1, None), ("KE", 2, "x"), ("KE", 2, "w")], "region_code string, captured_at long, title string")
    odd = odd.select("region_code", "captured_at", F.array(F.struct(
        F.when(F.col("title").isNotNull(), F.lit("twice")).alias("id"),
        F.struct("title").alias("snippet"), F.struct(F.lit("7").alias("viewCount")).alias("statistics"),
        F.struct(F.lit("PT2M").alias("duration")).alias("contentDetails"))).alias("items"))
    path = lf.land(lf.detail_pages(spark, sf_dir), "t-details")
    odd.write.mode("append").option("compression", lf.PAGES_CODEC).json(path)
    hit = spark.createDataFrame([("K", "twice"), ("K", "twice"), ("k", "twice"), (None, "twice"), ("K", "unknown"), ("K", None)], "keyword string, id string")
    hit = hit.select("keyword", F.array(F.struct(F.struct(F.lit("youtube#video").alias("kind"), F.col("id").alias("videoId")).alias("id"))).alias("items"))
    return search.select("keyword", "items").unionByName(hit), landing.read_landing(spark, path, schemas.DETAILS_PAYLOAD)


def test_rounds_give_the_same_keyword_videos(spark, sf_dir, monkeypatch):
    search, details = _pages(spark, sf_dir)
    categories = fx.video_categories(spark, sf_dir)
    whole = landing.flatten_keyword_videos(search, details, categories)
    monkeypatch.setattr(session, "ROUND_BYTES", 1)
    monkeypatch.setattr(session, "MOST_ROUNDS", 3)
    assert session.rounds_for(session.file_bytes(details)) == 3
    got = landing.flatten_keyword_videos(search, details, categories)
    assert got.schema.simpleString() == whole.schema.simpleString()
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(got) == rows(whole)
    assert {(r.keyword, r.title) for r in got.where("video_id = 'twice'").collect()} == {("K", "w"), ("k", "w"), (None, "w")}
    files = got.inputFiles()
    assert files and all("/scratch/" in f for f in files)
    # What was dealt to the rounds is gone, the result stays until it is released.
    left = landing.keyword_video_rounds(search, details, categories, n=3)
    next(left)
    scratch = lambda name: spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark, "scratch", spark.sparkContext.applicationId, name))
    fs = scratch("details").getFileSystem(spark._jsc.hadoopConfiguration())
    assert len(fs.listStatus(scratch("details"))) == 1
    left.close()
    assert len(fs.listStatus(scratch("details"))) == len(fs.listStatus(scratch("hits"))) == 0
    session.release_scratch(spark)
    assert not fs.exists(scratch("keyword_videos"))


def test_rows_without_files_take_one_round(spark):
    assert session.rounds_for(session.file_bytes(spark.range(10))) == 1


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_landing_leaves_no_shuffle_files(spark, sf_dir):
    pages, before = lf.detail_pages(spark, sf_dir), _shuffle_files(spark)
    lf.land(pages, "t-freed")
    for _ in range(50):           # they are deleted in the background
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get(session._FREED) == "false"


SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.LongType())])


def _store(spark) -> SnapshotStore:
    return SnapshotStore(spark, shared_dir(spark, "t-rounds", fresh=True), SCHEMA, "ts")


def _day(i: int) -> dt.datetime | None:
    return dt.datetime(2024, 1, 1 + i) if i >= 0 else None


def test_a_compaction_in_rounds_keeps_the_same_rows(spark, monkeypatch):
    """Keys that lie in several days included; the days count as compacted, and what is removed is counted."""
    rows = [(f"k{i % 40}" if i % 41 else None, _day(i % 4 - 1), i) for i in range(400)]
    kept, removed = [], []
    for round_bytes, most in ((session.ROUND_BYTES, 1), (1, 3), (1, 16)):
        monkeypatch.setattr(session, "ROUND_BYTES", round_bytes)
        monkeypatch.setattr(session, "MOST_ROUNDS", most)
        store = _store(spark)
        for half in (rows[::2], rows[1::2]):
            store.append(spark.createDataFrame(half, SCHEMA), "2024_jan")
        assert store.rounds(store.entries("2024_jan")) == most
        removed.append(ro.compacted(store, "2024_jan", ["id"], ["v"]))
        kept.append(sorted(map(repr, store.load("2024_jan").collect())))
        assert store.uncompacted_days("2024_jan") == []
        assert ro.compacted(store, "2024_jan", ["id"], ["v"]) == 0
        assert {len(v) for v in store.entries("2024_jan").values()} == {1}
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 41
    assert removed == [359, 359, 359]


def test_parts_are_published_together(spark):
    store, seen = _store(spark), []

    def parts(*groups):
        for group in groups:
            seen.append(store.load("2024_jan").count())
            yield spark.createDataFrame(group, SCHEMA)

    one, two = [("a", _day(0), 1)], [("b", _day(0), 2), ("c", _day(1), 3)]
    assert store.append(parts(one, [], two), "2024_jan") == 3
    assert seen == [0, 0, 0]
    assert {d: len(v) for d, v in store.entries("2024_jan").items()} == {"2024_01_01": 1, "2024_01_02": 1}
    assert sorted(r.id for r in store.load("2024_jan").collect()) == ["a", "b", "c"]
    with pytest.raises(RulesBroken) as broken:
        store.append(parts([("d", None, 4)], [("e", None, 5)]), "2024_jan", rules=not_null(["ts"]))
    assert broken.value.counts == {"not_null:ts": 2} and store.load("2024_jan").count() == 3
    # The previous month's missing rows come over beside the parts, once.
    store.append(spark.createDataFrame([("a", _day(0), 1), ("z", _day(0), 9), ("y", _day(3), 8)], SCHEMA), "2023_dec")
    merge = lambda *groups: ro.rollover_merge(store, parts(*groups), dt.datetime(2024, 1, 3), "ts", keys=["id", "ts"], guard_empty=False)
    assert merge([("f", _day(0), 6)], [("g", _day(2), 7)]) == "merged"
    assert merge([("h", _day(2), 7)]) == "appended"
    assert sorted(r.id for r in store.load("2024_jan").collect()) == ["a", "b", "c", "f", "g", "h", "y", "z"]


def test_the_gap_chain_in_rounds_gives_the_same_marts(spark, sf_dir, monkeypatch):
    search, details = _pages(spark, sf_dir)
    result = []
    for round_bytes in (session.ROUND_BYTES, 1):
        monkeypatch.setattr(session, "ROUND_BYTES", round_bytes)
        monkeypatch.setattr(session, "MOST_ROUNDS", 2)
        store = SnapshotStore(spark, shared_dir(spark, "t-gap", fresh=True), schemas.KEYWORD_VIDEOS, "published_ts", "yyyy")
        trends = fx.trends(spark, sf_dir)
        mart = gap_chain.keyword_gap(staging.stg_trending_now(trends, fx.AS_OF), search, details, fx.video_categories(spark, sf_dir),
                                     trends, store, fx.AS_OF)
        result.append(sorted(map(repr, mart.collect())) + sorted(map(repr, store.load("2024_jan").collect())))
    assert result[0] == result[1] and len(result[0]) > 100


def test_a_store_leaves_no_shuffle_files(spark):
    rows = spark.range(1000).selectExpr("cast(id as string) as id", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 3 as int)) as ts", "id as v")
    store, before = _store(spark), _shuffle_files(spark)
    store.append(rows, "2024_jan")
    ro.compact(store, "2024_jan", ["id"], ["v"])
    for _ in range(50):
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert all(f.endswith(".zstd.parquet") for f in store.load("2024_jan").inputFiles())
