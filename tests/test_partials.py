"""Marts from stored partials: which days a refresh touches, equality with a full rebuild, sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendcast import schemas
from trendcast.plans import marts
from trendcast.plans import partials as pt
from trendcast.plans.staging import stg_trending_now
from trendcast.session import shared_dir
from trendcast.sources.snapshots import SnapshotStore
from trendcast.streaming.ingest import TABLE

AS_OF = dt.datetime(2024, 1, 20)


def trend(query, day, volume=100, end=True, hour=3):
    at = None if day is None else dt.datetime(2024, 1, day, hour)
    return (query, at, at + dt.timedelta(hours=2) if at and end else None, not end, volume, 50, "Sports", "x", dt.datetime(2024, 1, 20))


def frames(spark, rows):
    return spark.createDataFrame(rows, schemas.TRENDS)


@pytest.fixture
def stores(spark):
    def make(day):
        source = SnapshotStore(spark, shared_dir(spark, "t-partial-source", fresh=True), schemas.TRENDS, "start_date")
        rows = stg_trending_now(frames(spark, []), AS_OF)
        return source, pt.partial_store(spark, shared_dir(spark, "t-partials", fresh=True), day, rows, "trend_date")
    return make


def same(a, b):
    cols = sorted(b.columns)
    key = lambda df: sorted(map(str, df.select(*cols).collect()))
    return sorted(a.columns) == cols and key(a) == key(b)


@pytest.mark.parametrize("kind", ["pulse", "recurrence"])
def test_a_refresh_touches_changed_and_open_days_only(spark, stores, kind):
    day = {"pulse": pt.pulse_day, "recurrence": pt.recurrence_day}[kind]
    source, partials = stores(day)

    def mart(as_of):
        whole = stg_trending_now(source.load("2024_jan"), as_of)
        rows = partials.load(TABLE)
        if kind == "pulse":
            return pt.mart_category_pulse(rows), marts.mart_category_pulse(whole)
        return pt.mart_keyword_recurrence(rows, as_of), marts.mart_keyword_recurrence(whole, as_of)

    source.append(frames(spark, [trend(f"q{d % 4}", d, 10 * d) for d in range(1, 16)] + [trend("open", 5, end=False), trend("none", None)]), "2024_jan")
    assert len(pt.refresh_trend_partials(source, "2024_jan", partials, day, AS_OF)) > 15
    assert same(*mart(AS_OF))
    first = partials.entries(TABLE)

    source.append(frames(spark, [trend("new", 12, 7, hour=23)]), "2024_jan")      # local time: already the 13th
    later = AS_OF + dt.timedelta(days=1)
    touched = pt.refresh_trend_partials(source, "2024_jan", partials, day, later)
    assert set(touched) == {"2024_01_05", "2024_01_11", "2024_01_12", "2024_01_13", "none"}
    now = partials.entries(TABLE)
    assert {d: v for d, v in now.items() if d not in touched} == {d: v for d, v in first.items() if d not in touched}
    assert same(*mart(later))

    # Nothing new: only the days of open trends are looked at again.
    assert set(pt.refresh_trend_partials(source, "2024_jan", partials, day, later)) == {"2024_01_05", "none"}
    # A day is emptied.
    source.replace_days(frames(spark, []), "2024_jan", ["2024_01_09"])
    pt.refresh_trend_partials(source, "2024_jan", partials, day, later)
    assert same(*mart(later))


def test_a_refresh_reads_the_days_around_the_changed_ones(spark, stores, monkeypatch):
    source, partials = stores(pt.pulse_day)
    source.append(frames(spark, [trend("a", d) for d in range(1, 20)]), "2024_jan")
    pt.refresh_trend_partials(source, "2024_jan", partials, pt.pulse_day, AS_OF)
    source.append(frames(spark, [trend("b", 10)]), "2024_jan")
    read = []
    real = SnapshotStore.load_days
    monkeypatch.setattr(SnapshotStore, "load_days", lambda self, m, d: read.extend(d) or real(self, m, d))
    pt.refresh_trend_partials(source, "2024_jan", partials, pt.pulse_day, AS_OF)
    assert set(read) == {f"2024_01_{d:02d}" for d in range(8, 13)}


def test_medians_of_merged_sketches(spark):
    """Equal to the exact median in small groups, within a hundredth of the ranks in a large one."""
    n = 200_000
    videos = spark.range(n + 12).select(
        F.when(F.col("id") < n, "large").otherwise("small").alias("keyword"), F.concat(F.lit("v"), "id").alias("video_id"),
        F.lit(600).cast("bigint").alias("duration_secs"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) + 1).alias("view_count"),
        F.lit(1).cast("bigint").alias("like_count"), F.lit(0).cast("bigint").alias("comment_count"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 60 as int))").alias("published_ts"))
    supply = pt.supply_day(videos)
    got = {r["keyword"]: r["m"] for r in supply.groupBy("keyword").agg(
        F.expr("kll_sketch_get_quantile_bigint(kll_merge_agg_bigint(views), 0.5D)").alias("m")).collect()}
    small = sorted(r["view_count"] for r in videos.where("keyword = 'small'").collect())
    assert got["small"] == small[5]
    rank = videos.where((F.col("keyword") == "large") & (F.col("view_count") <= got["large"])).count() / n
    assert abs(rank - 0.5) < 0.01


def test_merged_states_count_null_and_find_heavy_values_beyond_capacity(spark):
    rows = [("a", d, h) for d in range(5) for h in (1, 2, None, None)] + [("b", 1, 7), ("b", 2, 3), ("c", 1, None)]
    df = spark.createDataFrame([(g, dt.date(2024, 1, 1 + d), h) for g, d, h in rows], "categories string, trend_date date, start_hour_eat int")
    got = {r["categories"]: (r["top_hour"], r["trends"]) for r in pt.top_hours(pt.hours_day(df)).collect()}
    assert got == {"a": (None, 10), "b": (3, 1), "c": (None, 1)}        # ties: the lowest value
    many = spark.range(60_000).select(F.lit("x").alias("categories"), F.lit(dt.date(2024, 1, 1)).alias("trend_date"),
                                      F.when(F.col("id") % 5 == 0, -1).otherwise(F.col("id")).cast("int").alias("start_hour_eat"))
    assert pt.top_hours(pt.hours_day(many)).first()["top_hour"] == -1


def test_command_line_refresh_from_partials(spark):
    """Two runs of the scheduled refresh: the marts equal the full rebuild, the second reads the new day's surroundings."""
    from trendcast.__main__ import main
    from trendcast.plans import loads

    base, videos, parts, out, full = (shared_dir(spark, f"t-refresh-{n}", fresh=True) for n in ("s", "v", "p", "o", "f"))
    trends, kw = loads.store_of(spark, "trends", base), loads.store_of(spark, "keyword_videos", videos)
    video = lambda k, i, day, views: (k, f"v{i}", "t", "c", "n", "2024-01-01T00:00:00Z", "PT5M", 300, None, views, 1, 1, "KE",
                                      dt.datetime(2024, 1, day), None)
    trends.append(frames(spark, [trend(f"Q{d % 3}", d, 100 * d) for d in range(1, 16)]), "2024_jan")
    kw.append(spark.createDataFrame([video("q1", i, 1 + i % 9, 10 * i + 1) for i in range(31)], schemas.KEYWORD_VIDEOS), "2024_jan")
    args = ["--store", base, "--videos", videos, "--as-of", "2024-01-20T00:00:00"]
    first = main(["refresh", *args, "--out", out, "--partials", parts])
    assert len(first["pulse_day"]) >= 15 and len(first["supply_day"]) == 9
    trends.append(frames(spark, [trend("q1", 3, 9000), trend("q2", 3, 1)]), "2024_jan")
    kw.append(spark.createDataFrame([video("q2", 99, 4, 77)], schemas.KEYWORD_VIDEOS), "2024_jan")
    assert main(["refresh", *args, "--out", out, "--partials", parts]) == {
        "pulse_day": ["2024_01_02", "2024_01_03", "2024_01_04"], "recurrence_day": ["2024_01_02", "2024_01_03", "2024_01_04"],
        "supply_day": ["2024_01_04"]}
    main(["refresh", *args, "--out", full])
    for mart in ("mart_category_pulse", "mart_keyword_recurrence", "mart_gap_analysis"):
        got, want = (spark.read.parquet(f"{folder}/{mart}") for folder in (out, full))
        assert same(got, want) and want.count() > 1, mart
