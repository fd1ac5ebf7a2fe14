"""Snapshot store and rollover scenarios: no table, empty month, leaked rows, both
``when_present`` behaviours, repeated runs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendcast.plans import loads
from trendcast.plans import rollover as ro
from trendcast.session import shared_dir
from trendcast.sources.snapshots import Batch, Conflict, SnapshotStore

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("v", T.LongType())])


def rows(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def store(spark):
    return SnapshotStore(spark, shared_dir(spark, "test-store", fresh=True), SCHEMA, "ts")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_missing_store_reads_empty(spark):
    s = store(spark)
    assert s.load("2024_jan").count() == 0 and s.months() == []


def test_rollover_carries_previous_month(spark):
    s = store(spark)
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
    batch = rows(spark, [("b", dt.datetime(2024, 2, 1, 1), 2)])
    assert ro.rollover(s, batch, dt.datetime(2024, 2, 1, 6), "ts", grace_days=2) == "rolled_over"
    assert ids(s.load("2024_feb")) == ["a", "b"]


def test_rollover_when_present_skip_and_append(spark):
    for mode, expected in (("skip", ["a", "b"]), ("append", ["a", "b", "c"])):
        s = store(spark)
        s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
        ro.rollover(s, rows(spark, [("b", dt.datetime(2024, 2, 1, 1), 2)]), dt.datetime(2024, 2, 1, 6), "ts", 2)
        ro.rollover(s, rows(spark, [("c", dt.datetime(2024, 2, 1, 7), 3)]), dt.datetime(2024, 2, 1, 10), "ts", 2,
                    when_present=mode)
        assert ids(s.load("2024_feb")) == expected


def test_rollover_outside_grace_appends_only(spark):
    s = store(spark)
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
    assert ro.rollover(s, rows(spark, [("b", dt.datetime(2024, 2, 9), 2)]), dt.datetime(2024, 2, 9), "ts", 2) == "appended"
    assert ids(s.load("2024_feb")) == ["b"]


def test_rollover_merge_skips_leaked_rows(spark):
    s = store(spark)
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1), ("b", dt.datetime(2024, 1, 6), 2)]), "2024_jan")
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1)]), "2024_feb")        # leaked earlier
    batch = rows(spark, [("c", dt.datetime(2024, 2, 2), 3)])
    assert ro.rollover_merge(s, batch, dt.datetime(2024, 2, 3), "ts", keys=["id", "ts"]) == "merged"
    assert ids(s.load("2024_feb")) == ["a", "b", "c"]
    # A second run on the same day finds the previous month merged.
    assert ro.rollover_merge(s, rows(spark, [("d", dt.datetime(2024, 2, 3), 4)]), dt.datetime(2024, 2, 3, 5),
                             "ts", keys=["id", "ts"]) == "appended"
    assert ids(s.load("2024_feb")) == ["a", "b", "c", "d"]


def test_compact_is_idempotent_and_keeps_other_months(spark):
    s = store(spark)
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1), ("a", dt.datetime(2024, 1, 5), 9)]), "2024_jan")
    s.append(rows(spark, [("z", dt.datetime(2023, 12, 5), 1), ("z", dt.datetime(2023, 12, 5), 1)]), "2023_dec")
    first = ro.compact(s, "2024_jan", ["id"], [F.col("v").desc()])
    assert [(r.id, r.v) for r in first.collect()] == [("a", 9)]
    again = ro.compact(s, "2024_jan", ["id"], [F.col("v").desc()])
    assert [(r.id, r.v) for r in again.collect()] == [("a", 9)]
    assert s.load("2023_dec").count() == 2


def test_expire_drops_old_months(spark):
    s = store(spark)
    for m, d in (("2024_jan", dt.datetime(2024, 1, 5)), ("2024_mar", dt.datetime(2024, 3, 5)),
                 ("2024_may", dt.datetime(2024, 5, 5))):
        s.append(rows(spark, [("a", d, 1)]), m)
    dropped = s.expire(dt.datetime(2024, 5, 10), 60)
    assert dropped == ["2024_jan"] and s.months() == ["2024_mar", "2024_may"]
    counts = {r.snapshot_month: r.row_count for r in s.row_counts().collect()}
    assert counts == {"2024_mar": 1, "2024_may": 1}


def test_empty_batch_is_a_no_op(spark):
    s = store(spark)
    assert ro.rollover(s, rows(spark, []), dt.datetime(2024, 2, 1), "ts", 2) == "no_data"
    assert ro.rollover_merge(s, rows(spark, []), dt.datetime(2024, 2, 1), "ts") == "no_data"
    assert s.months() == []


def test_refresh_writes_marts_from_one_staging_copy(spark, sf_dir):
    from trendcast.catalog import REGISTRY
    from trendcast.plans.refresh import refresh_marts
    from trendcast.sources import fixtures as fx

    out = shared_dir(spark, "refresh", fresh=True)
    paths = refresh_marts(spark, fx.trends(spark, sf_dir), fx.keyword_videos(spark, sf_dir), fx.AS_OF, out)
    for name in ("mart_category_pulse", "mart_keyword_recurrence", "mart_gap_analysis", "mart_trending_topics"):
        got = spark.read.parquet(paths[name])
        want = REGISTRY[name](spark, sf_dir)
        cols = sorted(want.columns)
        assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0, name
        assert got.count() == want.count(), name
    failures = {(r.model, r.column): r.failures for r in spark.read.parquet(paths["dq_not_null"]).collect()}
    assert failures and all(v == 0 for v in failures.values())


def test_replace_with_empty_removes_month(spark):
    s = store(spark)
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
    s.append(rows(spark, [("b", dt.datetime(2024, 2, 5), 1)]), "2024_feb")
    s.replace(rows(spark, []), "2024_jan")
    assert s.months() == ["2024_feb"] and s.load("2024_jan").count() == 0 and ids(s.load("2024_feb")) == ["b"]


def versions(s):
    return s._list(f"{s.base}/data", "_v=")


def test_rollover_and_compaction_write_each_row_once(spark):
    s = store(spark)
    s.append(rows(spark, [(f"a{i}", dt.datetime(2024, 1, 1 + i), i) for i in range(20)]), "2024_jan")
    ro.compact(s, "2024_jan", ["id"], ["v"])
    before = versions(s)
    batch = rows(spark, [("b", dt.datetime(2024, 2, 1, 1), 2), ("b", dt.datetime(2024, 2, 1, 1), 3)])
    assert ro.rollover(s, batch, dt.datetime(2024, 2, 1, 6), "ts", grace_days=2) == "rolled_over"
    assert len(versions(s)) == len(before) + 1          # history is carried by the manifest
    assert s.uncompacted_days("2024_feb") == ["2024_02_01"]
    ro.compact(s, "2024_feb", ["id"], ["v"])
    assert len(versions(s)) == len(before) + 2          # only the new day was rewritten
    assert s.load("2024_feb").count() == 21 and s.load("2024_jan").count() == 20
    assert [r.v for r in s.load("2024_feb").where("id = 'b'").collect()] == [3]


def test_a_failed_write_is_never_read_and_is_vacuumed(spark, monkeypatch):
    s = store(spark)
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
    monkeypatch.setattr(SnapshotStore, "_commit", lambda self, change: (_ for _ in ()).throw(OSError("lost")))
    for step in (lambda: s.append(rows(spark, [("b", dt.datetime(2024, 1, 6), 1)]), "2024_jan"),
                 lambda: s.replace(rows(spark, [("c", dt.datetime(2024, 1, 6), 1)]), "2024_jan")):
        with pytest.raises(OSError):
            step()
    monkeypatch.undo()
    assert ids(s.load("2024_jan")) == ["a"] and len(versions(s)) == 3
    assert len(s.vacuum()) == 2 and ids(s.load("2024_jan")) == ["a"]


def test_two_writers_do_not_overwrite_each_other(spark, monkeypatch):
    s = store(spark)
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
    seen = s._manifest_numbers()
    s.append(rows(spark, [("b", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
    monkeypatch.setattr(s, "_manifest_numbers", lambda: seen)   # a writer that has read the older state
    with pytest.raises(RuntimeError, match="another writer"):
        s.append(rows(spark, [("c", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
    monkeypatch.undo()
    assert ids(s.load("2024_jan")) == ["a", "b"]


def test_null_day_rows_survive_replacement(spark):
    s = store(spark)
    s.append(rows(spark, [("a", None, 1), ("b", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
    s.append(rows(spark, [("c", None, 2)]), "2024_jan")
    ro.compact(s, "2024_jan", ["id"], ["v"])
    assert ids(s.load("2024_jan")) == ["a", "b", "c"] and "none" in s.days("2024_jan")
    assert s.expire(dt.datetime(2026, 1, 1), 60) == ["2024_jan"]


def test_compact_needs_an_order(spark):
    with pytest.raises(ValueError):
        ro.compact(store(spark), "2024_jan", ["id"], [])


def test_merge_reads_only_days_that_leaked(spark):
    s = store(spark)
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1), ("b", dt.datetime(2024, 1, 6), 2), ("b2", dt.datetime(2024, 1, 5), 2)]), "2024_jan")
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1)]), "2024_feb")
    assert ro.rollover_merge(s, rows(spark, [("c", dt.datetime(2024, 2, 2), 3)]), dt.datetime(2024, 2, 3), "ts", keys=["id", "ts"]) == "merged"
    assert ids(s.load("2024_feb")) == ["a", "b", "b2", "c"]


# --- scheduled loads ---------------------------------------------------------------------


def _folders(spark, name):
    return [shared_dir(spark, f"load-{part}-{name}", fresh=True) for part in ("landing", "store", "ckpt")]


def test_cli_load_takes_each_file_once_then_refresh(spark, sf_dir):
    from trendcast.__main__ import main
    from trendcast.sources import fixtures as fx
    from trendcast.sources import landing_fixtures as lf

    land, base, ckpt = _folders(spark, "trends")
    args = ["load", "trends", "--landing", land, "--store", base, "--checkpoint", ckpt, "--as-of", "2024-01-31T00:00:00"]
    lf.trends_pages(spark, sf_dir).write.mode("append").json(land)
    got = main(args)
    assert got["actions"] == ["appended"] and got["month"] == "2024_jan"
    trends = loads.store_of(spark, "trends", base)
    first = versions(trends)
    assert main(args)["actions"] == ["no_data"] and versions(trends) == first
    lf.trends_pages(spark, sf_dir, captured_at=lf.SECOND_CAPTURE).write.mode("append").json(land)
    assert main(args)["actions"] == ["appended"]
    want = fx.trends(spark, sf_dir).count()
    now = trends.load("2024_jan")
    assert now.count() == want
    assert now.where("captured_at = timestamp_ntz'2024-01-31 04:00:00'").count() == want     # the newest capture won

    videos, out = shared_dir(spark, "cli-videos", fresh=True), shared_dir(spark, "cli-out", fresh=True)
    loads.store_of(spark, "keyword_videos", videos).append(fx.keyword_videos(spark, sf_dir).withColumn(
        "published_ts", F.lit(None).cast("timestamp_ntz")), "2024_jan")
    paths = main(["refresh", "--store", base, "--videos", videos, "--out", out, "--as-of", "2024-01-31T00:00:00"])
    assert spark.read.parquet(paths["stg_trending_now"]).count() == want
    assert spark.read.parquet(paths["mart_category_pulse"]).count() > 0


@pytest.mark.parametrize("dataset", ["jobs", "posts", "popular"])
def test_scheduled_loads_run_twice(spark, sf_dir, dataset):
    from trendcast.sources import fixtures as fx
    from trendcast.sources import landing_fixtures as lf

    as_of = dt.datetime(1998, 8, 20)
    land, base, ckpt = _folders(spark, dataset)
    pages = {"jobs": lf.jobs_pages, "posts": lf.posts_pages, "popular": lf.popular_pages}[dataset](spark, sf_dir)
    dims = {"subreddits": fx.subreddits(spark, sf_dir), "countries": fx.countries(spark, sf_dir),
            "regions": fx.country_regions(spark, sf_dir), "categories": fx.country_categories(spark, sf_dir)}
    spark.createDataFrame([("{\"jobs_results\": [{\"title\": \"cut",)], "value string").write.mode("append").text(land)
    pages.write.mode("append").json(land)
    if dataset in ("posts", "popular"):   # years of days: a coarser grain for the test
        pages = pages.limit(1)
    s = loads.store_of(spark, dataset, base)
    s.grain = "yyyy"
    run = lambda: loads.load(spark, dataset, land, base, ckpt, as_of, dims)
    real, loads.store_of = loads.store_of, lambda *a: s
    try:
        assert run()["actions"] == ["appended"]
        first = sorted(map(str, s.load("1998_aug").collect()))
        assert run()["actions"] == ["no_data"]
        pages.write.mode("append").json(land)
        assert run()["actions"] == ["appended"]
    finally:
        loads.store_of = real
    assert first and sorted(map(str, s.load("1998_aug").collect())) == first
    assert spark.read.parquet(f"{base}_rejects").where("lost").count() == 1


def test_keyword_video_load_runs_twice(spark, sf_dir):
    from trendcast.sources import fixtures as fx
    from trendcast.sources import landing_fixtures as lf

    land, base, ckpt = _folders(spark, "keyword_videos")
    details = shared_dir(spark, "load-details", fresh=True)
    lf.search_pages(spark, sf_dir).write.mode("append").json(land)
    lf.detail_pages(spark, sf_dir).where(f"captured_at = {lf.FIRST_CAPTURE}").write.mode("append").json(details)
    stores = []
    real = SnapshotStore.__init__

    def coarse(self, *a, **k):
        real(self, *a, **{**k, "grain": "yyyy"})
        stores.append(self)
    SnapshotStore.__init__ = coarse
    try:
        run = lambda: loads.load_keyword_videos(spark, land, details, base, ckpt, dt.datetime(1998, 8, 20),
                                                fx.video_categories(spark, sf_dir))
        assert run()["actions"] == ["appended"]
        s = loads.store_of(spark, "keyword_videos", base)
        n = s.load("1998_aug").count()
        assert n > 0 and run()["actions"] == ["no_data"]
        lf.detail_pages(spark, sf_dir).where(f"captured_at = {lf.SECOND_CAPTURE}").write.mode("append").json(details)
        lf.search_pages(spark, sf_dir).write.mode("append").json(land)
        assert run()["actions"] == ["appended"]
        now = s.load("1998_aug")
        assert now.count() >= n
        assert now.groupBy("keyword", "video_id").count().where("count > 1").count() == 0
        later = now.where("captured_at = timestamp_ntz'2024-01-31 04:00:00'")
        assert later.count() > 0 and later.where("view_count < 5000").count() == 0
    finally:
        SnapshotStore.__init__ = real


# --- races, replays, runs, the ledger, buckets, rules --------------------------------------


def test_an_interleaved_append_is_kept(spark, monkeypatch):
    """A writer that publishes between another one's reading and its commit loses nothing, nor does the other."""
    s = store(spark)
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
    real, calls = SnapshotStore._state, []

    def state(self):
        got = real(self)
        if not calls:
            calls.append(1)
            s.append(rows(spark, [(x, dt.datetime(2024, 1, 5), 1) for x in "xyz"]), "2024_jan")
        return got
    other = SnapshotStore(spark, s.base, SCHEMA, "ts")
    monkeypatch.setattr(other, "_state", state.__get__(other))
    other.append(rows(spark, [("b", dt.datetime(2024, 1, 5), 1)]), "2024_jan")
    assert ids(s.load("2024_jan")) == ["a", "b", "x", "y", "z"]


def test_a_replacement_keeps_later_rows_and_refuses_replaced_ones(spark):
    s = store(spark)
    day = "2024_01_05"
    s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1), ("a", dt.datetime(2024, 1, 5), 2)]), "2024_jan")
    seen = s.entries("2024_jan")
    kept = s.read(seen).where("v = 2")
    s.append(rows(spark, [("late", dt.datetime(2024, 1, 5), 3)]), "2024_jan")       # while the days are compacted
    s.replace_days(kept, "2024_jan", [day], compacted=True, seen=seen)
    assert ids(s.load("2024_jan")) == ["a", "late"] and s.uncompacted_days("2024_jan") == [day]
    with pytest.raises(Conflict):
        s.replace_days(kept, "2024_jan", [day], seen=seen)                          # computed from what is gone
    assert ids(s.load("2024_jan")) == ["a", "late"]


def test_manifest_numbers_are_taken_once(spark):
    s = store(spark)
    assert s._publish(1, "{}") and not s._publish(1, "{}") and s._manifest_numbers() == [1]


def history(spark, n=25):
    return rows(spark, [(f"h{i}", dt.datetime(2023, 8 + i % 5, 3 + i // 5), i) for i in range(n)])


def test_daily_merges_carry_history_once(spark):
    """25 rows over five months, three daily runs in the grace week: each adds its own row alone."""
    s = store(spark)
    s.append(history(spark), "2023_dec")
    s.append(rows(spark, [("h4", dt.datetime(2023, 12, 3), 4)]), "2024_jan")        # leaked earlier, of last month
    s.append(rows(spark, [("h0", dt.datetime(2023, 8, 3), 0)]), "2024_jan")         # and of an older one
    merge = lambda day, i: ro.rollover_merge(s, rows(spark, [(f"n{i}", dt.datetime(2024, 1, day), i)]), dt.datetime(2024, 1, day), "ts",
                                             keys=["id", "ts"])
    assert merge(1, 1) == "merged" and s.load("2024_jan").count() == 26
    before, wrote = s.entries("2024_jan"), versions(s)
    for day, n in ((2, 27), (3, 28)):
        assert merge(day, day) == "appended" and s.load("2024_jan").count() == n
    after = s.entries("2024_jan")
    assert len(versions(s)) == len(wrote) + 2
    assert {d: v for d, v in after.items() if d in before} == before                # old days keep their versions
    # The previous month is compacted, then gets a late row: only that day is compared, only that row comes over.
    ro.compact(s, "2023_dec", ["id"], ["v"])
    s.append(rows(spark, [("late", dt.datetime(2023, 9, 4), 1)]), "2023_dec")
    assert merge(4, 4) == "merged" and s.load("2024_jan").count() == 30
    assert sorted(s.load("2024_jan").groupBy("id").count().where("count > 1").collect()) == []


def test_vacuum_and_expiry_forget_the_ledger(spark):
    s = store(spark)
    s.append(history(spark), "2023_dec")
    ro.rollover_merge(s, rows(spark, [("n", dt.datetime(2024, 1, 1), 1)]), dt.datetime(2024, 1, 1), "ts", keys=["id", "ts"])
    assert s._manifest()["carried"]["2024_jan"]
    s.expire(dt.datetime(2024, 9, 1), 60)
    assert s._manifest()["carried"] == {} and s.months() == []


def _skip_load(spark, land, base, ckpt, **more):
    return loads.load(spark, "posts", land, base, ckpt, dt.datetime(2024, 2, 1, 6), {"subreddits": spark.createDataFrame(
        [("r", 5)], "subreddit string, subscribers bigint")}, when_present="skip", **more)


def _post(i, day):
    at = dt.datetime(2024, day // 100, day % 100, tzinfo=dt.timezone.utc).timestamp()
    return json.dumps({"genre": "g", "posts": [{"id": i, "subreddit": "r", "score": 1, "num_comments": 1, "upvote_ratio": 0.5, "created": at}]})


def _files(spark, land, pages):
    for p in pages:
        spark.createDataFrame([(p,)], "value string").coalesce(1).write.mode("append").text(land)


def test_a_skip_load_in_three_batches_keeps_all_or_nothing(spark):
    land, base, ckpt = _folders(spark, "skip")
    s = loads.store_of(spark, "posts", base)
    _files(spark, land, [_post(f"p{i}", 201) for i in range(3)])
    got = _skip_load(spark, land, base, ckpt, max_bytes=1)
    assert got["actions"] == ["rolled_over", "appended", "appended"]                # one run, one decision
    assert ids(s.load("2024_feb")) == ["p0", "p1", "p2"]
    _files(spark, land, [_post(f"q{i}", 201) for i in range(3)])
    assert _skip_load(spark, land, base, ckpt, max_bytes=1)["actions"] == ["skipped"] * 3
    assert ids(s.load("2024_feb")) == ["p0", "p1", "p2"]


def test_a_run_that_fails_half_way_goes_on_as_it_began(spark, monkeypatch):
    """The second batch is lost after its rows were published: it is run again, changes nothing, and the third follows."""
    land, base, ckpt = _folders(spark, "half")
    _files(spark, land, [_post(f"p{i}", 201) for i in range(3)] + [_post("cut", 201)[:60]])
    real, n = loads.compacted, []

    def fails(*a):
        n.append(1)
        if len(n) == 2:
            raise OSError("lost")
        return real(*a)
    monkeypatch.setattr(loads, "compacted", fails)
    with pytest.raises(Exception, match="lost"):
        _skip_load(spark, land, base, ckpt, max_bytes=1)
    got = _skip_load(spark, land, base, ckpt, max_bytes=1)
    assert got["actions"][0] == "replayed" and set(got["actions"][1:]) == {"appended"}
    s = loads.store_of(spark, "posts", base)
    assert ids(s.load("2024_feb")) == ["p0", "p1", "p2"]
    assert spark.read.parquet(f"{base}_rejects").count() == 1
    assert s._manifest()["writers"] and all(w["run"] is None for w in s._manifest()["writers"].values())


def test_a_batch_that_runs_again_changes_nothing(spark):
    s = store(spark)
    by = Batch("w", 0)
    for _ in range(2):
        s.append(rows(spark, [("a", dt.datetime(2024, 1, 5), 1)]), "2024_jan", by=by)
        s.replace_days(rows(spark, [("b", dt.datetime(2024, 1, 6), 1)]), "2024_jan", ["2024_01_06"], by=Batch("other", 3))
    assert ids(s.load("2024_jan")) == ["a", "b"] and len(versions(s)) == 2
    assert ro.rollover(s, rows(spark, [("c", dt.datetime(2024, 1, 7), 1)]), dt.datetime(2024, 1, 9), "ts", 2, by=by) == "replayed"
    assert not s.applied(Batch("w", 1)) and not s.applied(Batch("new", 0))


def test_untouched_buckets_are_neither_read_nor_written(spark):
    s = SnapshotStore(spark, shared_dir(spark, "test-buckets", fresh=True), SCHEMA, buckets=(["id"], 16))
    s.append(rows(spark, [(f"k{i}", None, i) for i in range(200)]), "2024_jan")
    ro.compact(s, "2024_jan", ["id"], ["v"])
    before = s.entries("2024_jan")
    assert len(before) == 16
    s.append(rows(spark, [("k7", None, 1000), ("new", None, 1)]), "2024_jan")
    touched = s.uncompacted_days("2024_jan")
    assert len(touched) in (1, 2)
    seen = s.read(s.entries("2024_jan", touched)).inputFiles()
    assert all(any(f"_day={b}/" in f for b in touched) for f in seen)
    out = ro.compact(s, "2024_jan", ["id"], ["v"])
    assert {d: v for d, v in s.entries("2024_jan").items() if d not in touched} == {d: v for d, v in before.items() if d not in touched}
    got = {r.id: r.v for r in out.collect()}
    assert len(got) == 201 == out.count() and got["k7"] == 1000
    # The number of buckets is the store's, whatever a later program says.
    again = SnapshotStore(spark, s.base, SCHEMA, buckets=(["id"], 64))
    again.append(rows(spark, [("k7", None, 2000)]), "2024_jan")
    assert again.buckets[1] == 16 and {r.id: r.v for r in ro.compact(again, "2024_jan", ["id"], ["v"]).collect()}["k7"] == 2000


def test_rows_that_break_a_rule_are_not_published(spark):
    land, base, ckpt = _folders(spark, "rules")
    _files(spark, land, [_post("p", 201)])
    assert _skip_load(spark, land, base, ckpt, required=["id", "created"])["actions"] == ["rolled_over"]
    s = loads.store_of(spark, "posts", base)
    before = s._manifest()
    _files(spark, land, [_post(None, 201)])
    with pytest.raises(Exception, match="not_null:id"):
        loads.load(spark, "posts", land, base, ckpt, dt.datetime(2024, 2, 9), {"subreddits": spark.createDataFrame(
            [("r", 5)], "subreddit string, subscribers bigint")}, required=["id", "created"])
    assert s._manifest() == before and ids(s.load("2024_feb")) == ["p"]
    reports = {r["action"]: r for r in loads.load_reports(spark, base).collect()}
    assert "not_null:id (1)" in reports["refused"]["broken_rules"] and reports["rolled_over"]["rows"] == 1
    # Without the rule the same files are taken by the next run.
    assert _skip_load(spark, land, base, ckpt)["actions"] == ["skipped"]
