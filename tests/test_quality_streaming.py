"""Quality checks on frames with NULLs and bad values; streaming state behaviour."""

import datetime as dt
import json

import pandas as pd
from pyspark.sql import types as T

from trendcast import schemas
from trendcast.plans import quality
from trendcast.session import shared_dir
from trendcast.sources import landing
from trendcast.sources.snapshots import SnapshotStore
from trendcast.streaming import ingest as si


def test_not_null_and_accepted_values(spark):
    df = spark.createDataFrame([("a", 50, "Viral"), (None, 51, "Hot"), (None, None, "Bogus")],
                               "query string, inc long, tier string")
    nn = {r.column: r.failures for r in quality.check_not_null(df, "m", ["query", "inc"]).collect()}
    av = {r.column: r.failures for r in quality.check_accepted(
        df, "m", {"inc": [50, 75], "tier": ["Viral", "Hot"]}).collect()}
    assert nn == {"query": 2, "inc": 1}
    assert av == {"inc": 1, "tier": 1}     # NULL is not counted as outside the domain


def _page(items):
    return json.dumps({"trending_searches": items})


def _item(q, start, end=None, active=True):
    it = {"query": q, "start_timestamp": str(start), "active": active, "search_volume": 100,
          "increase_percentage": 50, "categories": [{"id": 1, "name": "Sports"}], "trend_breakdown": ["x"]}
    if end is not None:
        it["end_timestamp"] = end
    return it


def _land(spark, path, pages):
    spark.createDataFrame([(p,) for p in pages], "value string").write.mode("append").text(path)


T0 = 1704067200  # 2024-01-01 00:00:00 UTC


def _stream(spark, name):
    schema = T.StructType([*schemas.TRENDS.fields, T.StructField(si.BATCH_COL, T.LongType())])
    target = SnapshotStore(spark, shared_dir(spark, f"t-target-{name}", fresh=True), schema, "start_date")
    return shared_dir(spark, "t-landing", fresh=True), shared_dir(spark, "t-ckpt", fresh=True), target


def _upsert(spark, land, ckpt, target, **more):
    si.stream_upsert(spark, land, schemas.TRENDS_PAYLOAD, "trending_searches", landing.flatten_trends, target,
                     ["query", "start_date"], ckpt, **more)


def test_stream_upsert_replaces_by_key(spark):
    land, ckpt, target = _stream(spark, "upsert")
    _land(spark, land, [_page([_item("a", T0), _item("b", T0 + 60)])])
    _upsert(spark, land, ckpt, target)
    _land(spark, land, [_page([_item("a", T0, end=T0 + 7200, active=False)])])
    _upsert(spark, land, ckpt, target)
    got = {r.query: (r.active, r.end_date) for r in target.load(si.TABLE).collect()}
    assert got == {"a": (False, dt.datetime(2024, 1, 1, 2, 0)), "b": (True, None)}


def test_stream_upsert_keeps_rows_without_a_day_and_rejects_bad_pages(spark):
    land, ckpt, target = _stream(spark, "bad")
    rejects = shared_dir(spark, "t-rejects", fresh=True)
    _land(spark, land, [_page([_item("a", "soon"), _item("b", T0)]), _page([_item("cut", T0)])[:40]])
    _upsert(spark, land, ckpt, target, rejects=rejects)
    bad = _page([_item("c", "later"), _item("d", T0)]).replace('"search_volume": 100', '"search_volume": "5K+"')
    _land(spark, land, [bad])
    _upsert(spark, land, ckpt, target, rejects=rejects)
    got = {r.query: (r.start_date, r.search_volume) for r in target.load(si.TABLE).collect()}
    day = dt.datetime(2024, 1, 1)
    assert got == {"a": (None, 100), "b": (day, 100), "c": (None, None), "d": (day, None)}
    assert sorted(r.lost for r in spark.read.parquet(rejects).collect()) == [False, True]


def test_stream_dedupe_drops_overlap_and_counts_late_rows(spark):
    land, ckpt, _ = _stream(spark, "dedupe")
    sink, day = shared_dir(spark, "t-sink", fresh=True), 86400
    run = lambda: si.stream_dedupe(spark, land, schemas.TRENDS_PAYLOAD, landing.flatten_trends,
                                   ["query", "start_date"], "start_date", "7 days", sink, ckpt)
    _land(spark, land, [_page([_item("a", T0), _item("b", T0 + 10 * day)])])
    assert run() == 0
    # The second capture repeats b (inside the delay) and a (behind the watermark), and brings a late new key.
    _land(spark, land, [_page([_item("a", T0), _item("b", T0 + 10 * day), _item("c", T0 + 11 * day), _item("late", T0 + day)])])
    assert run() == 2
    assert sorted(r.query for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def test_stream_newest_replaces_by_key_and_returns_late_rows(spark):
    land, ckpt, target = _stream(spark, "newest")
    late, day = shared_dir(spark, "t-late", fresh=True), 86400
    run = lambda **more: si.stream_newest(spark, land, schemas.TRENDS_PAYLOAD, landing.flatten_trends, ["query", "start_date"],
                                          "start_date", "captured_at", "7 days", target, late, ckpt, **{"ttl_ms": 10**9, **more})

    def page(at, *items):
        return json.dumps({"captured_at": at, "trending_searches": list(items)})

    def item(q, start, volume):
        return _item(q, start) | {"search_volume": volume}
    now = lambda: {(r["query"], r["start_date"]): r["search_volume"] for r in target.load(si.TABLE).collect()}
    t = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    # The older capture comes last in the first batch; a row without a time is never late.
    _land(spark, land, [page(200, item("a", T0, 2), item("b", T0 + 10 * day, 5), item("n", "never", 1)), page(100, item("a", T0, 1))])
    assert run() == 0
    assert now() == {("a", t(0)): 2, ("b", t(10)): 5, ("n", None): 1}
    wrote = target.entries(si.TABLE)
    # Captured before, captured anew, late ones (a known key, a new one), and one more without a time.
    _land(spark, land, [page(150, item("b", T0 + 10 * day, 4)), page(300, item("c", T0 + 11 * day, 7), item("a", T0, 9),
                                                                     item("late", T0 + day, 3), item("n", "never", 8))])
    assert run() == 2
    assert now() == {("a", t(0)): 2, ("b", t(10)): 5, ("c", t(11)): 7, ("n", None): 8}
    assert target.entries(si.TABLE)["2024_01_11"] == wrote["2024_01_11"]     # nothing new there: not rewritten
    assert sorted((r["query"], r["search_volume"]) for r in spark.read.parquet(late).collect()) == [("a", 9), ("late", 3)]
    # The last batch is run again, as after a failure.
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{ckpt}/commits/1")
    before = target._manifest()
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, False)
    assert run() == 2
    assert target._manifest() == before and spark.read.parquet(late).count() == 2
    assert run() == 0


def test_stream_newest_keeps_as_many_states_as_buckets(spark):
    land, ckpt, target = _stream(spark, "buckets")
    late, n = shared_dir(spark, "t-late", fresh=True), 3 * si.STATE_BUCKETS
    run = lambda: si.stream_newest(spark, land, schemas.TRENDS_PAYLOAD, landing.flatten_trends, ["query", "start_date"],
                                   "start_date", "captured_at", "7 days", target, late, ckpt, ttl_ms=10**9)
    page = lambda at, keys, volume: json.dumps({"captured_at": at, "trending_searches": [
        _item(f"q{i}", T0 + i) | {"search_volume": volume} for i in keys]})
    _land(spark, land, [page(200, range(n), 2), page(100, range(n), 1)])
    assert run() == 0
    _land(spark, land, [page(300, range(5), 3), page(150, range(5, n), 4)])
    assert run() == 0
    got = {r["query"]: r["search_volume"] for r in target.load(si.TABLE).collect()}
    assert got == {f"q{i}": 3 if i < 5 else 2 for i in range(n)}
    assert spark.read.format("statestore").load(ckpt).count() <= si.STATE_BUCKETS


def test_stream_newest_forgets_each_key_by_itself():
    """Keys of one bucket go when their own time is over; what they were captured at counts no more."""
    class State:
        kept, now, hasTimedOut = None, 0, False
        exists = property(lambda self: self.kept is not None)
        get = property(lambda self: self.kept)

        def update(self, value):
            self.kept = value

        def remove(self):
            self.kept = None

        def setTimeoutDuration(self, ms):
            self.until = self.now + ms

        getCurrentProcessingTimeMs = lambda self: self.now
        getCurrentWatermarkMs = lambda self: 1000

    state, update = State(), si._newest(100)

    def take(now, *rows):
        state.now = now
        parts = [pd.DataFrame([r], columns=["h", "g", "event_ms", "captured_ms", "row"]) for r in rows]
        return [tuple(r) for out in update((0,), iter(parts), state) for r in out.itertuples(index=False)]

    assert take(0, (1, 1, 2000, 50, "b"), (1, 1, 2000, 50, "a"), (2, 2, 2000, 7, "c")) == [("a", False), ("c", False)]
    assert take(60, (1, 1, 2000, 40, "older"), (1, 1, 0, 90, "behind")) == [("behind", True)]
    assert state.until == 100          # key 2 was met at 0
    state.hasTimedOut = True
    assert take(110) == [] and state.exists and state.until == 160
    state.hasTimedOut = False
    assert take(120, (2, 2, 2000, 1, "again"), (1, 1, 2000, 45, "older")) == [("again", False)]
    state.hasTimedOut = True
    assert take(400) == [] and not state.exists


def test_stream_pulse_equals_batch_pulse_over_overlapping_and_late_runs(spark):
    land, ckpt, target = _stream(spark, "pulse")
    pulse = SnapshotStore(spark, shared_dir(spark, "t-pulse", fresh=True), si.PULSE, "trend_date")
    hour, day = 3600, 86400
    runs = [[_item("a", T0 + 20 * hour), _item("b", T0 + 22 * hour), _item("c", T0 + 5 * day)],
            [_item("b", T0 + 22 * hour), _item("c", T0 + 5 * day, active=False), _item("d", T0 + 6 * day)],
            [_item("late", T0 - 20 * day), _item("a", T0 + 20 * hour, end=T0 + 30 * hour)]]
    for items in runs:
        _land(spark, land, [_page(items)])
        si.stream_category_pulse(spark, land, schemas.TRENDS_PAYLOAD, "trending_searches", landing.flatten_trends, target,
                                 pulse, ["query", "start_date"], ckpt)
    got = {r.trend_date: (r.total_keywords, r.total_search_volume) for r in pulse.load(si.TABLE).collect()}
    # 20:00 UTC is 23:00 on Jan 1 in Nairobi; 22:00 UTC is already Jan 2.
    assert got == {dt.date(2023, 12, 12): (1, 100), dt.date(2024, 1, 1): (1, 100), dt.date(2024, 1, 2): (1, 100),
                   dt.date(2024, 1, 6): (1, 100), dt.date(2024, 1, 7): (1, 100)}
    batch = si.category_days(target.load(si.TABLE))
    cols = si.PULSE.fieldNames()
    assert batch.select(*cols).exceptAll(pulse.load(si.TABLE).select(*cols)).count() == 0


def test_jobs_nested_parts_kept_as_json_or_null(spark):
    page = json.dumps({"jobs_results": [
        {"title": "a", "job_highlights": [{"title": "Q", "items": ["x"]}], "extensions": [],
         "detected_extensions": {}, "job_id": "1"},
        {"title": "b", "extensions": ["full time"], "detected_extensions": {"posted_at": "2 days"},
         "apply_options": None, "job_id": "2"},
        {"title": "c", "job_highlights": "", "extensions": "plain \"text\"", "detected_extensions": 0, "apply_options": False,
         "job_id": "3"},
    ]}).replace('"extensions": []', '"extensions": [ ]').replace('"detected_extensions": {}', '"detected_extensions": { }')
    pages = landing.parse_payloads(spark.createDataFrame([(page,)], "value string"), "value",
                                   schemas.JOBS_PAYLOAD)
    got = {r.job_id: r for r in landing.flatten_jobs(pages, dt.datetime(2024, 1, 1)).collect()}
    a, b = got["1"], got["2"]
    assert a.job_highlights == '[{"title":"Q","items":["x"]}]'
    assert (a.extensions, a.detected_extensions, a.apply_options) == (None, None, None)
    assert (b.extensions, b.detected_extensions) == ('["full time"]', '{"posted_at":"2 days"}')
    c = got["3"]
    assert (c.job_highlights, c.detected_extensions, c.apply_options) == (None, None, None)
    assert c.extensions == json.dumps('plain "text"')
    assert b.apply_options is None and b.scraped_at == dt.datetime(2024, 1, 1)


def test_kind_of_a_nested_part_comes_from_its_value(spark):
    """Strings that look like JSON are strings; numbers, booleans and empty parts are falsy by value; odd entries are seen."""
    values = ["5 days ago", "true story", "[draft] offer", "0", "null", "false", "{}", " [ ] ", "", 0, 0.0, -0.0, 1.5, 10**30, True, False,
              None, [], {}, [[]], {"b": {"z": 1, "a": [None]}}, "two\nlines \"q\"", "5"]
    page = json.dumps({"jobs_results": [{"job_id": str(i), "extensions": v} for i, v in enumerate(values)] + ["text", 7, None, []]})
    pages = landing.parse_payloads(spark.createDataFrame([(page,)], "value string"), "value", schemas.JOBS_PAYLOAD)
    got = {int(r.job_id): r.extensions for r in landing.flatten_jobs(pages, dt.datetime(2024, 1, 1)).collect()}
    assert len(got) == len(values)
    for i, v in enumerate(values):
        assert (None if got[i] is None else json.loads(got[i])) == (v if v else None), v
    assert got[3] == '"0"' and got[20] == '{"b":{"z":1,"a":[null]}}'
    assert landing.malformed_jobs(pages).count() == 4


def test_malformed_counts_can_be_seen(spark):
    page = json.dumps({"region_code": "KE", "items": [
        {"id": "v1", "statistics": {"viewCount": "12", "likeCount": "5K+"}}, {"id": "v2", "statistics": {"viewCount": "many"}}]})
    pages = landing.parse_payloads(spark.createDataFrame([(page,)], "value string"), "value", schemas.VIDEOS_PAYLOAD)
    got = sorted(map(tuple, landing.malformed_counts(pages).collect()))
    assert got == [("v1", "likeCount", "5K+"), ("v2", "viewCount", "many")]
