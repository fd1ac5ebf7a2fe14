"""Boundary and NULL behaviour of the column functions, on small literal frames."""

import datetime as dt

import pytest

from trendcast import constants as K
from trendcast import functions as fn
from trendcast.operators import arg_max_per_group


def one(spark, schema, rows, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


@pytest.mark.parametrize("dur,active,expected", [
    (2, True, 1000 * 0.5 + 100 * 8 + 4000 + 3000 + 1500),
    (3, True, 500 + 800 + 4000 + 3000 + 1500),
    (6, False, 500 + 800 + 3000 + 1500),
    (7, False, 500 + 800 + 1500),
    (12, True, 500 + 800 + 4000 + 1500),
    (13, True, 500 + 800 + 4000),
    (1, True, 500 + 800 + 4000 + 3000),
    (24, None, 500 + 800),
])
def test_recommendation_score(spark, dur, active, expected):
    got = one(spark, "sv long, inc long, active boolean, dur long", [(1000, 100, active, dur)],
              fn.recommendation_score("sv", "inc", "active", "dur"))
    assert got == [expected]


def test_recommendation_score_null_volume(spark):
    got = one(spark, "sv long, inc long, active boolean, dur long", [(None, 100, True, 1)],
              fn.recommendation_score("sv", "inc", "active", "dur"))
    assert got == [None]


@pytest.mark.parametrize("dur,active,label", [
    (3, True, "Act Now — Just Started"),
    (4, True, "Still Hot — Publish Today"),
    (12, True, "Still Hot — Publish Today"),
    (24, True, "Fading — Quick Content Only"),
    (25, True, "Long Tail — Deep Content OK"),
    (None, True, "Long Tail — Deep Content OK"),
    (1, False, "Ended — Historical Reference"),
    (1, None, "Ended — Historical Reference"),
])
def test_content_window(spark, dur, active, label):
    assert one(spark, "active boolean, dur long", [(active, dur)], fn.content_window("active", "dur")) == [label]


@pytest.mark.parametrize("sv,active,label", [
    (10000, True, "Viral"), (9999, True, "Hot"), (2000, True, "Hot"), (1999, True, "Rising"),
    (500, True, "Rising"), (499, True, "Active"), (None, True, "Active"), (50000, False, "Ended"),
])
def test_urgency_tier(spark, sv, active, label):
    assert one(spark, "sv long, active boolean", [(sv, active)], fn.urgency_tier("sv", "active")) == [label]


@pytest.mark.parametrize("hour,label", [
    (4, "Night"), (5, "Morning"), (11, "Morning"), (12, "Afternoon"), (16, "Afternoon"),
    (17, "Evening"), (20, "Evening"), (21, "Night"), (0, "Night"), (None, "Night"),
])
def test_time_of_day(spark, hour, label):
    assert one(spark, "h long", [(hour,)], fn.time_of_day("h")) == [label]


@pytest.mark.parametrize("times,span,label", [
    (10, 30, "Series Material — Trends Regularly"),
    (10, 29, "Recurring — Worth Scheduling"),
    (5, 100, "Recurring — Worth Scheduling"),
    (4, 100, "Appeared Twice — Keep Watching"),
    (2, 0, "Appeared Twice — Keep Watching"),
    (1, 0, "One-Off — Reactive Content Only"),
])
def test_recurrence_label(spark, times, span, label):
    assert one(spark, "t long, s long", [(times, span)], fn.recurrence_label("t", "s")) == [label]


def test_scheduling_tip_propagates_null(spark):
    got = one(spark, "t string, d string", [("Morning", "Friday"), (None, "Friday")],
              fn.scheduling_tip("t", "d"))
    assert got == ["Best time: Morning on Friday", None]


@pytest.mark.parametrize("sv,median,score,label", [
    (5100, 99, 51.0, "Strong Gap"),
    (5000, 99, 50.0, "Good Opportunity"),
    (1100, 99, 11.0, "Good Opportunity"),
    (1000, 99, 10.0, "Competitive"),
    (101, 99, 1.01, "Competitive"),
    (100, 99, 1.0, "Saturated"),
    (None, 99, None, "Saturated"),
])
def test_gap_score_and_opportunity(spark, sv, median, score, label):
    df = spark.createDataFrame([(sv, median)], "sv long, m long")
    row = df.select(fn.gap_score("sv", "m").alias("g"), fn.opportunity(fn.gap_score("sv", "m")).alias("o")).first()
    assert (row.g, row.o) == (score, label)


def test_engagement(spark):
    df = spark.createDataFrame([(10, 5, 50000, None, None), (10, 5, 0, 0.5, 2)],
                               "score long, c long, subs long, ratio double, awards long")
    rows = df.select(fn.engagement_rate("score", "c", "subs").alias("r"),
                     fn.engagement_intensity("score", "ratio", "c", "awards").alias("i")).collect()
    assert rows[0].r == pytest.approx(15 / 50.0) and rows[0].i == 15.0
    assert rows[1].r is None and rows[1].i == 10 * 0.5 + 5 + 2


@pytest.mark.parametrize("text,secs", [
    ("PT1M30S", 90), ("PT15S", 15), ("PT1H", 3600), ("PT1H2M3S", 3723), ("P1DT2H", 93600),
    ("P2W", 1209600), ("PT1.9S", 1), ("PT0,5M", 30), ("P1Y2M", 0), ("P", 0), ("PT", 0),
    ("garbage", 0), ("", 0), (None, 0), ("P1D", 86400),
])
def test_iso_duration_secs(spark, text, secs):
    assert one(spark, "d string", [(text,)], fn.iso_duration_secs("d")) == [secs]


@pytest.mark.parametrize("day,week", [
    (dt.date(2024, 1, 1), "01"),   # Monday
    (dt.date(2023, 1, 1), "00"),   # Sunday before the first Monday
    (dt.date(2023, 1, 2), "01"),
    (dt.date(2022, 12, 31), "52"),
    (dt.date(2024, 12, 31), "53"),
    (dt.date(2018, 1, 1), "01"),
    (dt.date(2021, 1, 3), "00"),
])
def test_monday_week(spark, day, week):
    assert one(spark, "d date", [(day,)], fn.monday_week("d")) == [week]


def test_monday_week_matches_strftime_over_years(spark):
    days = spark.sql("select explode(sequence(date'2019-01-01', date'2030-12-31')) as d")
    got = {r.d: r.w for r in days.select("d", fn.monday_week("d").alias("w")).collect()}
    assert all(got[d] == d.strftime("%W") for d in got)


def test_local_parts_nairobi(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 21, 30),)], "start_date timestamp_ntz")
    r = fn.local_parts(df, "start_date").first()
    assert r.trend_date == dt.date(2024, 1, 2) and r.start_hour_eat == 0
    assert (r.day_of_week, r.month_name, r.week_number) == ("Tuesday", "January", "01")


def test_duration_hours_truncates_and_defaults(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 2, 59, 59)),
                                (dt.datetime(2024, 1, 1, 0, 0), None)],
                               "s timestamp_ntz, e timestamp_ntz")
    got = [r[0] for r in df.select(fn.duration_hours("s", "e", dt.datetime(2024, 1, 2, 0, 30))).collect()]
    assert got == [2, 24]


def test_from_epoch(spark):
    got = one(spark, "x string", [("1704067200",), ("",), ("0",), (None,), ("abc",)], fn.from_epoch("x", falsy_null=True))
    assert got == [dt.datetime(2024, 1, 1), None, None, None, None]


def test_parse_iso_ts_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(spark, "s string",
                  [("2024-03-10T02:30:00Z",), ("2024-01-02T03:04:05+03:00",), ("2024-01-02 03:04:05",),
                   ("bad",), (None,)], fn.parse_iso_ts("s"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 1, 2, 0, 4, 5),
                   dt.datetime(2024, 1, 2, 3, 4, 5), None, None]


def test_month_suffix(spark):
    assert one(spark, "t timestamp_ntz", [(dt.datetime(2026, 5, 3),)], fn.month_suffix("t")) == ["2026_may"]
    assert fn.month_tag(dt.datetime(2026, 5, 3)) == "2026_may"


def test_json_and_names(spark):
    df = spark.createDataFrame([([{"id": 1, "name": "Sports"}, {"id": 2, "name": "Climate"}], ["a", "b"]),
                                (None, None)],
                               "cats array<struct<id:int,name:string>>, tb array<string>")
    rows = df.select(fn.join_names("cats", "name").alias("c"), fn.join_names("tb").alias("t")).collect()
    assert (rows[0].c, rows[0].t) == ("Sports, Climate", "a, b")
    assert (rows[1].c, rows[1].t) == ("", "")


def test_int_or_zero_and_defaults(spark):
    assert one(spark, "x string", [("12",), (None,), ("x",)], fn.int_or_zero("x")) == [12, 0, 0]
    df = spark.createDataFrame([(None,)], "active boolean")
    r = fn.fill_defaults(df, {"active": False, "category_name": K.UNKNOWN}).first()
    assert (r.active, r.category_name) == (False, "Unknown")


def test_most_counted_ties_lowest_and_skips_null(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 3), ("a", 1), ("a", None), ("a", None), ("a", None), ("b", None)],
                               "g string, h long")
    domain = [3, 0, 1]
    agg = df.groupBy("g").agg(*fn.domain_counts("h", domain, "_h"))
    assert {r.g: r.m for r in agg.select("g", fn.most_counted(domain, "_h").alias("m")).collect()} == {"a": 1, "b": None}


def test_arg_max_nulls_last_tie_and_fractions(spark):
    df = spark.createDataFrame([("g", "b", 5.0), ("g", "a", 5.0), ("g", "c", None), ("h", "z", None), ("f", "x", 1.2), ("f", "y", 1.4),
                                (None, "n", 0.5)], "g string, q string, sv double")
    got = {r.g: r.t for r in arg_max_per_group(df, ["g"], "q", "sv", "t").collect()}
    assert got == {"g": "a", "h": "z", "f": "y", None: "n"}


def test_approx_median_is_a_value(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (100,)], "v long")
    assert df.agg(fn.approx_median("v")).first()[0] == 2


def test_hours_and_instants_ignore_dst_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 4, 30))],
                                   "s timestamp_ntz, e timestamp_ntz")
        r = df.select(fn.duration_hours("s", "e").alias("h"),
                      fn.timeparts.epoch_seconds("s").alias("sec"),
                      fn.timeparts.instant_to_ntz(fn.timeparts.ntz_to_instant("s")).alias("back")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.h == 3 and r.sec == 1710034200 and r.back == dt.datetime(2024, 3, 10, 1, 30)


def test_iso_duration_parts_are_taken_once(spark, capsys):
    """The regular expression is in the plan once, and no missing part is cast (a failing cast is slow)."""
    spark.createDataFrame([("PT1M",)], "d string").select(fn.iso_duration_secs("d").alias("x")).explain(True)
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("regexp_replace(") == 1 and plan.count("try_cast(") == plan.count(" null else try_cast(")
