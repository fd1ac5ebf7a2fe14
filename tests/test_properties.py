"""Property tests: operators against plain-Python statements of the same rule.

Each example is a whole generated dataset, so every example costs a few Spark
jobs; the example counts are small on purpose.
"""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from trendcast import functions as fn
from trendcast import operators as op
from trendcast.operators import ranking

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

durations = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)),                  # weeks
    st.one_of(st.none(), st.integers(0, 40)),                 # days
    st.one_of(st.none(), st.integers(0, 30)),                 # hours
    st.one_of(st.none(), st.integers(0, 90)),                 # minutes
    st.one_of(st.none(), st.integers(0, 90)),                 # seconds
    st.one_of(st.none(), st.integers(0, 999)),                # fraction of seconds
)


def iso_text(parts):
    w, d, h, m, s, frac = parts
    text = "P" + (f"{w}W" if w is not None else "") + (f"{d}D" if d is not None else "")
    time = (f"{h}H" if h is not None else "") + (f"{m}M" if m is not None else "")
    if s is not None:
        time += f"{s}.{frac}S" if frac is not None else f"{s}S"
    if time:
        text += "T" + time
    return text


def iso_expected(parts):
    w, d, h, m, s, frac = parts
    if all(x is None for x in (w, d, h, m, s)):
        return 0
    total = (w or 0) * 604800 + (d or 0) * 86400 + (h or 0) * 3600 + (m or 0) * 60 + (s or 0)
    return total   # the fraction never adds a whole second


@SETTINGS
@given(st.lists(durations, min_size=1, max_size=60))
def test_iso_duration_matches_arithmetic(spark, items):
    texts = [iso_text(p) for p in items]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    got = [r[0] for r in df.select(fn.iso_duration_secs("d")).collect()]
    assert got == [iso_expected(p) for p in items]


rows_strategy = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), st.integers(0, 20), st.integers(0, 3)),
    min_size=1, max_size=300)


@SETTINGS
@given(rows_strategy, st.integers(1, 2))
def test_split_numbering_equals_window(spark, rows, levels):
    df = spark.createDataFrame(rows, "g string, s long, t long")
    order = [F.col("s").desc(), F.col("t").asc()]
    got = ranking.row_number_split(df, ["g"], order, "rn", lead=["s", "t"][:levels])
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
    key = lambda d: Counter(tuple(r) for r in d.select("g", "s", "t", "rn").collect())
    assert key(got) == key(want)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3", None]), st.integers(0, 5), st.integers(0, 5)),
                min_size=1, max_size=200))
def test_keep_one_is_the_ordered_minimum(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts long, v long")
    got = {r.k: (r.ts, r.v) for r in op.keep_one(df, ["k"], [F.col("ts").desc()]).collect()}
    groups = defaultdict(list)
    for k, ts, v in rows:
        groups[k].append((-ts, v))
    want = {k: (-min(vals)[0], min(vals)[1]) for k, vals in groups.items()}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2"]), st.one_of(st.none(), st.integers(0, 6))),
                min_size=1, max_size=200))
def test_top_value_per_group_matches_counting(spark, rows):
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r.g: r.top_v for r in op.top_value_per_group(df, ["g"], "v", "top_v").collect()}
    counts = defaultdict(Counter)
    for g, v in rows:
        if v is not None:
            counts[g][v] += 1
    want = {g: min(c, key=lambda v: (-c[v], v)) for g, c in counts.items()}
    assert got == want
    domain = list(range(7))
    bounded = {r.g: r.m for r in df.groupBy("g").agg(*fn.domain_counts("v", domain, "_n"))
               .select("g", fn.most_counted(domain, "_n").alias("m")).collect()}
    assert {g: m for g, m in bounded.items() if m is not None} == want
