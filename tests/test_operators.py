"""Operators: skew-safe numbering, dedupe survivors, lookups, anti-join, top value."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trendcast import operators as op
from trendcast.operators import ranking


def test_split_numbering_matches_window_with_hot_group(spark):
    # One group holds most rows, including runs of identical rows.
    hot = spark.range(0, 5000).select(F.lit("hot").alias("g"), (F.col("id") % 97).alias("s"),
                                      (F.col("id") % 13).alias("t"))
    cold = spark.range(0, 300).select((F.col("id") % 7).cast("string").alias("g"), F.col("id").alias("s"),
                                      F.lit(0).cast("bigint").alias("t"))
    nulls = spark.range(0, 50).select(F.lit(None).cast("string").alias("g"), F.col("id").alias("s"),
                                      F.lit(1).cast("bigint").alias("t"))
    df = hot.unionByName(cold).unionByName(nulls)
    order = [F.col("s").desc(), F.col("t").asc()]
    got = ranking.row_number_split(df, ["g"], order, "rn", lead=["s"])
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
    key = ["g", "s", "t", "rn"]
    assert sorted(map(tuple, got.select(*key).collect()), key=repr) == \
        sorted(map(tuple, want.select(*key).collect()), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "hashpartitioning(g#" in plan


def test_numbering_of_all_different_and_of_equal_leads(spark):
    """One group with different scores throughout, one large tie, odd numbers: right numbers, small units, two reads of the input."""
    odd = [float("nan"), float("inf"), float("-inf"), 0.0, -0.0, -1.5, 1e300, -1e300, 1e-300, None]
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "different").when(F.col("id") % 3 == 1, "tie").otherwise("odd").alias("g"),
        F.when(F.col("id") % 3 == 0, F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7).when(F.col("id") % 3 == 1, 5.0)
        .otherwise(F.get(F.array(*[F.lit(x).cast("double") for x in odd]), (F.col("id") % 10).cast("int"))).alias("s"),
        F.concat(F.lit("q"), (F.col("id") * 7919 % 6000).cast("string")).alias("t"))
    for order in ([F.col("s").desc_nulls_last(), F.col("t").asc_nulls_first()], [F.col("s").asc_nulls_first(), F.col("t").desc()]):
        got = ranking.row_number_split(df, ["g"], order, "rn", lead=["s", "t"])
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
        key = lambda d: sorted(map(repr, d.select("g", "t", "rn").collect()))
        assert key(got) == key(want)
    cells = df.where("g = 'different'").groupBy(ranking._cell(df, "s")).count().agg(F.max("count")).first()[0]
    values = df.where("g = 'tie'").groupBy(ranking._cell(df, "t")).count().agg(F.max("count")).first()[0]
    assert cells < 20 and values < 400


def test_top_n_uses_partial_group_limit(spark):
    df = spark.range(0, 1000).select((F.col("id") % 4).alias("g"), F.col("id").alias("s"))
    out = op.top_n_per_group(df, ["g"], [F.col("s").desc()], 2, rank_col="r")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted((r.g, r.s) for r in out.collect()) == [(0, 992), (0, 996), (1, 993), (1, 997),
                                                        (2, 994), (2, 998), (3, 995), (3, 999)]


def test_keep_one_survivor_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "b"), (None, 1, "n1"), (None, 2, "n2")],
                               "k string, ts long, v string")
    got = sorted(map(tuple, op.keep_one(df, ["k"], [F.col("ts").desc()]).collect()), key=repr)
    assert got == sorted([("a", 3, "b"), (None, 2, "n2")], key=repr)


def test_duplicate_count(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)], "k string, v long")
    r = op.duplicate_count(df, ["k"]).first()
    assert (r.total_rows, r.distinct_keys, r.duplicates) == (5, 3, 2)


def test_lookup_default_without_a_hint(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "code string")
    dim = spark.createDataFrame([("1", "Kenya")], "code string, name string")
    small = op.lookup(df, dim, on="code", value="name")
    assert sorted(r.name for r in small.collect()) == ["Kenya", "Unknown", "Unknown"]
    two = op.lookup(df.selectExpr("code", "'x' as c2"), dim.selectExpr("code", "'x' as c2", "name"), on=["code", "c2"], value="name")
    assert sorted(r.name for r in two.collect()) == ["Kenya", "Unknown", "Unknown"]
    plan = small._jdf.queryExecution().optimizedPlan().toString()
    assert "SinglePartition" not in plan and "strategy=broadcast" not in plan


def test_not_yet_present_null_safe(spark):
    prev = spark.createDataFrame([("v1", "t1"), ("v2", None), ("v3", "t3")], "video_id string, published_at string")
    have = spark.createDataFrame([("v1", "t1"), ("v2", None), ("v2", None)], "video_id string, published_at string")
    got = op.not_yet_present(prev, have, ["video_id", "published_at"]).collect()
    assert [tuple(r) for r in got] == [("v3", "t3")]


def test_top_value_per_group_two_level(spark):
    df = spark.createDataFrame([("k", 5), ("k", 5), ("k", 3), ("k", 3), ("k", None), ("j", 9)], "g string, v long")
    got = {r.g: (r.top_v, r.top_v_count) for r in op.top_value_per_group(df, ["g"], "v", "top_v").collect()}
    assert got == {"k": (3, 2), "j": (9, 1)}


def test_union_all_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id long, extra string")
    b = spark.createDataFrame([(2,)], "id long")
    assert sorted(map(tuple, op.union_all(a, b).collect()), key=repr) == sorted([(1, "x"), (2, None)], key=repr)


def test_semi_on_folded(spark):
    df = spark.createDataFrame([("CLICK 9",), ("view 1",)], "keyword string")
    keys = spark.createDataFrame([("click 9",), ("Click 9",)], "query string")
    assert [r.keyword for r in op.semi_on_folded(df, "keyword", keys, "query").collect()] == ["CLICK 9"]


def test_shuffles_follow_the_size_of_a_table(spark, sf_dir, monkeypatch):
    from trendcast import session
    from trendcast.sources.tables import read_table
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        read_table(spark, sf_dir, "lineitem")
        assert spark.conf.get(initial, None) is None     # small: the session's number is enough
        monkeypatch.setattr(session, "BYTES_A_PART", 1 << 10)
        read_table(spark, sf_dir, "lineitem")
        enough = int(spark.conf.get(initial))
        assert enough > 100
        read_table(spark, sf_dir, "nation")
        assert int(spark.conf.get(initial)) == enough    # never lowered
        assert spark.conf.get(session._SCAN) == session.SCAN_BYTES
    finally:
        spark.conf.unset(initial)
        spark.conf.unset(session._SCAN)


def test_pages_shuffle_only_the_columns_of_the_table(spark, sf_dir):
    """Items are made after rows of a page have met, and pages are landed compressed."""
    import os

    from trendcast.sources import landing_fixtures as lf
    for pages in (lf.popular_pages(spark, sf_dir), lf.search_pages(spark, sf_dir), lf.detail_pages(spark, sf_dir),
                  lf.posts_pages(spark, sf_dir), lf.jobs_pages(spark, sf_dir)):
        plan = pages._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression" in plan
        below = plan.split("RepartitionByExpression", 1)[1].split("Relation", 1)[0]
        assert "named_struct" not in below and "concat(" not in below
    path = lf.land(lf.search_pages(spark, sf_dir), "t-pages")
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert files and all(f.endswith(".json." + lf.PAGES_CODEC) for f in files)
