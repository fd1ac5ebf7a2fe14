"""Plan shapes that the scale design relies on."""


from trendcast.catalog import REGISTRY, _new_videos_store, _posts_store, _videos_split, stg
from trendcast.operators import rows_in_month
from trendcast.plans import marts
from trendcast.sources import fixtures as fx


def plan(df) -> str:
    df.collect()   # AQE: final plan after execution
    return df._jdf.queryExecution().executedPlan().toString()


def logical_plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_recent_keywords_filter_reaches_scan(spark, sf_dir):
    p = REGISTRY["keywords_last_24h"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in p


def test_month_read_lists_only_its_own_folders(spark, sf_dir):
    store = _posts_store(spark, sf_dir)
    store.append(fx.posts(spark, sf_dir).limit(5), "1998_sep")
    files = store.load("1998_sep").inputFiles()
    assert files and not set(files) & set(store.load("1998_jul").inputFiles())


def test_month_range_reaches_the_store_scan(spark, sf_dir):
    store = _new_videos_store(spark)
    store.append(_videos_split(spark, sf_dir)[0], "1998_jul")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    p = rows_in_month(store.load("1998_jul"), "published_ts", fx.ROLLOVER_AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(published_ts," in p and "LessThan(published_ts," in p
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_details_scan_leaves_out_the_description(spark, sf_dir):
    p = REGISTRY["ingest_keyword_videos"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "publishedAt" in p and "description" not in p


def test_scans_read_only_needed_columns(spark, sf_dir):
    p = marts.keyword_peak_volume(fx.trends(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in p


def test_pulse_aggregates_partially_before_shuffle(spark, sf_dir):
    p = plan(marts.mart_category_pulse(stg(spark, sf_dir)))
    assert "partial_count" in p and "partial_max" in p
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_recurrence_and_top_queries_use_hash_aggregates(spark, sf_dir):
    for name in ("mart_keyword_recurrence", "top_keyword", "top_value_per_group", "scheduling_tip"):
        p = plan(REGISTRY[name](spark, sf_dir))
        assert "SortAggregate" not in p and "ObjectHashAggregate" not in p, name


def test_ranking_and_lookups_run_no_job_before_the_action(spark, sf_dir):
    jobs = spark.sparkContext.statusTracker()
    for name in ("mart_trending_topics", "rank_in_category", "lookup_country", "lookup_category"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        df = REGISTRY[name](spark, sf_dir)
        ran = [i for i in jobs.getJobIdsForGroup(f"build-{name}")]
        # Reading a file's schema is a job of one task; nothing else may run.
        assert all(len(jobs.getStageInfo(s).name) and jobs.getStageInfo(s).numTasks == 1
                   for i in ran for s in jobs.getJobInfo(i).stageIds), name
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_gap_aggregates_both_sides_before_join(spark, sf_dir):
    p = plan(marts.mart_gap_analysis(fx.keyword_videos(spark, sf_dir), fx.trends(spark, sf_dir), fx.AS_OF))
    assert "partial_percentile_approx" in p and "partial_max" in p


def test_dedupe_limits_groups_before_shuffle(spark, sf_dir):
    df = REGISTRY["jobs_dedupe"](spark, sf_dir)
    p = plan(df)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_top5_limits_groups_before_shuffle(spark, sf_dir):
    p = plan(REGISTRY["top5_per_category"](spark, sf_dir))
    assert "WindowGroupLimit" in p


def test_no_python_udfs_in_marts(spark, sf_dir):
    for name in ("mart_trending_topics", "mart_category_pulse", "mart_keyword_recurrence", "mart_gap_analysis",
                 "ingest_popular", "duration_secs"):
        p = logical_plan(REGISTRY[name](spark, sf_dir))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name

