"""Shapes of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import oracle
from folioflow.operators import joins, lookup, monitor, quality, retention
from folioflow.session import scratch_dir

# Work on files or streams when they are built, so their plans are checked by other tests.
EAGER = re.compile(r"^(s1_|s2_|s3_|s5_|f6_|p7_|u_all|k[1-7]_(?!upsert_frame|upsert_with)|st[1-3]_|st[46]_.*_stream|s6_key)")
# One row per day enters these windows.
CALENDAR_WINDOWS = {"a17_storage_growth"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not EAGER.match(n)))
def test_no_cross_joins_and_no_single_task_windows(spark, name):
    text = plan(entry.queries()[name](spark, oracle.SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    if name not in CALENDAR_WINDOWS:
        windows = re.findall(r"Window \[.*?\], \[(.*?)\]", text)
        assert all(w for w in windows)


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_dir(spark, "papers")
    spark.range(1000).select(
        F.col("id").cast("string").alias("paper_id"), F.concat(F.lit("s"), F.col("id") % 5).alias("source"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("published_date"),
        F.lit("t").alias("trace_id"), F.current_timestamp().alias("batch_timestamp"), F.lit("x").alias("title"),
        F.array(F.lit("en")).alias("categories"),
    ).write.partitionBy("source").parquet(path)
    return spark.read.parquet(path)


def test_date_bounds_reach_the_scan(stored):
    text = plan(stored.where(quality.published_between(F.col("published_date"), "2024-02-01", "2024-02-10")))
    assert "GreaterThanOrEqual(published_date,2024-02-01)" in text and "LessThan(published_date,2024-02-11)" in text


def test_ignored_bound_leaves_no_filter(stored):
    text = plan(stored.where(quality.published_between(F.col("published_date"), "2024-02-01", "soon")))
    assert "LessThan(" not in text and "GreaterThanOrEqual(published_date,2024-02-01)" in text


def test_source_prunes_partitions(stored):
    text = plan(lookup.papers_of_source(stored, "s3", "2024-01-05", "2024-01-09"))
    assert re.search(r"PartitionFilters: \[[^\]]*s3", text) and "GreaterThanOrEqual(published_date" in text
    gate = plan(stored.where(quality.from_enabled_source(F.col("source"), {"s1": {}, "s2": {}})))
    assert re.search(r"PartitionFilters: \[[^\]]*source#\d+ IN \(s1,s2\)", gate)


def test_trace_lookup_reads_the_filter(stored):
    assert "EqualTo(trace_id,t)" in plan(lookup.papers_of_trace(stored, "t"))


def test_backlog_reads_only_keys(spark, stored):
    vectors = stored.select("paper_id", F.lit("v").alias("vector_type"), "title")
    text = plan(joins.pending_backlog(stored, vectors).select("paper_id"))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert schemas and all("title" not in s for s in schemas)


def test_search_page_is_top_k(stored):
    text = plan(lookup.newest(stored, ["paper_id"], 20, 50))
    assert "TakeOrderedAndProject" in text


def test_log_bounds_reach_the_scan(spark):
    path = scratch_dir(spark, "log")
    spark.range(10).select(
        F.timestamp_seconds(F.lit(1705000000) + F.col("id")).alias("ts"), F.lit("ERROR").alias("level"),
        F.lit("s").alias("service"), F.lit("data_parsing").alias("event"), F.col("id").alias("data_count"),
        F.col("id").alias("event_id"),
    ).write.parquet(path)
    log = spark.read.parquet(path)
    assert "GreaterThanOrEqual(ts," in plan(retention.retained_logs(log, "2024-02-10"))
    assert "GreaterThan(ts," in plan(monitor.recent_incidents(log, "2024-01-20 12:00:00"))
    today = plan(monitor.today_counts(log, "2024-01-20"))
    assert "GreaterThanOrEqual(ts," in today and "LessThan(ts," in today


def test_hot_key_of_the_backlog_is_split(spark):
    path = scratch_dir(spark, "hot")
    spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("paper_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("title"),
    ).write.parquet(path)
    papers = spark.read.parquet(path)
    vectors = papers.where("paper_id <> 'hot' and paper_id like '%1'")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB", "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        backlog = joins.pending_backlog(papers, vectors).groupBy().agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.hash("title")))
        assert backlog.collect()[0].n == 300_000 - vectors.count()
        assert "SortMergeJoin(skew=true)" in plan(backlog)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
