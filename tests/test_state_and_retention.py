"""Open traces read from the state of a stream; deletion of expired days; numbering by two levels of sums."""

import random

from pyspark.sql import functions as F
from plan_metrics import bytes_moved

from folioflow import session
from folioflow.operators import alerts, batches, monitor, retention
from folioflow.session import scratch_dir
from folioflow.streaming import open_traces

LOG = "ts timestamp, trace_id string, event string"


def events(spark, path, rows):
    spark.createDataFrame(rows, "ts string, trace_id string, event string").select(
        F.col("ts").cast("timestamp").alias("ts"), "trace_id", "event").write.mode("append").parquet(path)


def test_state_follows_the_log(spark):
    """Runs of the stream go on where the last one ended, and the state equals the whole log."""
    rng, path, checkpoint = random.Random(3), scratch_dir(spark, "log"), scratch_dir(spark, "state")
    kinds = ["processing_start", "processing_complete", "metrics", "error"]
    for run in range(3):
        rows = [(f"2024-01-{rng.randrange(1, 28):02d} {rng.randrange(24):02d}:00:00", f"t{rng.randrange(40)}", rng.choice(kinds)) for _ in range(60)]
        events(spark, path, rows)
        open_traces.follow_traces(spark.readStream.schema(LOG).parquet(path), checkpoint).awaitTermination()
        log = spark.read.parquet(path)
        key = lambda df: sorted(tuple(r) for r in df.select("trace_id", "started_at").collect())
        assert key(open_traces.open_spans(spark, checkpoint)) == key(monitor.open_traces(log))
        now = "2024-01-15 12:00:00"
        assert key(alerts.stalled(open_traces.open_spans(spark, checkpoint), now)) == key(alerts.stalled_traces(log, now))


def test_closed_days_leave_the_state(spark):
    path, checkpoint = scratch_dir(spark, "log"), scratch_dir(spark, "state")
    follow = lambda: open_traces.follow_traces(spark.readStream.schema(LOG).parquet(path), checkpoint, keep="2 days").awaitTermination()
    events(spark, path, [("2024-01-01 10:00:00", "old", "processing_start"), ("2024-01-01 10:00:00", "done", "processing_start"), ("2024-01-01 11:00:00", "done", "processing_complete")])
    follow()
    assert [r.trace_id for r in open_traces.open_spans(spark, checkpoint).collect()] == ["old"]
    events(spark, path, [("2024-01-09 10:00:00", "new", "processing_start")])
    follow()
    assert [r.trace_id for r in open_traces.open_spans(spark, checkpoint).collect()] == ["new"]


def test_expired_days_are_deleted_unread(spark):
    path = scratch_dir(spark, "log-store")
    log = spark.range(100).selectExpr(
        "case when id < 99 then timestamp '2024-01-01 23:00:00' + make_interval(0, 0, 0, cast(id as int)) end as ts", "id as event_id")
    retention.store_logs(log.where("event_id < 50 or event_id = 99"), path)
    retention.store_logs(log.where("event_id between 50 and 98"), path)
    with bytes_moved(spark) as moved:
        gone = retention.drop_expired(spark, path, "2024-03-01")
    assert moved == {"read": 0, "written": 0}
    assert len(gone) == 30 and gone[0] == "2024-01-01" and gone[-1] == "2024-01-30"
    kept = retention.read_logs(spark, path, log.schema)
    assert sorted(r.event_id for r in kept.collect()) == [*range(30, 99), 99]
    assert retention.drop_expired(spark, path, "2024-03-01") == []
    assert "day=2024-01-31" in session.list_names(spark, path)
    assert retention.drop_expired(spark, f"{path}/nothing", "2024-03-01") == []


def test_rows_before_a_block(spark):
    rng = random.Random(5)
    counts = {(g, b): rng.randrange(1, 9) for g in ("", "hot") for b in rng.sample(range(-20, 400), 150)}
    df = spark.createDataFrame([(g, b, n) for (g, b), n in counts.items()], "_group string, _block long, _rows long")
    found = {(r["_group"], r["_block"]): r["_before"] for r in batches.rows_before(df, 7).collect()}
    assert found == {(g, b): sum(n for (h, c), n in counts.items() if h == g and c < b) for g, b in counts}


def test_windows_over_blocks_are_spread(spark):
    """A million blocks of one group: the window over them is by span, and the one over the group has a row per span."""
    counts = spark.range(1_000_000).select(F.lit("").alias("_group"), F.col("id").alias("_block"), F.lit(2).cast("long").alias("_rows"))
    before = batches.rows_before(counts)
    assert before.where("_before <> 2 * _block").count() == 0 and before.count() == 1_000_000
    assert counts.select(F.floor(F.col("_block") / batches.BLOCKS_PER_SPAN)).distinct().count() == 1_000
    text = before._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [") == 2 and "_span" in text
