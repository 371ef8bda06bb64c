"""Open traces kept by a stream, so that reports need not read the log again.

A streaming aggregation holds per trace its first start and last completion, which is all
that the reports ask for. The state lies in the checkpoint, and is read from there as a
table: its size is the number of traces, whatever the length of the log. With `keep`, a
trace without any event for that long leaves the state, by event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def follow_traces(log: DataFrame, checkpoint: str, keep: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Keep the spans of the traces of a streaming log in the state of a query; by default it ends with what is there.

    With `keep` traces are kept by day of their events, which the watermark closes.
    """
    ts, event = F.col("ts"), F.col("event")
    by = ["trace_id"]
    if keep is not None:
        log, by = log.withWatermark("ts", keep), ["trace_id", F.window("ts", "1 day").alias("w")]
    spans = log.groupBy(*by).agg(
        F.min(F.when(event == "processing_start", ts)).alias("started_at"),
        F.max(F.when(event == "processing_complete", ts)).alias("completed_at"))
    return (
        spans.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def followed_spans(spark: SparkSession, checkpoint: str) -> DataFrame:
    """trace_id, started_at and completed_at of the traces in the state, as of the last finished batch."""
    state = spark.read.format("statestore").load(checkpoint)
    spans = state.select("key.trace_id", F.col("value.min").alias("started_at"), F.col("value.max").alias("completed_at"))
    return spans.groupBy("trace_id").agg(F.min("started_at").alias("started_at"), F.max("completed_at").alias("completed_at"))


def open_spans(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The traces that have started and not completed."""
    return followed_spans(spark, checkpoint).where(F.col("started_at").isNotNull() & F.col("completed_at").isNull())
