"""Streaming forms of the alarms. The window alarms are those of `operators.alerts`."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from folioflow.operators.alerts import MAX_OPEN_MINUTES


def stalled_trace_stream(log: DataFrame, minutes: int = MAX_OPEN_MINUTES, lateness: str = "10 minutes") -> DataFrame:
    """Starts of traces without a completion in the `minutes` after them, by event time.

    Completions are first reduced to one row per trace and minute, then every start is
    joined to them with an outer join over a time range. A start comes out unmatched once
    the watermark has passed its limit, and the state of both sides goes with it.
    """
    def events(event: str) -> DataFrame:
        return log.where(F.col("event") == event).select("ts", "trace_id").withWatermark("ts", lateness)

    starts = events("processing_start").select("trace_id", F.col("ts").alias("started_at"))
    ends = events("processing_complete").groupBy(F.window("ts", "1 minute").alias("w"), "trace_id").agg(
        F.min("ts").alias("first_end"), F.max("ts").alias("last_end")).select(
        F.col("trace_id").alias("end_trace"), "first_end", "last_end", F.window_time("w").alias("end_time")
    )
    limit = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    completed = (
        (F.col("trace_id") == F.col("end_trace"))
        & (F.col("end_time") >= F.col("started_at")) & (F.col("end_time") <= F.col("started_at") + limit + F.expr("INTERVAL 1 MINUTE"))
        & (F.col("last_end") >= F.col("started_at")) & (F.col("first_end") <= F.col("started_at") + limit)
    )
    return starts.join(ends, completed, "left_outer").where(F.col("end_trace").isNull()).select(
        "trace_id", "started_at"
    )


class _LateRows(StreamingQueryListener):
    """Sums the late rows of one query over all its progress, of which a query itself keeps the last only."""

    def __init__(self) -> None:
        self.run_id, self.dropped, self.ended = None, 0, threading.Event()

    def onQueryStarted(self, event) -> None:
        self.run_id = self.run_id or event.runId

    def onQueryProgress(self, event) -> None:
        if event.progress.runId == self.run_id:
            self.dropped += sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run_id:
            self.ended.set()


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> int:
    """Run a stream over what is there, write its rows as Parquet; returns the late rows dropped."""
    late = _LateRows()
    streams = stream.sparkSession.streams
    streams.addListener(late)
    query = (
        stream.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    try:
        query.awaitTermination()
        late.ended.wait(30)  # events come behind the query
    finally:
        streams.removeListener(late)
    return late.dropped
