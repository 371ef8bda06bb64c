"""Figures over the run log (event_id, ts, service, level, event, trace_id, duration_ms,
data_count, attempt, error_code).

Everything per day and service comes from hash aggregations with partial sums, so hot
services or traces are reduced before the shuffle. Totals over all services are rolled
up from the per-service rows; the raw log is not expanded once per grouping set.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators.status import percent

ALL_SERVICES = "all"


def _day() -> Column:
    return F.to_date(F.col("ts")).alias("day")


def _per_day_and_total(per_service: DataFrame, *sums: str) -> DataFrame:
    """(day, service) rows plus one row per day with service `all`; `sums` are added up."""
    return (
        per_service.rollup("day", "service")
        .agg(*[F.sum(c).alias(c) for c in sums], F.grouping_id().alias("_g"))
        .where(F.col("_g") < 2)
        .withColumn("service", F.coalesce("service", F.lit(ALL_SERVICES)))
        .drop("_g")
    )


def embedding_stats(requests: DataFrame) -> DataFrame:
    """Successful requests and their mean time in ms, truncated; 0 when there is none."""
    return requests.where(F.col("error_code").isNull()).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.coalesce(F.avg("duration_ms").cast("long"), F.lit(0).cast("long")).alias("average_processing_time_ms"),
    )


# Error classes of the embedding side and their codes.
ERROR_STATUS = {
    "VALIDATION_ERROR": 400,
    "MODEL_LOAD_ERROR": 503,
    "EMBEDDING_ERROR": 500,
    "INTERNAL_ERROR": 500,
}


def errors_by_class(requests: DataFrame) -> DataFrame:
    code = F.col("error_code")
    status = F.lit(None).cast("int")
    for name, value in ERROR_STATUS.items():
        status = F.when(code == name, value).otherwise(status)
    return (
        requests.where(code.isNotNull()).groupBy("error_code")
        .agg(F.count(F.lit(1)).alias("errors"))
        .withColumn("status_code", status)
    )


def retrieval_stats(papers: DataFrame, reason: Column, by: list[str]) -> DataFrame:
    """Retrieved, valid and invalid papers per group, and those skipped for empty text."""
    marked = papers.withColumn("_reason", reason)
    return marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("retrieved"),
        F.count_if(F.col("_reason").isNull()).alias("valid"),
        F.count_if(F.col("_reason").isNotNull()).alias("invalid"),
        F.count_if((F.col("title") == "") & (F.col("abstract") == "")).alias("without_text"),
    )


def source_profile(papers: DataFrame) -> DataFrame:
    """Volume and date span per source and category."""
    return (
        papers.select("source", F.explode("categories").alias("category"), "published_date")
        .groupBy("source", "category")
        .agg(
            F.count(F.lit(1)).alias("papers"),
            F.min("published_date").alias("first_published"),
            F.max("published_date").alias("last_published"),
        )
    )


def stage_counts(log: DataFrame) -> DataFrame:
    kind = F.coalesce(F.col("error_code"), F.lit("none")).alias("error_type")
    return log.groupBy("service", "event", "level", kind).agg(F.count(F.lit(1)).alias("events"))


def daily_volume(log: DataFrame) -> DataFrame:
    return log.where(F.col("event") == "data_parsing").groupBy(_day()).agg(F.sum("data_count").alias("papers"))


def daily_rates(log: DataFrame) -> DataFrame:
    """Error and success rate per day, by service and over all."""
    per_service = log.groupBy(_day(), "service").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("level") == "ERROR").alias("errors")
    )
    return _per_day_and_total(per_service, "events", "errors").withColumns({
        "error_rate": percent(F.col("errors"), F.col("events")),
        "success_rate": percent(F.col("events") - F.col("errors"), F.col("events")),
    })


def daily_durations(log: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Mean and exact quantile of the durations per day, by service and over all.

    The log is first reduced to a histogram of whole milliseconds. Its size per group is
    bound by the run time limit of a service (900,000 ms), not by the number of rows.
    """
    histogram = log.where(F.col("duration_ms").isNotNull()).groupBy(_day(), "service", "duration_ms").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        histogram.rollup("day", "service")
        .agg(
            F.sum("n").alias("events"),
            (F.sum(F.col("duration_ms") * F.col("n")).cast("double") / F.sum("n")).alias("avg_ms"),
            F.percentile("duration_ms", quantile, F.col("n")).alias("p95_ms"),
            F.grouping_id().alias("_g"),
        )
        .where(F.col("_g") < 2)
        .withColumn("service", F.coalesce("service", F.lit(ALL_SERVICES)))
        .drop("_g")
    )


def today_counts(log: DataFrame, today: str) -> DataFrame:
    """Papers collected and vectorized on one day; the day bound reaches the scan."""
    start = F.to_date(F.lit(today))
    of_today = (F.col("ts") >= start.cast("timestamp")) & (F.col("ts") < F.date_add(start, 1).cast("timestamp"))
    parsed = log.where(of_today & (F.col("event") == "data_parsing"))
    zero = F.lit(0).cast("long")

    def total(service: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("service") == service, F.col("data_count"))), zero)

    return parsed.agg(
        total("data-collector").alias("collected_today"), total("vector-coordinator").alias("vectorized_today")
    )


def trace_spans(log: DataFrame) -> DataFrame:
    """One row per trace: start, completion, first and last event, errors."""
    ts = F.col("ts")
    return log.groupBy("trace_id").agg(
        F.min(F.when(F.col("event") == "processing_start", ts)).alias("started_at"),
        F.max(F.when(F.col("event") == "processing_complete", ts)).alias("completed_at"),
        F.min(ts).alias("first_at"),
        F.max(ts).alias("last_at"),
        F.count_if(F.col("event") == "error").alias("errors"),
    )


def _millis(later: Column, earlier: Column) -> Column:
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1000)).cast("long")


def end_to_end_latency(log: DataFrame) -> DataFrame:
    """Mean time from the first start to the last completion of a trace, by day of the start."""
    latency = _millis(F.col("completed_at"), F.col("started_at"))
    return (
        trace_spans(log).withColumn("latency_ms", latency).where(F.col("latency_ms") >= 0)
        .groupBy(F.to_date("started_at").alias("day"))
        .agg(F.count(F.lit(1)).alias("traces"), F.avg("latency_ms").alias("avg_latency_ms"))
    )


def open_traces(log: DataFrame) -> DataFrame:
    return trace_spans(log).where(F.col("started_at").isNotNull() & F.col("completed_at").isNull())


def active_traces(log: DataFrame) -> DataFrame:
    """Traces that have started and not completed, counted by day of the start."""
    return active_by_day(open_traces(log))


def active_by_day(open_spans: DataFrame) -> DataFrame:
    """The same from open traces that are known already (`streaming.open_traces` keeps them)."""
    return open_spans.groupBy(F.to_date("started_at").alias("day")).agg(F.count(F.lit(1)).alias("active_traces"))


def trace_outcome(log: DataFrame) -> DataFrame:
    """Completed and failed traces, and the mean duration of the completed ones."""
    completed = F.col("completed_at").isNotNull() & (F.col("errors") == 0)
    return trace_spans(log).agg(
        F.count_if(completed).alias("completed_traces"),
        F.count_if(F.col("errors") > 0).alias("failed_traces"),
        F.avg(F.when(completed, _millis(F.col("last_at"), F.col("first_at")))).alias("avg_duration_ms"),
    )


def daily_bytes(rows: DataFrame, day: Column, size: Column) -> DataFrame:
    return rows.groupBy(day.alias("day")).agg(F.sum(size.cast("long")).alias("bytes"))


def daily_retries(log: DataFrame) -> DataFrame:
    return log.groupBy(_day(), "service").agg(F.count_if(F.col("attempt") > 1).alias("retries"))


def daily_memory(log: DataFrame, used: Column, limits_mb: Mapping[str, int] | None = None) -> DataFrame:
    """Mean and greatest memory use in percent per day and service.

    Without limits `used` is a percentage already. The limits are a handful of literals,
    so they are looked up in the expression and not joined.
    """
    share = used.cast("double")
    if limits_mb is not None:
        limit = F.lit(None).cast("double")
        for service, mb in limits_mb.items():
            limit = F.when(F.col("service") == service, F.lit(float(mb))).otherwise(limit)
        share = percent(share, limit)
    return log.groupBy(_day(), "service").agg(
        F.avg(share).alias("avg_memory_percent"), F.max(share).alias("max_memory_percent")
    )


def daily_validation_errors(log: DataFrame) -> DataFrame:
    bad = (F.col("level") == "ERROR") & (F.col("error_code") == "VALIDATION_ERROR")
    return log.groupBy(_day()).agg(F.count_if(bad).alias("validation_errors"))


def daily_rejects(rows: DataFrame, day: Column, reason: Column) -> DataFrame:
    """Rejected rows per day and reason."""
    return (
        rows.select(day.alias("day"), reason.alias("reason")).where(F.col("reason").isNotNull())
        .groupBy("day", "reason").agg(F.count(F.lit(1)).alias("rejected"))
    )


# The services that write to a table.
WRITING_SERVICES = ("batch-processor", "vector-coordinator")


def daily_writes(log: DataFrame) -> DataFrame:
    """Write success rate and failures per day of the services that write tables."""
    return (
        log.where(F.col("service").isin(*WRITING_SERVICES)).groupBy(_day(), "service")
        .agg(F.count(F.lit(1)).alias("writes"), F.count_if(F.col("level") == "ERROR").alias("failures"))
        .withColumn("success_rate", percent(F.col("writes") - F.col("failures"), F.col("writes")))
    )


def growth(daily: DataFrame, value: str, by: list[str] | None = None, window_rows: int = 7) -> DataFrame:
    """Change against the row before, and the moving mean, in day order.

    The input has one row per day (and group), so a window partition grows with the
    calendar and not with the data.
    """
    days = Window.partitionBy(*(by or [F.lit(0)])).orderBy("day")
    return daily.withColumns({
        "change": F.col(value) - F.lag(value).over(days),
        "moving_avg": F.avg(value).over(days.rowsBetween(1 - window_rows, 0)),
    })


def recent_incidents(log: DataFrame, now: str, hours: int = 24) -> DataFrame:
    """ERROR and WARN rows of the last hours, newest first."""
    end = F.to_timestamp(F.lit(now))
    start = end - F.expr(f"INTERVAL {int(hours)} HOURS")
    return log.where(
        F.col("level").isin("ERROR", "WARN") & (F.col("ts") > start) & (F.col("ts") <= end)
    ).orderBy(F.desc("ts"), "event_id")
