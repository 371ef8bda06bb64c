"""Threshold alerts. The window alarms take a batch or a streaming run log alike."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators.batches import number_rows
from folioflow.operators.monitor import daily_memory, daily_rates, open_traces
from folioflow.operators.status import FAILED, percent

CRITICAL, WARNING = "critical", "warning"

# Periods and thresholds of the alarms; all comparisons are strict.
PERIOD = "300 seconds"
MAX_ERRORS = 5
MAX_WRITE_UNITS = 80
MAX_THROTTLES = 10
MAX_OPEN_MINUTES = 30
CRITICAL_SUCCESS_RATE = 80.0
WARNING_SUCCESS_RATE = 95.0
MAX_MEMORY_PERCENT = 80.0
BASELINE_BATCHES = 30
BASELINE_DEVIATIONS = 3.0


def windowed_alarm(
    log: DataFrame, value: Column, threshold: float, by: str = "service",
    period: str = PERIOD, lateness: str = "10 minutes",
) -> DataFrame:
    """Sum of `value` per tumbling window and group, where it is above the threshold."""
    if log.isStreaming:
        log = log.withWatermark("ts", lateness)
    return (
        log.groupBy(F.window("ts", period).alias("w"), by)
        .agg(F.sum(value).alias("total"))
        .where(F.col("total") > threshold)
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, "total")
    )


def _count(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


def _errors() -> Column:
    return _count(F.col("level") == "ERROR")


def error_alarm(log: DataFrame, threshold: int = MAX_ERRORS, **kw) -> DataFrame:
    return windowed_alarm(log, _errors(), threshold, **kw)


def write_volume_alarm(log: DataFrame, units: Column, threshold: float = MAX_WRITE_UNITS, **kw) -> DataFrame:
    return windowed_alarm(log, units, threshold, **kw)


def throttling_alarm(log: DataFrame, throttled: Column, threshold: int = MAX_THROTTLES, **kw) -> DataFrame:
    return windowed_alarm(log, _count(throttled), threshold, **kw)


def window_totals(log: DataFrame, units: Column, throttled: Column, used: Column, period: str = PERIOD) -> DataFrame:
    """What the window, success-rate and memory alarms need, per window and service, from one pass over the log."""
    return log.groupBy(F.window("ts", period).alias("w"), "service").agg(
        F.sum(_errors()).alias("errors"), F.sum(units).alias("write_volume"), F.sum(_count(throttled)).alias("throttling"),
        F.count(F.lit(1)).alias("events"), F.sum(used.cast("double")).alias("used"), F.count(used).alias("used_events"))


def window_alarms(totals: DataFrame) -> DataFrame:
    """The three window alarms in the summary's shape."""
    alarms = {"errors": MAX_ERRORS, "write_volume": MAX_WRITE_UNITS, "throttling": MAX_THROTTLES}
    entries = F.array(*[
        F.struct(F.lit(name).alias("alert"), F.col(name).cast("double").alias("value"),
                 F.lit(float(threshold)).alias("threshold"))
        for name, threshold in alarms.items()
    ])
    raised = F.filter(entries, lambda e: e["value"] > e["threshold"])
    return totals.select("service", "w", F.explode(raised).alias("e")).select(
        "e.alert", F.lit(CRITICAL).alias("severity"), "service", F.col("w.start").alias("window_start"),
        "e.value", "e.threshold")


def day_totals(totals: DataFrame) -> DataFrame:
    """Success rate and mean memory use per day and service. A window has to lie within a day."""
    return totals.groupBy(F.to_date("w.start").alias("day"), "service").agg(
        percent(F.sum("events") - F.sum("errors"), F.sum("events")).alias("success_rate"),
        F.try_divide(F.sum("used"), F.sum("used_events")).alias("avg_memory_percent"))


def stalled_traces(log: DataFrame, now: str, minutes: int = MAX_OPEN_MINUTES) -> DataFrame:
    """Traces that started more than `minutes` before `now` and have not completed."""
    return stalled(open_traces(log), now, minutes)


def stalled(open_spans: DataFrame, now: str, minutes: int = MAX_OPEN_MINUTES) -> DataFrame:
    """The same from open traces that are known already (`streaming.open_traces` keeps them)."""
    limit = F.to_timestamp(F.lit(now)) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return open_spans.where(F.col("started_at") < limit).select("trace_id", "started_at")


def stopped_flows(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") == FAILED)


def success_rate_alarm(log: DataFrame) -> DataFrame:
    """Days on which a service (not the total) fell below the success thresholds."""
    return low_success(daily_rates(log).where(F.col("service") != "all"))


def low_success(rates: DataFrame) -> DataFrame:
    rate = F.col("success_rate")
    severity = F.when(rate < CRITICAL_SUCCESS_RATE, CRITICAL).when(rate < WARNING_SUCCESS_RATE, WARNING)
    return (
        rates.withColumn("severity", severity).where(F.col("severity").isNotNull())
        .select("day", "service", "success_rate", "severity")
    )


def memory_alarm(log: DataFrame, used: Column, threshold: float = MAX_MEMORY_PERCENT, limits_mb=None) -> DataFrame:
    return daily_memory(log, used, limits_mb).where(F.col("avg_memory_percent") > threshold)


def trace_duplicate_rates(papers: DataFrame, arrival: str) -> DataFrame:
    """Duplicate rate per trace, with the first arrival number as its place in time."""
    key = F.when(F.col("paper_id") != "", F.col("paper_id")).alias("_key")
    per_key = papers.select("trace_id", key, arrival).groupBy("trace_id", "_key").agg(
        F.count(F.lit(1)).alias("_n"), F.min(arrival).alias("_first")
    )
    copies = F.when(F.col("_key").isNotNull(), F.col("_n") - 1).otherwise(0)
    return per_key.groupBy("trace_id").agg(
        F.min("_first").alias("batch_order"), percent(F.sum(copies), F.sum("_n")).alias("duplicate_rate")
    )


def dedup_rate_bounds(
    papers: DataFrame, arrival: str, batches: int = BASELINE_BATCHES, deviations: float = BASELINE_DEVIATIONS,
) -> DataFrame:
    """Duplicate rate of each trace against mean +- sd of the `batches` traces before it."""
    return rolling_bounds(trace_duplicate_rates(papers, arrival), batches, deviations)


def rolling_bounds(rates: DataFrame, batches: int, deviations: float, segment: int = 100_000) -> DataFrame:
    """Bounds from the rows before, in `batch_order`, without one task for all traces.

    Rows are numbered and cut into segments; the last `batches` rows of a segment are
    copied to the next one, so that its first rows see their whole history.
    """
    numbered = number_rows(rates.withColumn("_all", F.lit("")), "_all", "batch_order")
    place = F.col("row_no") - 1
    own = F.floor(place / F.lit(segment)).cast("long")
    copies = F.when(place % segment >= segment - batches, F.array(own, own + 1)).otherwise(F.array(own))
    earlier = Window.partitionBy("_segment").orderBy("row_no").rowsBetween(-batches, -1)
    rate, spread = F.col("duplicate_rate"), F.lit(deviations) * F.col("sd_rate")
    outside = (rate < F.col("mean_rate") - spread) | (rate > F.col("mean_rate") + spread)
    return (
        numbered.withColumn("_own", own).withColumn("_segment", F.explode(copies))
        .withColumns({"mean_rate": F.avg(rate).over(earlier), "sd_rate": F.stddev_samp(rate).over(earlier)})
        .where(F.col("_segment") == F.col("_own"))
        .withColumn("outside", F.coalesce(outside, F.lit(False)))
        .select(*rates.columns, "mean_rate", "sd_rate", "outside")
    )


def alert_rows(df: DataFrame, alert: str, severity: Column | str, service: Column, window_start: Column,
               value: Column, threshold: Column | float) -> DataFrame:
    """Bring an alert into the common shape of the summary."""
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.select(
        F.lit(alert).alias("alert"), as_col(severity).alias("severity"), service.cast("string").alias("service"),
        window_start.cast("timestamp").alias("window_start"), value.cast("double").alias("value"),
        as_col(threshold).cast("double").alias("threshold"),
    )


def alert_summary(alerts: list[DataFrame]) -> DataFrame:
    """Active alerts by severity and kind."""
    union = reduce(DataFrame.unionByName, alerts)
    return union.groupBy("severity", "alert").agg(F.count(F.lit(1)).alias("active_alerts"))
