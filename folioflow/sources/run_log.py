"""Run log scan: one JSON object per line, optional fields may be absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.schemas import RUN_LOG_LINE


def read_run_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Log lines; a broken line is kept whole in `corrupt_line`. Nested metadata stays JSON."""
    return (
        spark.read.schema(RUN_LOG_LINE)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt_line")
        .json(path)
    )


def log_events(lines: DataFrame) -> DataFrame:
    """Log lines in the shape the monitor reads; event and attempt come from the metadata."""
    meta = F.try_parse_json("metadata")
    return lines.where(F.col("corrupt_line").isNull()).select(
        F.col("timestamp").alias("ts"), "service", "level",
        F.try_variant_get(meta, "$.event", "string").alias("event"),
        "trace_id", "duration_ms", F.col("data_count").cast("long").alias("data_count"),
        F.coalesce(F.try_variant_get(meta, "$.attempt", "long"), F.lit(1).cast("long")).alias("attempt"),
        F.col("error.code").alias("error_code"),
    )
