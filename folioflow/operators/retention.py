"""Age rules for landing files and logs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow import session

# Fixed values, in days.
INFREQUENT_AFTER = 30
ARCHIVE_AFTER = 90
LOG_DAYS = 30


def storage_tier(day: Column, today: Column) -> Column:
    age = F.datediff(today, day)
    return (
        F.when(age >= ARCHIVE_AFTER, "archive")
        .when(age >= INFREQUENT_AFTER, "infrequent")
        .otherwise("standard")
    )


def tier_plan(files: DataFrame, day: Column, size: Column, today: str) -> DataFrame:
    """Partitions (days) with tier, objects and bytes; nothing is moved."""
    per_day = files.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("objects"), F.sum(size.cast("long")).alias("bytes")
    )
    return per_day.withColumn("tier", storage_tier(F.col("day"), F.to_date(F.lit(today))))


def retained_logs(log: DataFrame, today: str, days: int = LOG_DAYS) -> DataFrame:
    """Log rows that are at most `days` old; the bound is a literal, so it is pushed down."""
    oldest = F.date_sub(F.to_date(F.lit(today)), days)
    return log.where(F.col("ts") >= oldest.cast("timestamp"))


def store_logs(log: DataFrame, path: str) -> None:
    """Append log rows to a store that has one folder per day."""
    log.withColumn("day", F.to_date("ts")).hint("rebalance", F.col("day")).write.mode("append").partitionBy("day").parquet(path)


def read_logs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a log store; filters on `day` choose folders."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(path)


def expired_days(spark: SparkSession, path: str, today: str, days: int = LOG_DAYS) -> list[str]:
    """Days of a log store that are more than `days` old, by the names of its folders."""
    oldest = date.fromisoformat(today) - timedelta(days=days)
    found = (n.removeprefix("day=") for n in session.list_names(spark, path) if n.startswith("day=") and n != "day=__HIVE_DEFAULT_PARTITION__")
    return sorted(d for d in found if date.fromisoformat(d) < oldest)


def drop_expired(spark: SparkSession, path: str, today: str, days: int = LOG_DAYS) -> list[str]:
    """Delete the folders of the expired days, reading none of their rows; returns the days. Repeating it deletes nothing more.

    Rows without a time have no day and stay.
    """
    gone = expired_days(spark, path, today, days)
    for day in gone:
        session.remove(spark, f"{path}/day={day}")
    return gone
