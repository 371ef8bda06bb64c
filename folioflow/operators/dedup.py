"""Keep the first row per key, and count what was dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.operators.quality import dedup_key_invalid


def first_per_key(df: DataFrame, keys: str | list[str], order: Column) -> DataFrame:
    """The row with the smallest `order` for each key, whole.

    An aggregation, not a window: rows of a hot key are reduced to one per map task before
    the shuffle, so no task ever holds the copies of one key.
    """
    keys = [keys] if isinstance(keys, str) else keys
    first = F.min_by(F.struct(*df.columns), order).alias("_first")
    # String and integer keys are taken from the group: Spark then knows that the rows are
    # dealt by them, and what is grouped by them next needs no shuffle.
    exact = {k for k in keys if k in df.columns and (df.schema[k].dataType == T.StringType() or isinstance(df.schema[k].dataType, T.IntegralType))}
    return df.groupBy(*keys).agg(first).select(*(F.col(c) if c in exact else F.col("_first")[c].alias(c) for c in df.columns))


def last_per_key(df: DataFrame, keys: str | list[str], order: Column) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else keys
    last = F.max_by(F.struct(*df.columns), order).alias("_last")
    return df.groupBy(*keys).agg(last).select("_last.*")


def deduplicate(papers: DataFrame, order: Column, key: str = "paper_id") -> DataFrame:
    """First arrival per key; rows without a key are dropped."""
    return first_per_key(papers.where(~dedup_key_invalid(F.col(key))), key, order)


def dedup_stats(papers: DataFrame, key: str = "paper_id", by: list[str] | None = None) -> DataFrame:
    """original / unique / duplicate / invalid counts, over all rows or per group.

    Two narrow hash aggregations; only the key column is read.
    """
    by = by or []
    key_col = F.when(~dedup_key_invalid(F.col(key)), F.col(key)).alias("_key")
    per_key = papers.select(*by, key_col).groupBy(*by, "_key").agg(F.count(F.lit(1)).alias("_n"))
    valid = F.col("_key").isNotNull()
    zero = F.lit(0).cast("long")
    counts = per_key.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), zero).alias("original_count"),
        F.count("_key").alias("unique_count"),
        F.coalesce(F.sum(F.when(valid, F.col("_n") - 1)), zero).alias("duplicate_count"),
        F.coalesce(F.sum(F.when(~valid, F.col("_n"))), zero).alias("invalid_count"),
    )
    return counts


def dedup_analysis(papers: DataFrame, by: list[str], key: str = "paper_id") -> DataFrame:
    """Counts before and after per group, and the share of duplicates in percent."""
    return dedup_stats(papers, key, by).withColumns({
        "before_count": F.col("original_count"),
        "after_count": F.col("unique_count"),
        "duplicate_rate": F.try_divide(
            F.lit(100.0) * F.col("duplicate_count"), F.col("original_count").cast("double")
        ),
    }).select(*by, "before_count", "after_count", "duplicate_count", "invalid_count", "duplicate_rate")


def union_batches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All parsed parts of a batch; the arrival order travels in their columns."""
    out = first
    for other in others:
        out = out.unionByName(other)
    return out
