"""Joins behind the backlog, coverage and retry figures, and the upsert.

Adaptive execution splits a skewed side only where it stands directly above its shuffle.
So the sides are joined as they are stored; an aggregation on the join key right before
the join would keep a hot key in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators.dedup import last_per_key


def pending_backlog(papers: DataFrame, vectors: DataFrame, key: str = "paper_id") -> DataFrame:
    """Papers that have no vector yet; several vectors of a paper need no `distinct`."""
    return papers.join(vectors.select(key), key, "left_anti")


def trace_coverage(papers: DataFrame, vectors: DataFrame, key: str = "paper_id") -> DataFrame:
    """Papers, papers with a vector, and missing ones per trace.

    Copies of a key within a trace are counted before the join, so a key with very many
    copies brings one row per trace to it.
    """
    present = vectors.select(key).distinct().withColumn("_present", F.lit(True))
    per_key = papers.groupBy("trace_id", key).agg(F.count(F.lit(1)).alias("_n"))
    found = F.coalesce(F.sum(F.when(F.col("_present"), F.col("_n"))), F.lit(0).cast("long"))
    return (
        per_key.join(present, key, "left")
        .groupBy("trace_id").agg(F.sum("_n").alias("papers"), found.alias("vectors"))
        .withColumn("missing", F.col("papers") - F.col("vectors"))
    )


def retry_set(
    papers: DataFrame, vectors: DataFrame, dead_letters: DataFrame | None = None,
    trace_id: str | None = None, key: str = "paper_id", stored_at: Column | None = None,
) -> DataFrame:
    """Keys a re-run has to handle: without a vector, or in the dead letters.

    With `stored_at`, the time of a vector, a dead letter (`failed_at`) is settled by a
    later vector of its key.
    """
    scope = papers if trace_id is None else papers.where(F.col("trace_id") == trace_id)
    todo = pending_backlog(scope.select("trace_id", key), vectors, key)
    if dead_letters is not None:
        if stored_at is not None:
            later = vectors.select(F.col(key).alias("_key"), stored_at.alias("_stored_at"))
            settled = (F.col(key) == F.col("_key")) & (F.col("_stored_at") > F.col("failed_at"))
            dead_letters = dead_letters.join(later, settled, "left_anti")
        failed = scope.select("trace_id", key).join(dead_letters.select(key), key, "left_semi")
        todo = todo.unionByName(failed)
    return todo.distinct()


def not_loaded(files: DataFrame, loaded: DataFrame, key: str = "file_path") -> DataFrame:
    """Landing files that no earlier run has loaded."""
    return files.join(loaded.select(key), key, "left_anti")


def upsert_frame(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Whole-row replace by key: incoming rows, and target rows with other keys."""
    return incoming.unionByName(target.join(incoming.select(*keys), keys, "left_anti"))


def latest_per_trace(results: DataFrame, order_columns: list[str]) -> DataFrame:
    """The newest row of each trace, a trace can be run again."""
    return last_per_key(results, "trace_id", F.struct(*order_columns))
