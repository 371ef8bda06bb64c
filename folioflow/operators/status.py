"""Status rules and rates of the batch and of the vectorization results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import stage_error

SUCCESS, PARTIAL, FAILED, COMPLETED = "success", "partial_success", "failed", "completed"


def batch_status(df: DataFrame) -> DataFrame:
    """Status of landing batches from `success_items`, `failed_items`, `file_error`.

    `file_error` is the last file error of the batch, or null. The first message that is
    set is kept, so a failed upsert hides a file error.
    """
    processed, failed = F.col("success_items"), F.col("failed_items")
    has_error = F.col("file_error").isNotNull()
    return df.withColumns({
        "processed_count": processed,
        "status": F.when(has_error & (processed == 0), FAILED)
        .when(has_error | (failed > 0), PARTIAL)
        .otherwise(SUCCESS),
        "error_message": F.when(failed > 0, F.concat(failed.cast("string"), F.lit(" items failed to upsert")))
        .otherwise(F.col("file_error")),
    })


def vector_status(df: DataFrame) -> DataFrame:
    """Status of vectorization runs.

    Reads trace_id, retrieval_error, storage_error (messages or null) and the counters
    total_papers, embeddings_generated, vectors_stored, failed_embeddings, failed_storage.
    """
    no_trace = F.coalesce(F.col("trace_id"), F.lit("")) == ""
    retrieval, storage = F.col("retrieval_error"), F.col("storage_error")
    clean = (F.col("failed_embeddings") == 0) & (F.col("failed_storage") == 0)
    none = F.lit(None).cast("string")
    status = (
        F.when(no_trace, FAILED)
        .when(retrieval.isNotNull(), FAILED)
        .when(F.col("total_papers") == 0, COMPLETED)
        .when(F.col("embeddings_generated") == 0, FAILED)
        .when(storage.isNotNull(), FAILED)
        .when(clean, COMPLETED)
        .when(F.col("vectors_stored") > 0, PARTIAL)
        .otherwise(FAILED)
    )
    message = (
        F.when(no_trace, stage_error(F.lit("validation"), F.lit("traceID cannot be empty"), none))
        .when(retrieval.isNotNull(), stage_error(
            F.lit("data_retrieval"), F.lit("failed to retrieve papers for vectorization"), retrieval))
        .when(F.col("total_papers") == 0, none)
        .when(F.col("embeddings_generated") == 0, stage_error(
            F.lit("embedding_generation"), F.lit("no embeddings were generated successfully"), none))
        .when(storage.isNotNull(), stage_error(
            F.lit("vector_storage"), F.lit("failed to store vector records"), storage))
        .when(clean | (F.col("vectors_stored") > 0), none)
        .otherwise("all vectorization operations failed")
    )
    return df.withColumns({"status": status, "error_message": message})


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole in double, null when the whole is 0."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def success_rates(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "embedding_success_rate": percent(F.col("embeddings_generated"), F.col("total_papers")),
        "storage_success_rate": percent(F.col("vectors_stored"), F.col("embeddings_generated")),
        "overall_success_rate": percent(F.col("vectors_stored"), F.col("total_papers")),
    })


def throughput_per_second(items: Column, millis: Column) -> Column:
    """Items per second, null at 0 ms."""
    return F.try_divide(items.cast("double"), millis.cast("double") / F.lit(1000.0))
