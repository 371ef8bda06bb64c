"""The three jobs: collect a feed, take in a landing batch, vectorize a trace."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import combine_title_abstract
from folioflow.operators import embed, quality, records, status
from folioflow.operators.batches import WRITE_BATCH, upsert_stats
from folioflow.operators.dedup import deduplicate
from folioflow.operators.lookup import newest
from folioflow.sources import landing
from folioflow.sources.tables import KeyedTable, dead_letters, store_vectors

# Fixed values of the default feed search.
DEFAULT_CATEGORIES = ("cs.AI", "cs.LG", "cs.CL")


def collect_feed(
    entries: DataFrame, categories: Iterable[str] = DEFAULT_CATEGORIES, date_from: str | None = None,
    date_to: str | None = None, max_results: int | None = None, source: str = records.FEED_SOURCE,
) -> DataFrame:
    """The papers of a feed in some categories and a range of days, ready to land.

    All of them; `max_results` asks for a page of the newest.
    """
    papers = records.entries_to_papers(entries, source).where(
        quality.in_categories(F.col("categories"), categories)
        & quality.published_between(F.col("published_date"), date_from, date_to)
    )
    return papers if max_results is None else newest(papers, ["id"], 0, max_results)


def clean_batch(landed: DataFrame, trace_id: str, batch_time: datetime | None = None) -> DataFrame:
    """Landed records to stamped papers, the first arrival per key."""
    usable = landed.where(F.col("record_key").isNotNull() & F.col("record_error").isNull())
    papers = records.normalize_records(usable, keep=landing.ARRIVAL)
    first = deduplicate(papers.where(F.col("paper_id").isNotNull()), landing.arrival_order())
    return records.stamp_batch(first.drop(*landing.ARRIVAL), trace_id, batch_time)


def batch_counts(landed: DataFrame) -> DataFrame:
    """One row: records, unique, duplicate and invalid ones, file errors and the last of them.

    Reads keys and errors only, not the records.
    """
    keyed = landed.select(
        F.when(F.col("record_error").isNull(), F.col("record_key")).alias("_key"),
        "record_error", landing.file_message().alias("file_error"), landing.arrival_order().alias("_at"),
    )
    per_key = keyed.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_n"), F.count("record_error").alias("_bad"), F.count("file_error").alias("_files"),
        F.max_by("file_error", F.when(F.col("file_error").isNotNull(), F.col("_at"))).alias("_error"),
        F.max(F.when(F.col("file_error").isNotNull(), F.col("_at"))).alias("_error_at"),
    )
    has_key = F.col("_key").isNotNull()
    zero = F.lit(0).cast("long")
    return per_key.agg(
        F.coalesce(F.sum(F.when(has_key, F.col("_n"))), zero).alias("original_count"),
        F.count("_key").alias("unique_count"),
        F.coalesce(F.sum(F.when(has_key, F.col("_n") - 1)), zero).alias("duplicate_count"),
        zero.alias("invalid_count"),
        F.coalesce(F.sum("_bad"), zero).alias("record_errors"),
        F.coalesce(F.sum("_files"), zero).alias("file_errors"),
        F.max_by("_error", "_error_at").alias("file_error"),
    )


def batch_result(counts: DataFrame, trace_id: str, batch_time: datetime, outcomes: DataFrame | None = None) -> DataFrame:
    """Result row of a landing batch from its counts and the outcomes of its write (`sources.batch_sink`).

    Without outcomes the write is all or nothing: it raises, and the batch is run again, or
    every item and every write batch of it has succeeded.
    """
    counts = counts.withColumns({"trace_id": F.lit(trace_id), "timestamp": F.lit(batch_time)})
    none = F.lit(0).cast("long")
    if outcomes is None:
        batches = F.ceil(F.col("unique_count") / F.lit(WRITE_BATCH))
        return status.batch_status(counts.withColumns({
            "total_items": F.col("unique_count"), "success_items": F.col("unique_count"), "failed_items": none,
            "batch_count": batches, "success_batches": batches, "failed_batches": none,
        }))
    written = upsert_stats(outcomes, ["trace_id", "batch_no"], F.col("error").isNotNull(), ["trace_id"])
    names = [n for n in written.columns if n != "trace_id"]
    joined = counts.join(written, "trace_id", "left")  # no row where nothing was to be written
    return status.batch_status(joined.withColumns({n: F.coalesce(n, none) for n in names}))


def texts_to_embed(papers: DataFrame) -> DataFrame:
    """All papers as (trace_id, paper_id, text, paper_reason); no text where a reason is given."""
    reason = quality.paper_reason(F.col("paper_id"), F.col("trace_id"), F.col("title"), F.col("abstract"))
    return papers.withColumn("paper_reason", reason).select(
        "trace_id", "paper_id", "paper_reason",
        F.when(F.col("paper_reason").isNull(), combine_title_abstract(F.col("title"), F.col("abstract"))).alias("text"),
    )


def embed_papers(
    papers: DataFrame, factory: embed.EncoderFactory = embed.letter_counts, model_version: str = "letter-counts",
    tasks: int | None = None,
) -> DataFrame:
    """Texts of papers with their embedding or their error, one row per paper.

    Invalid papers stay in, so that one pass gives the counts of every trace.
    """
    return embed.check_responses(embed.embed_texts(texts_to_embed(papers), factory, model_version, tasks=tasks))


def vector_row_reason() -> Column:
    """Reason for which the vector of an embedded row would not be stored."""
    return quality.vector_reason(
        F.col("paper_id"), F.lit(records.VECTOR_TYPE), F.col("embedding"), F.col("dimension"),
        F.col("model_version"), F.col("trace_id"),
    )


def vectorization_results(embedded: DataFrame, run_ms: Column | None = None) -> DataFrame:
    """One row per trace of `embed_papers`: status, counters, rates and throughput.

    `run_ms` is the wall time of the run; without it the times of the rows are summed.

    A row counts as stored when it has no error and its vector record is valid. A trace
    without any paper to embed is complete with zero papers.
    """
    wanted = F.col("paper_reason").isNull()
    done = F.col("error_code").isNull()
    valid = vector_row_reason().isNull()
    none = F.lit(None).cast("string")
    counts = embedded.groupBy("trace_id").agg(
        F.count_if(wanted).alias("total_papers"),
        F.count_if(done).alias("embeddings_generated"),
        F.count_if(done & valid).alias("vectors_stored"),
        F.count_if(wanted & ~done).alias("failed_embeddings"),
        F.count_if(done & ~valid).alias("failed_storage"),
        (F.sum("processing_time_ms") if run_ms is None else run_ms).alias("processing_time_ms"),
    ).withColumns({"retrieval_error": none, "storage_error": none})
    return status.success_rates(status.vector_status(counts)).withColumn(
        "throughput_per_second", status.throughput_per_second(F.col("vectors_stored"), F.col("processing_time_ms"))
    ).drop("retrieval_error", "storage_error")


def store_embedded(
    vectors: KeyedTable, embedded: DataFrame, run_ms: int, name: str | None = None, unique: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Store the vectors of embedded papers; returns (results per trace, dead letters).

    `embedded` is read for each of them, so it has to be a written table: the encoder must
    not run per branch. Vectors are put by key, so a repeated run gives the same ones.
    `unique` says that no paper comes twice.
    """
    ready = records.vector_records(embedded.where(F.col("error_code").isNull()))
    rejected = store_vectors(vectors, ready, quality.record_reason(), name, unique).select(
        F.col("processing_info.trace_id").alias("trace_id"), "paper_id", "reason"
    )
    failed = embedded.where(F.col("error_code").isNotNull() & F.col("paper_reason").isNull()).select(
        "trace_id", "paper_id", F.concat_ws(": ", "error_code", "error_message").alias("reason")
    )
    letters = dead_letters(failed, "embedding_generation").unionByName(dead_letters(rejected, "vector_storage"))
    return vectorization_results(embedded, F.lit(max(1, run_ms)).cast("long")), letters
