"""Landing stream: new files start a batch, a batch ends in the papers and vectors tables."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from folioflow import schemas
from folioflow.operators import joins
from folioflow.operators.embed import EncoderFactory, letter_counts
from folioflow.plans import jobs
from folioflow.session import staged
from folioflow.sources import landing
from folioflow.sources.batch_sink import put_batches
from folioflow.sources.stored_files import contents
from folioflow.sources.tables import KeyedTable, dead_letters

FILES_PER_BATCH = 1_000

BATCH_RESULT = T.StructType([
    T.StructField("trace_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    *[T.StructField(n, T.LongType()) for n in (
        "processed_count", "original_count", "unique_count", "duplicate_count", "invalid_count",
        "total_items", "success_items", "failed_items", "batch_count", "success_batches", "failed_batches",
        "record_errors", "file_errors",
    )],
])
VECTOR_RESULT = T.StructType([
    T.StructField("trace_id", T.StringType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    *[T.StructField(n, T.LongType()) for n in (
        "total_papers", "embeddings_generated", "vectors_stored", "failed_embeddings", "failed_storage",
        "processing_time_ms",
    )],
    *[T.StructField(n, T.DoubleType()) for n in (
        "embedding_success_rate", "storage_success_rate", "overall_success_rate", "throughput_per_second",
    )],
])
DEAD_LETTER = T.StructType([
    *[T.StructField(n, T.StringType()) for n in ("stage", "trace_id", "paper_id", "reason")],
    T.StructField("failed_at", T.TimestampType()),
])


TRACE_KEY = T.StructType([T.StructField(n, T.StringType()) for n in ("trace_id", "paper_id")])


def _files(spark: SparkSession, path: str, glob: str, max_files: int) -> DataFrame:
    return contents(
        spark.readStream.format("binaryFile").schema(schemas.BINARY_FILE).option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).load(path)
    )


def landing_stream(
    spark: SparkSession, path: str, glob: str = landing.LANDING_GLOB, max_files: int = FILES_PER_BATCH
) -> DataFrame:
    """Records of new landing files as a stream, with the same rows as the batch scan."""
    return landing.decode_files(_files(spark, path, glob, max_files))


@dataclass
class Store:
    """The tables one landing stream writes.

    `paper_rule` is a reason column over papers (null = valid). Papers are then written in
    batches of 25, and one with a bad paper is refused as a whole: its items are failed ones
    of the batch result and dead letters.
    """

    spark: SparkSession
    path: str
    buckets: int | None = None
    paper_rule: Column | None = None

    def _table(self, name: str, schema: T.StructType, *keys: str, **layout) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.path}/{name}", schema, list(keys), buckets=self.buckets, **layout)

    @property
    def papers(self) -> KeyedTable:
        return self._table("papers", schemas.PAPER, "paper_id", sort_by=("source", "published_date"))

    @property
    def papers_by_trace(self) -> KeyedTable:
        """The index of the papers by trace, in buckets of the trace."""
        return self._table("papers_by_trace", TRACE_KEY, "trace_id", "paper_id", bucket_by=("trace_id",))

    def papers_of(self, trace_id: str, columns: list[str] | None = None) -> DataFrame:
        """The papers of a trace, by the index: its bucket there, and in `papers` the buckets of what it names.

        A paper that a later trace has taken over is named by both, and its row says whose it is.
        """
        named = self.papers_by_trace.get(trace_id=trace_id).select("paper_id")
        return self.papers.get_many(named, columns).where(F.col("trace_id") == trace_id)

    def compact(self) -> None:
        """Fold the puts of all tables; a job of its own, beside no running stream."""
        for table in (self.papers, self.papers_by_trace, self.vectors, self.batch_results, self.vector_results, self.dead_letters):
            table.compact()

    @property
    def vectors(self) -> KeyedTable:
        return self._table("vectors", schemas.VECTOR_RECORD, "paper_id", "vector_type", sort_by=("paper_id",), bucket_by=("paper_id",))

    @property
    def batch_results(self) -> KeyedTable:
        return self._table("batch_results", BATCH_RESULT, "trace_id")

    @property
    def vector_results(self) -> KeyedTable:
        """One row per trace and attempt; `operators.joins.latest_per_trace` by finished_at has the state of a trace."""
        return self._table("vector_results", VECTOR_RESULT, "trace_id", "attempt")

    @property
    def dead_letters(self) -> KeyedTable:
        """The last failure of a paper; it is settled by a later vector (`operators.joins.retry_set`)."""
        return self._table("dead_letters", DEAD_LETTER, "stage", "trace_id", "paper_id", bucket_by=("trace_id",))


def trace_of_batch(name: str, batch_id: int) -> str:
    """The trace id of a micro-batch; a retry of the batch gets the same one."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{name}/{batch_id}"))


def take_in(store: Store, landed: DataFrame, trace_id: str) -> None:
    """One batch of landed records: stamp, deduplicate within the batch, put papers and index, write the result.

    Every put carries the trace's name, so a repeated batch replaces its own rows.
    """
    now = datetime.now(timezone.utc)
    with staged(landed, "landed") as rows:
        papers, outcomes = jobs.clean_batch(rows, trace_id, now), None
        if store.paper_rule is None:
            store.papers.upsert(papers, trace_id)
        else:
            numbered = papers.withColumn("write_no", F.monotonically_increasing_id())
            outcomes = put_batches(store.papers, numbered, store.paper_rule, "trace_id", "write_no", name=trace_id)
            refused = outcomes.where(F.col("error").isNotNull()).withColumn("reason", F.col("error"))
            store.dead_letters.upsert(dead_letters(refused, "batch_upsert"), trace_id)
        store.papers_by_trace.upsert(_papers(store, trace_id).select("trace_id", "paper_id"), trace_id)
        store.batch_results.upsert(jobs.batch_result(jobs.batch_counts(rows), trace_id, now, outcomes), trace_id)


def _papers(store: Store, trace_id: str) -> DataFrame:
    """The papers of a trace: the files of its own put while they are there, else by the index."""
    own = store.papers.read_put(trace_id)
    return store.papers_of(trace_id) if own is None else own


def _vectorize(
    store: Store, papers: DataFrame, trace_id: str, factory: EncoderFactory, model_version: str,
    tasks: int | None, attempt: str | None,
) -> None:
    """`papers` have one row per key, as the papers table has. The text of one that failed is not written down."""
    started = time.monotonic()
    attempt = attempt or datetime.now(timezone.utc).isoformat()
    name = f"{trace_id} {attempt}"
    done = jobs.embed_papers(papers, factory, model_version, tasks).withColumn("text", F.when(F.col("error_code").isNull(), F.col("text")))
    with staged(done, "embedded") as embedded:
        run_ms = int((time.monotonic() - started) * 1000)
        results, letters = jobs.store_embedded(store.vectors, embedded, run_ms, name, unique=True)
        store.dead_letters.upsert(letters, name)
        store.vector_results.upsert(
            results.withColumns({"attempt": F.lit(attempt), "finished_at": F.current_timestamp()}), name)


def vectorize(
    store: Store, trace_id: str, factory: EncoderFactory, model_version: str, tasks: int | None = None,
    attempt: str | None = None,
) -> None:
    """The step a finished batch starts: embed all papers of the trace, store the vectors by key.

    It reads the rows that the batch has put, no other ones. A run gives what its papers
    give now: after a failure, or with another model, it may be run again, and its result is
    one more attempt.
    """
    _vectorize(store, _papers(store, trace_id), trace_id, factory, model_version, tasks, attempt)


def revectorize(
    store: Store, trace_id: str, factory: EncoderFactory, model_version: str, tasks: int | None = None,
    attempt: str | None = None,
) -> None:
    """The same for the papers of a trace that have no vector, or have failed since they got one.

    Which ones these are is told from keys and times; whole rows are read of these papers only.
    """
    papers = store.papers_of(trace_id, ["trace_id"])
    vectors = store.vectors.get_many(papers.select("paper_id"), ["processing_info"])
    todo = joins.retry_set(
        papers, vectors, store.dead_letters.get(trace_id=trace_id), stored_at=F.col("processing_info.created_at"))
    again = store.papers.get_many(todo.select("paper_id")).where(F.col("trace_id") == trace_id)
    _vectorize(store, again, trace_id, factory, model_version, tasks, attempt)


def process_landing(
    spark: SparkSession, path: str, store: Store, checkpoint: str, name: str = "landing",
    factory: EncoderFactory | None = letter_counts, model_version: str = "letter-counts",
    glob: str = landing.LANDING_GLOB, max_files: int = FILES_PER_BATCH, encoder_tasks: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run every new landing file through `take_in`, and `vectorize` when a factory is given.

    A micro-batch is decoded from the files the stream has read, whatever their names. All
    writes are by key, so a repeated batch gives the same rows. `trigger` has the
    arguments of `DataStreamWriter.trigger`; by default the stream ends with what is there.
    """

    def run(files: DataFrame, batch_id: int) -> None:
        if files.select("path").isEmpty():
            return
        trace_id = trace_of_batch(name, batch_id)
        take_in(store, landing.decode_files(files), trace_id)
        if factory is not None:
            vectorize(store, trace_id, factory, model_version, encoder_tasks, attempt=f"batch {batch_id}")

    return (
        _files(spark, path, glob, max_files).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).queryName(name).start()
    )
