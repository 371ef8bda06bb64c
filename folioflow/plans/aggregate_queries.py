"""Registered queries: deduplication, status, joins, monitoring and retention."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from folioflow.functions.timestamps import rfc3339
from folioflow.operators import alerts, batches, dedup, embed, joins, monitor, quality, retention, status
from folioflow.plans import views
from folioflow.plans.registry import query, with_views
from folioflow.plans.views import PAPERS, RUN_LOG, SQL_STRIP, VECTORS
from folioflow.plans.scalar_queries import VECTOR_REASON
from folioflow.session import materialize, scratch_dir
from folioflow.sources import batch_sink
from folioflow.sources.tables import KeyedTable
from folioflow.streaming import open_traces

NOW = "2024-01-20 12:00:00"
TODAY = "2024-01-20"
LATER = "2024-06-30"
FIRST = """first_rows AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY record_no) AS rn FROM papers) WHERE rn = 1)"""


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def with_day(df):
    return df.withColumn("day", F.col("day").cast("string"))


# -- deduplication and batches -----------------------------------------------------------

@query("w1_first_per_key", with_views(
    "SELECT record_no, paper_id, source, trace_id FROM first_rows", PAPERS, FIRST))
def w1(spark, sf):
    p = views.papers(spark, sf).select("record_no", "paper_id", "source", "trace_id")
    return dedup.deduplicate(p, F.col("record_no"))


@query("a1_dedup_stats", with_views("""
SELECT count(*) AS original_count, count(DISTINCT nullif(blank_id, '')) AS unique_count,
  count(*) - count(DISTINCT nullif(blank_id, '')) - count(*) FILTER (blank_id = '') AS duplicate_count,
  count(*) FILTER (blank_id = '') AS invalid_count FROM papers""", PAPERS))
def a1(spark, sf):
    return dedup.dedup_stats(views.papers(spark, sf, blank_keys=True))


@query("a21_dedup_analysis", with_views("""
SELECT trace_id, count(*) AS before_count, count(DISTINCT nullif(blank_id, '')) AS after_count,
  count(*) FILTER (blank_id <> '') - count(DISTINCT nullif(blank_id, '')) AS duplicate_count,
  count(*) FILTER (blank_id = '') AS invalid_count,
  round(100.0::DOUBLE * (count(*) FILTER (blank_id <> '') - count(DISTINCT nullif(blank_id, ''))) / count(*), 6) AS duplicate_rate
FROM papers GROUP BY trace_id""", PAPERS))
def a21(spark, sf):
    return rounded(dedup.dedup_analysis(views.papers(spark, sf, blank_keys=True), ["trace_id"]), "duplicate_rate")


@query("a21_dedup_analysis_by_day", with_views("""
SELECT CAST(published_date AS VARCHAR) AS day, count(*) AS before_count, count(DISTINCT paper_id) AS after_count,
  count(*) - count(DISTINCT paper_id) AS duplicate_count FROM papers GROUP BY published_date""", PAPERS))
def a21_day(spark, sf):
    return dedup.dedup_analysis(views.papers(spark, sf), ["published_date"]).select(
        F.col("published_date").cast("string").alias("day"), "before_count", "after_count", "duplicate_count")


BATCHED = """batched AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY record_no) - 1) // 25 AS batch_no FROM first_rows)"""


@query("w2_batch_number", with_views("SELECT record_no, source, batch_no FROM batched", PAPERS, FIRST, BATCHED))
def w2(spark, sf):
    first = dedup.deduplicate(views.papers(spark, sf).select("record_no", "paper_id", "source"), F.col("record_no"))
    return batches.with_batch_no(first, "source", "record_no").select("record_no", "source", "batch_no")


UPSERT_COLUMNS = """CAST(sum(n) AS BIGINT) AS total_items,
  CAST(coalesce(sum(n) FILTER (NOT failed), 0) AS BIGINT) AS success_items,
  CAST(coalesce(sum(n) FILTER (failed), 0) AS BIGINT) AS failed_items, count(*) AS batch_count,
  count(*) FILTER (NOT failed) AS success_batches, count(*) FILTER (failed) AS failed_batches"""
WRITE_BATCHES = f"""numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY label ORDER BY CAST(paper_id AS BIGINT)) - 1) // 25 AS batch_no FROM vectors),
write_batches AS (SELECT label, batch_no, count(*) AS n, bool_or(({VECTOR_REASON}) IS NOT NULL) AS failed FROM numbered GROUP BY ALL)"""


def _vectors_to_write(spark, sf):
    """All vectors, some of which break a rule of the store, in the order of their numbers within a label."""
    return views.vectors(spark, sf).withColumns({"record_no": F.col("paper_id").cast("long"), "label": F.col("label").cast("string")})


def _vector_reason():
    return quality.vector_reason(*(F.col(c) for c in ("paper_id", "vector_type", "embedding", "dimension", "model_version", "trace_id")))


@query("a2_upsert_stats", with_views(f"SELECT {UPSERT_COLUMNS} FROM write_batches", VECTORS, WRITE_BATCHES))
def a2(spark, sf):
    """A table that refuses batches with a bad record; a record has failed if the table doesn't hold it afterwards."""
    rows = _vectors_to_write(spark, sf).select(
        "record_no", "label", "paper_id", "vector_type", "embedding", "dimension", "model_version", "trace_id")
    table = KeyedTable(spark, scratch_dir(spark, "batch-vectors"), rows.schema, ["paper_id", "vector_type"])
    outcomes = batch_sink.put_batches(table, rows, _vector_reason(), "label", "record_no")
    held = table.read().select(*table.keys, F.lit(True).alias("held"))
    written = outcomes.select(*table.keys, "label", "batch_no").join(held, table.keys, "left")
    return batches.upsert_stats(written, ["label", "batch_no"], F.col("held").isNull())


def strict_client():
    """A client that stores a batch whole or raises, and leaves rows over when it is first called."""
    calls = iter(range(1 << 62))

    def put(rows):
        reasons = [r for r in rows["reason"].to_pylist() if r is not None]
        if reasons:
            raise ValueError(reasons[0])
        return [rows.num_rows - 1] if next(calls) == 0 and rows.num_rows > 1 else None

    return put


@query("k4_upsert_with_stats", with_views(
    f"SELECT CAST(label AS VARCHAR) AS label, {UPSERT_COLUMNS} FROM write_batches GROUP BY label", VECTORS, WRITE_BATCHES))
def k4(spark, sf):
    """The same through a client, which gets the records in batches of 25 and refuses those with a bad one."""
    rows = _vectors_to_write(spark, sf).select("record_no", "label", "paper_id", _vector_reason().alias("reason"))
    outcomes = batch_sink.send_batches(rows, strict_client, "label", "record_no")
    return batches.upsert_stats(outcomes, ["label", "batch_no"], F.col("error").isNotNull(), ["label"])


# -- status ------------------------------------------------------------------------------

COUNTERS = """counters AS (
  SELECT p.trace_id, count(*) AS total_papers, count(l.doc_id) AS embeddings_generated,
         count(*) FILTER (l.quality = 1 AND l.toxic = 0) AS vectors_stored,
         count(*) FILTER (l.quality = 0 AND l.toxic = 0) AS hidden,
         max(CASE WHEN n_chars > 20000 THEN 'cannot read ' || lpad(CAST(record_no AS VARCHAR), 12, '0') END) AS file_error
  FROM papers p LEFT JOIN labels l ON p.record_no = l.doc_id GROUP BY p.trace_id)"""


def _counters(spark, sf):
    p = views.papers(spark, sf)
    marks = views.table(spark, sf, "labels").withColumnRenamed("doc_id", "record_no")
    clean = F.col("toxic") == 0
    return p.join(marks, "record_no", "left").groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("total_papers"),
        F.count("quality").alias("embeddings_generated"),
        F.count_if((F.col("quality") == 1) & clean).alias("vectors_stored"),
        F.count_if((F.col("quality") == 0) & clean).alias("hidden"),
        F.max(F.when(F.col("n_chars") > 20_000, F.concat(
            F.lit("cannot read "), F.lpad(F.col("record_no").cast("string"), 12, "0")))).alias("file_error"),
    )


@query("a3_batch_status", with_views("""
SELECT trace_id, success_items AS processed_count,
  CASE WHEN file_error IS NOT NULL AND success_items = 0 THEN 'failed'
       WHEN file_error IS NOT NULL OR failed_items > 0 THEN 'partial_success' ELSE 'success' END AS status,
  CASE WHEN failed_items > 0 THEN CAST(failed_items AS VARCHAR) || ' items failed to upsert' ELSE file_error END AS error_message
FROM (SELECT *, CASE WHEN hidden % 2 = 0 THEN 0 ELSE total_papers - hidden END AS success_items,
             CASE WHEN hidden % 3 = 0 THEN 0 ELSE hidden END AS failed_items FROM counters)""", PAPERS, COUNTERS))
def a3(spark, sf):
    hidden = F.col("hidden")
    c = _counters(spark, sf).withColumns({
        "success_items": F.when(hidden % 2 == 0, 0).otherwise(F.col("total_papers") - hidden),
        "failed_items": F.when(hidden % 3 == 0, 0).otherwise(hidden),
    })
    return status.batch_status(c).select("trace_id", "processed_count", "status", "error_message")


VECTOR_COUNTERS = """vector_counters AS (
  SELECT trace_id, CASE WHEN hidden % 7 = 0 THEN 0 ELSE total_papers END AS total_papers,
         CASE WHEN hidden % 5 = 0 THEN 0 ELSE embeddings_generated END AS embeddings_generated,
         CASE WHEN hidden % 3 = 0 THEN 0 ELSE vectors_stored END AS vectors_stored,
         CASE WHEN hidden % 2 = 0 THEN 0 ELSE total_papers - embeddings_generated END AS failed_embeddings,
         CASE WHEN hidden % 2 = 0 THEN 0 ELSE embeddings_generated - vectors_stored END AS failed_storage,
         CASE WHEN hidden % 11 = 0 THEN file_error END AS retrieval_error,
         CASE WHEN hidden % 13 = 0 THEN file_error END AS storage_error, hidden
  FROM counters)"""


def _vector_counters(spark, sf):
    hidden, c = F.col("hidden"), _counters(spark, sf)
    none = F.lit(None).cast("string")
    return c.select(
        "trace_id", "hidden",
        F.when(hidden % 7 == 0, 0).otherwise(F.col("total_papers")).alias("total_papers"),
        F.when(hidden % 5 == 0, 0).otherwise(F.col("embeddings_generated")).alias("embeddings_generated"),
        F.when(hidden % 3 == 0, 0).otherwise(F.col("vectors_stored")).alias("vectors_stored"),
        F.when(hidden % 2 == 0, 0).otherwise(F.col("total_papers") - F.col("embeddings_generated")).alias(
            "failed_embeddings"),
        F.when(hidden % 2 == 0, 0).otherwise(F.col("embeddings_generated") - F.col("vectors_stored")).alias(
            "failed_storage"),
        F.when(hidden % 11 == 0, F.col("file_error")).otherwise(none).alias("retrieval_error"),
        F.when(hidden % 13 == 0, F.col("file_error")).otherwise(none).alias("storage_error"),
    )


A4 = """SELECT trace_id,
  CASE WHEN retrieval_error IS NOT NULL THEN 'failed' WHEN total_papers = 0 THEN 'completed'
       WHEN embeddings_generated = 0 OR storage_error IS NOT NULL THEN 'failed'
       WHEN failed_embeddings = 0 AND failed_storage = 0 THEN 'completed'
       WHEN vectors_stored > 0 THEN 'partial_success' ELSE 'failed' END AS status,
  CASE WHEN retrieval_error IS NOT NULL THEN
         'data_retrieval: failed to retrieve papers for vectorization (caused by: ' || retrieval_error || ')'
       WHEN total_papers = 0 THEN NULL
       WHEN embeddings_generated = 0 THEN 'embedding_generation: no embeddings were generated successfully'
       WHEN storage_error IS NOT NULL THEN 'vector_storage: failed to store vector records (caused by: ' || storage_error || ')'
       WHEN (failed_embeddings = 0 AND failed_storage = 0) OR vectors_stored > 0 THEN NULL
       ELSE 'all vectorization operations failed' END AS error_message
FROM vector_counters"""


@query("a4_vectorization_status", with_views(A4, PAPERS, COUNTERS, VECTOR_COUNTERS))
def a4(spark, sf):
    return status.vector_status(_vector_counters(spark, sf)).select("trace_id", "status", "error_message")


@query("st7_stopped_flows", with_views(
    f"SELECT trace_id, error_message FROM ({A4}) WHERE status = 'failed'", PAPERS, COUNTERS, VECTOR_COUNTERS))
def st7(spark, sf):
    results = status.vector_status(_vector_counters(spark, sf))
    return alerts.stopped_flows(results).select("trace_id", "error_message")


@query("a5_success_rates", with_views("""
SELECT trace_id, round(100.0::DOUBLE * embeddings_generated / nullif(total_papers, 0), 6) AS embedding_success_rate,
  round(100.0::DOUBLE * vectors_stored / nullif(embeddings_generated, 0), 6) AS storage_success_rate,
  round(100.0::DOUBLE * vectors_stored / nullif(total_papers, 0), 6) AS overall_success_rate
FROM vector_counters""", PAPERS, COUNTERS, VECTOR_COUNTERS))
def a5(spark, sf):
    rates = ["embedding_success_rate", "storage_success_rate", "overall_success_rate"]
    return rounded(status.success_rates(_vector_counters(spark, sf)), *rates).select("trace_id", *rates)


@query("a6_throughput", with_views("""
SELECT event_id, round(data_count / nullif(duration_ms / 1000.0::DOUBLE, 0), 6) AS per_second FROM run_log""", RUN_LOG))
def a6(spark, sf):
    rate = status.throughput_per_second(F.col("data_count"), F.col("duration_ms"))
    return views.run_log(spark, sf).select("event_id", F.round(rate, 6).alias("per_second"))


# -- joins -------------------------------------------------------------------------------

def _labelled(spark, sf):
    return views.table(spark, sf, "labels").select(F.col("doc_id").alias("record_no"))


@query("j1_pending_backlog", with_views(
    "SELECT record_no, trace_id FROM papers WHERE record_no NOT IN (SELECT doc_id FROM labels)", PAPERS))
def j1(spark, sf):
    return joins.pending_backlog(views.papers(spark, sf), _labelled(spark, sf), "record_no").select(
        "record_no", "trace_id")


@query("j2_trace_coverage", with_views("""
SELECT trace_id, count(*) AS papers, count(l.doc_id) AS vectors, count(*) - count(l.doc_id) AS missing
FROM papers p LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON p.record_no = l.doc_id GROUP BY trace_id""", PAPERS))
def j2(spark, sf):
    return joins.trace_coverage(views.papers(spark, sf), _labelled(spark, sf), "record_no")


@query("j3_end_to_end_latency", with_views("""
SELECT CAST(day AS VARCHAR) AS day, count(*) AS traces, round(avg(latency), 6) AS avg_latency_ms FROM (
  SELECT trace_id, CAST(min(ts) FILTER (event = 'processing_start') AS DATE) AS day,
    CAST(floor((epoch_us(max(ts) FILTER (event = 'processing_complete'))
         - epoch_us(min(ts) FILTER (event = 'processing_start'))) / 1000) AS BIGINT) AS latency
  FROM run_log GROUP BY trace_id) WHERE latency >= 0 GROUP BY day""", RUN_LOG))
def j3(spark, sf):
    return with_day(rounded(monitor.end_to_end_latency(views.run_log(spark, sf)), "avg_latency_ms"))


@query("j4_retry_set", with_views("""
SELECT DISTINCT trace_id, record_no FROM papers
WHERE record_no NOT IN (SELECT doc_id FROM labels) OR record_no IN (SELECT doc_id FROM labels WHERE toxic = 1)""", PAPERS))
def j4(spark, sf):
    failed = views.table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("record_no"))
    return joins.retry_set(views.papers(spark, sf), _labelled(spark, sf), failed, key="record_no")


@query("j4_retry_after_success", with_views("""
SELECT DISTINCT trace_id, record_no FROM papers WHERE record_no NOT IN (SELECT doc_id FROM labels)
  OR record_no IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id % 5 <= doc_id % 3)""", PAPERS))
def j4_success(spark, sf):
    """Dead letters with a later vector are settled; hour of failure and of the vector are made from the id."""
    hour = lambda n: F.timestamp_seconds(F.col("doc_id") % n * 3600)
    labels = views.table(spark, sf, "labels")
    vectors = labels.select(F.col("doc_id").alias("record_no"), hour(5).alias("at"))
    failed = labels.where("toxic = 1").select(F.col("doc_id").alias("record_no"), hour(3).alias("failed_at"))
    return joins.retry_set(views.papers(spark, sf), vectors, failed, key="record_no", stored_at=F.col("at"))


@query("w4_latest_per_trace", with_views("""
SELECT trace_id, event_id, event FROM (
  SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY ts DESC, event_id DESC) AS rn FROM run_log) WHERE rn = 1""", RUN_LOG))
def w4(spark, sf):
    log = views.run_log(spark, sf).select("trace_id", "ts", "event_id", "event")
    return joins.latest_per_trace(log, ["ts", "event_id"]).select("trace_id", "event_id", "event")


# -- monitoring --------------------------------------------------------------------------

@query("a7_embedding_stats", with_views("""
SELECT count(*) AS request_count, coalesce(CAST(trunc(avg(duration_ms)) AS BIGINT), 0) AS average_processing_time_ms
FROM run_log WHERE service = 'embedding-api' AND error_code IS NULL""", RUN_LOG))
def a7(spark, sf):
    return monitor.embedding_stats(views.run_log(spark, sf).where(F.col("service") == "embedding-api"))


@query("a8_errors_by_class", with_views("""
SELECT error_code, count(*) AS errors,
  CAST(CASE error_code WHEN 'VALIDATION_ERROR' THEN 400 WHEN 'MODEL_LOAD_ERROR' THEN 503 ELSE 500 END AS INTEGER) AS status_code
FROM run_log WHERE error_code IS NOT NULL GROUP BY error_code""", RUN_LOG))
def a8(spark, sf):
    return monitor.errors_by_class(views.run_log(spark, sf))


@query("a9_retrieval_stats", with_views("""
SELECT trace_id, count(*) AS retrieved, count(*) FILTER (NOT bad) AS valid, count(*) FILTER (bad) AS invalid,
  count(*) FILTER (title = '' AND abstract = '') AS without_text
FROM (SELECT trace_id, t AS title, a AS abstract, blank_id = '' OR (t = '' AND a = '') AS bad
      FROM (SELECT *, CASE WHEN record_no % 59 = 0 THEN '' ELSE title END AS t,
                   CASE WHEN record_no % 59 = 0 THEN '' ELSE abstract END AS a FROM papers))
GROUP BY trace_id""", PAPERS))
def a9(spark, sf):
    gone = F.col("record_no") % 59 == 0
    p = views.papers(spark, sf, blank_keys=True).withColumns({
        c: F.when(gone, "").otherwise(F.col(c)) for c in ("title", "abstract")})
    reason = quality.paper_reason(F.col("paper_id"), F.col("trace_id"), F.col("title"), F.col("abstract"))
    return monitor.retrieval_stats(p, reason, ["trace_id"])


@query("a9_mean_query_time", with_views("""
SELECT count(*) AS queries, round(avg(duration_ms), 6) AS avg_query_ms FROM run_log
WHERE service = 'vector-coordinator' AND event = 'metrics'""", RUN_LOG))
def a9_time(spark, sf):
    return views.run_log(spark, sf).where(
        (F.col("service") == "vector-coordinator") & (F.col("event") == "metrics")
    ).agg(F.count(F.lit(1)).alias("queries"), F.round(F.avg("duration_ms"), 6).alias("avg_query_ms"))


@query("a10_source_profile", with_views("""
SELECT source, lang AS category, count(*) AS papers, CAST(min(published_date) AS VARCHAR) AS first_published,
  CAST(max(published_date) AS VARCHAR) AS last_published FROM papers GROUP BY source, lang""", PAPERS))
def a10(spark, sf):
    return monitor.source_profile(views.papers(spark, sf)).withColumns({
        c: F.col(c).cast("string") for c in ("first_published", "last_published")})


@query("a11_stage_counts", with_views("""
SELECT service, event, level, coalesce(error_code, 'none') AS error_type, count(*) AS events
FROM run_log GROUP BY ALL""", RUN_LOG))
def a11(spark, sf):
    return monitor.stage_counts(views.run_log(spark, sf))


@query("a12_daily_volume", with_views("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(sum(data_count) AS BIGINT) AS papers
FROM run_log WHERE event = 'data_parsing' GROUP BY CAST(ts AS DATE)""", RUN_LOG))
def a12(spark, sf):
    return with_day(monitor.daily_volume(views.run_log(spark, sf)))


@query("a13_daily_rates", with_views("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, coalesce(service, 'all') AS service, count(*) AS events,
  count(*) FILTER (level = 'ERROR') AS errors,
  round(100.0::DOUBLE * count(*) FILTER (level = 'ERROR') / count(*), 6) AS error_rate,
  round(100.0::DOUBLE * count(*) FILTER (level <> 'ERROR') / count(*), 6) AS success_rate
FROM run_log GROUP BY GROUPING SETS ((CAST(ts AS DATE)), (CAST(ts AS DATE), service))""", RUN_LOG))
def a13(spark, sf):
    return with_day(rounded(monitor.daily_rates(views.run_log(spark, sf)), "error_rate", "success_rate"))


@query("a14_daily_durations", with_views("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, coalesce(service, 'all') AS service, count(*) AS events,
  round(avg(duration_ms), 6) AS avg_ms, round(quantile_cont(CAST(duration_ms AS DOUBLE), 0.95), 6) AS p95_ms
FROM run_log GROUP BY GROUPING SETS ((CAST(ts AS DATE)), (CAST(ts AS DATE), service))""", RUN_LOG))
def a14(spark, sf):
    return with_day(rounded(monitor.daily_durations(views.run_log(spark, sf)), "avg_ms", "p95_ms"))


@query("a15_today_counts", with_views(f"""
SELECT CAST(coalesce(sum(data_count) FILTER (service = 'data-collector'), 0) AS BIGINT) AS collected_today,
  CAST(coalesce(sum(data_count) FILTER (service = 'vector-coordinator'), 0) AS BIGINT) AS vectorized_today
FROM run_log WHERE event = 'data_parsing' AND CAST(ts AS DATE) = DATE '{TODAY}'""", RUN_LOG))
def a15(spark, sf):
    return monitor.today_counts(views.run_log(spark, sf), TODAY)


SPANS = """spans AS (
  SELECT trace_id, min(ts) FILTER (event = 'processing_start') AS started_at,
    max(ts) FILTER (event = 'processing_complete') AS completed_at, min(ts) AS first_at, max(ts) AS last_at,
    count(*) FILTER (event = 'error') AS errors FROM run_log GROUP BY trace_id)"""


@query("a16_active_traces", with_views("""
SELECT CAST(CAST(started_at AS DATE) AS VARCHAR) AS day, count(*) AS active_traces FROM spans
WHERE started_at IS NOT NULL AND completed_at IS NULL GROUP BY CAST(started_at AS DATE)""", RUN_LOG, SPANS))
def a16(spark, sf):
    return with_day(monitor.active_traces(views.run_log(spark, sf)))


def _followed(spark, sf):
    """A finished run of the stream that keeps the traces; later reports read its state and not the log."""
    checkpoint = scratch_dir(spark, "trace-state")
    open_traces.follow_traces(views.as_run_log(views.events_stream(spark, sf)), checkpoint).awaitTermination()
    return open_traces.open_spans(spark, checkpoint)


@query("a16_active_traces_state", with_views("""
SELECT CAST(CAST(started_at AS DATE) AS VARCHAR) AS day, count(*) AS active_traces FROM spans
WHERE started_at IS NOT NULL AND completed_at IS NULL GROUP BY CAST(started_at AS DATE)""", RUN_LOG, SPANS))
def a16_state(spark, sf):
    return with_day(monitor.active_by_day(_followed(spark, sf)))


@query("a17_storage_growth", with_views("""
SELECT CAST(day AS VARCHAR) AS day, bytes, bytes - lag(bytes) OVER (ORDER BY day) AS change,
  round(avg(bytes) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg
FROM (SELECT published_date AS day, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM papers GROUP BY 1)""", PAPERS))
def a17(spark, sf):
    daily = monitor.daily_bytes(views.papers(spark, sf), F.col("published_date"), F.octet_length("text"))
    return with_day(rounded(monitor.growth(daily, "bytes"), "moving_avg"))


@query("w3_growth_by_service", with_views("""
SELECT CAST(day AS VARCHAR) AS day, service, papers,
  papers - lag(papers) OVER (PARTITION BY service ORDER BY day) AS change,
  round(avg(papers) OVER (PARTITION BY service ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg
FROM (SELECT CAST(ts AS DATE) AS day, service, CAST(sum(data_count) AS BIGINT) AS papers FROM run_log GROUP BY 1, 2)""", RUN_LOG))
def w3(spark, sf):
    daily = views.run_log(spark, sf).groupBy(F.to_date("ts").alias("day"), "service").agg(
        F.sum("data_count").alias("papers"))
    return with_day(rounded(monitor.growth(daily, "papers", ["service"]), "moving_avg"))


@query("a18_daily_retries", with_views("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, service, count(*) FILTER (attempt > 1) AS retries
FROM run_log GROUP BY CAST(ts AS DATE), service""", RUN_LOG))
def a18(spark, sf):
    return with_day(monitor.daily_retries(views.run_log(spark, sf)))


MEMORY = """memory AS (
  SELECT CAST(ts AS DATE) AS day, service, avg(data_count) AS avg_memory_percent,
         CAST(max(data_count) AS DOUBLE) AS max_memory_percent FROM run_log GROUP BY 1, 2)"""


@query("a19_daily_memory", with_views("""
SELECT CAST(day AS VARCHAR) AS day, service, round(avg_memory_percent, 6) AS avg_memory_percent, max_memory_percent
FROM memory""", RUN_LOG, MEMORY))
def a19(spark, sf):
    return with_day(rounded(monitor.daily_memory(views.run_log(spark, sf), F.col("data_count")), "avg_memory_percent"))


# Memory limits of the services in MB.
MEMORY_LIMITS_MB = {
    "data-collector": 128, "batch-processor": 256, "vector-coordinator": 256, "embedding-api": 512,
}


@query("a19_memory_against_limits", with_views("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, service, round(avg(share), 6) AS avg_memory_percent,
  round(max(share), 6) AS max_memory_percent
FROM (SELECT ts, service, 100.0::DOUBLE * data_count / CASE service WHEN 'data-collector' THEN 128
        WHEN 'embedding-api' THEN 512 ELSE 256 END AS share FROM run_log)
GROUP BY CAST(ts AS DATE), service""", RUN_LOG))
def a19_limits(spark, sf):
    used = monitor.daily_memory(views.run_log(spark, sf), F.col("data_count"), MEMORY_LIMITS_MB)
    return with_day(rounded(used, "avg_memory_percent", "max_memory_percent"))


@query("a20_validation_errors", with_views("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  count(*) FILTER (level = 'ERROR' AND error_code = 'VALIDATION_ERROR') AS validation_errors
FROM run_log GROUP BY CAST(ts AS DATE)""", RUN_LOG))
def a20(spark, sf):
    return with_day(monitor.daily_validation_errors(views.run_log(spark, sf)))


@query("a20_daily_rejects", with_views("""
SELECT CAST(published_date AS VARCHAR) AS day, 'paper_id is empty' AS reason, count(*) AS rejected
FROM papers WHERE blank_id = '' GROUP BY published_date""", PAPERS))
def a20_rejects(spark, sf):
    reason = quality.paper_reason(F.col("paper_id"), F.col("trace_id"), F.col("title"), F.col("abstract"))
    p = views.papers(spark, sf, blank_keys=True)
    return with_day(monitor.daily_rejects(p, F.col("published_date"), reason))


@query("a22_daily_writes", with_views("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, service, count(*) AS writes, count(*) FILTER (level = 'ERROR') AS failures,
  round(100.0::DOUBLE * count(*) FILTER (level <> 'ERROR') / count(*), 6) AS success_rate
FROM run_log WHERE service IN ('batch-processor', 'vector-coordinator') GROUP BY CAST(ts AS DATE), service""", RUN_LOG))
def a22(spark, sf):
    return with_day(rounded(monitor.daily_writes(views.run_log(spark, sf)), "success_rate"))


@query("a23_trace_outcome", with_views("""
SELECT count(*) FILTER (completed_at IS NOT NULL AND errors = 0) AS completed_traces,
  count(*) FILTER (errors > 0) AS failed_traces,
  round(avg(CAST(floor((epoch_us(last_at) - epoch_us(first_at)) / 1000) AS BIGINT))
        FILTER (completed_at IS NOT NULL AND errors = 0), 6) AS avg_duration_ms FROM spans""", RUN_LOG, SPANS))
def a23(spark, sf):
    return rounded(monitor.trace_outcome(views.run_log(spark, sf)), "avg_duration_ms")


@query("t2_recent_incidents", with_views(f"""
SELECT event_id, level, service, trace_id FROM run_log WHERE level IN ('ERROR', 'WARN')
  AND ts > TIMESTAMP '{NOW}' - INTERVAL 24 HOURS AND ts <= TIMESTAMP '{NOW}'
ORDER BY ts DESC, event_id""", RUN_LOG))
def t2(spark, sf):
    return monitor.recent_incidents(views.run_log(spark, sf), NOW).select("event_id", "level", "service", "trace_id")


# -- alerts ------------------------------------------------------------------------------

def _window_sql(value: str, threshold: int) -> str:
    return f"""SELECT strftime(w, '%Y-%m-%dT%H:%M:%SZ') AS window_start, service, total FROM (
      SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS w, service, {value} AS total FROM run_log GROUP BY 1, 2)
    WHERE total > {threshold}"""


def _window_rows(df):
    return df.select(rfc3339(F.col("window_start")).alias("window_start"), "service", "total")


ERRORS = "CAST(count(*) FILTER (level = 'ERROR') AS BIGINT)"
WRITES = "CAST(sum(CASE WHEN event = 'data_parsing' THEN data_count ELSE 0 END) AS BIGINT)"
THROTTLES = "CAST(count(*) FILTER (error_code = 'INTERNAL_ERROR') AS BIGINT)"


def _units():
    return F.when(F.col("event") == "data_parsing", F.col("data_count")).otherwise(0)


def _throttled():
    return F.col("error_code") == "INTERNAL_ERROR"


@query("st4_error_alarm", with_views(_window_sql(ERRORS, 5), RUN_LOG))
def st4(spark, sf):
    return _window_rows(alerts.error_alarm(views.run_log(spark, sf)))


@query("st4_error_windows_above_one", with_views(_window_sql(ERRORS, 1), RUN_LOG))
def st4_low(spark, sf):
    return _window_rows(alerts.error_alarm(views.run_log(spark, sf), threshold=1))


@query("st5_write_volume_alarm", with_views(_window_sql(WRITES, 80), RUN_LOG))
def st5(spark, sf):
    return _window_rows(alerts.write_volume_alarm(views.run_log(spark, sf), _units()))


@query("st8_throttling_alarm", with_views(_window_sql(THROTTLES, 10), RUN_LOG))
def st8(spark, sf):
    return _window_rows(alerts.throttling_alarm(views.run_log(spark, sf), _throttled()))


@query("st8_throttled_windows_above_zero", with_views(_window_sql(THROTTLES, 0), RUN_LOG))
def st8_low(spark, sf):
    return _window_rows(alerts.throttling_alarm(views.run_log(spark, sf), _throttled(), threshold=0))


STALLED = f"""SELECT trace_id, started_at FROM spans
WHERE started_at < TIMESTAMP '{NOW}' - INTERVAL 30 MINUTES AND completed_at IS NULL"""


@query("st6_stalled_traces", with_views(
    f"SELECT trace_id, strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') AS started_at FROM ({STALLED})", RUN_LOG, SPANS))
def st6(spark, sf):
    return alerts.stalled_traces(views.run_log(spark, sf), NOW).select(
        "trace_id", rfc3339(F.col("started_at")).alias("started_at"))


@query("st6_stalled_traces_state", with_views(
    f"SELECT trace_id, strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') AS started_at FROM ({STALLED})", RUN_LOG, SPANS))
def st6_state(spark, sf):
    return alerts.stalled(_followed(spark, sf), NOW).select("trace_id", rfc3339(F.col("started_at")).alias("started_at"))


RATES = """SELECT CAST(ts AS DATE) AS day, service, 100.0::DOUBLE * count(*) FILTER (level <> 'ERROR') / count(*) AS rate
FROM run_log GROUP BY 1, 2"""


@query("st9_success_rate_alarm", with_views(f"""
SELECT CAST(day AS VARCHAR) AS day, service, round(rate, 6) AS success_rate,
  CASE WHEN rate < 80 THEN 'critical' ELSE 'warning' END AS severity FROM ({RATES}) WHERE rate < 95""", RUN_LOG))
def st9(spark, sf):
    return with_day(rounded(alerts.success_rate_alarm(views.run_log(spark, sf)), "success_rate"))


@query("st10_memory_alarm", with_views("""
SELECT CAST(day AS VARCHAR) AS day, service, round(avg_memory_percent, 6) AS avg_memory_percent, max_memory_percent
FROM memory WHERE avg_memory_percent > 80""", RUN_LOG, MEMORY))
def st10(spark, sf):
    return with_day(rounded(alerts.memory_alarm(views.run_log(spark, sf), F.col("data_count")), "avg_memory_percent"))


@query("st10_memory_above_half", with_views("""
SELECT CAST(day AS VARCHAR) AS day, service, round(avg_memory_percent, 6) AS avg_memory_percent, max_memory_percent
FROM memory WHERE avg_memory_percent > 50""", RUN_LOG, MEMORY))
def st10_low(spark, sf):
    return with_day(rounded(
        alerts.memory_alarm(views.run_log(spark, sf), F.col("data_count"), threshold=50.0), "avg_memory_percent"))


BOUNDS = """bounds AS (
  SELECT trace_id, batch_order, rate, avg(rate) OVER w AS mean_rate, stddev_samp(rate) OVER w AS sd_rate FROM (
    SELECT trace_id, min(record_no) AS batch_order, 100.0::DOUBLE *
      (count(*) FILTER (blank_id <> '') - count(DISTINCT nullif(blank_id, ''))) / count(*) AS rate
    FROM papers GROUP BY trace_id)
  WINDOW w AS (ORDER BY batch_order ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))"""
OUTSIDE = "coalesce(rate < mean_rate - 3 * sd_rate OR rate > mean_rate + 3 * sd_rate, false)"


@query("st11_dedup_rate_warning", with_views(f"""
SELECT trace_id, round(rate, 6) AS duplicate_rate, round(mean_rate, 6) AS mean_rate, round(sd_rate, 6) AS sd_rate,
  {OUTSIDE} AS outside FROM bounds""", PAPERS, BOUNDS))
def st11(spark, sf):
    bounds = alerts.dedup_rate_bounds(views.papers(spark, sf, blank_keys=True), "record_no")
    return rounded(bounds, "duplicate_rate", "mean_rate", "sd_rate").drop("batch_order")


SUMMARY = f"""SELECT severity, alert, count(*) AS active_alerts FROM (
  SELECT 'critical' AS severity, 'errors' AS alert FROM ({_window_sql(ERRORS, 5)})
  UNION ALL SELECT 'critical', 'write_volume' FROM ({_window_sql(WRITES, 80)})
  UNION ALL SELECT 'critical', 'throttling' FROM ({_window_sql(THROTTLES, 10)})
  UNION ALL SELECT 'critical', 'stalled_trace' FROM ({STALLED})
  UNION ALL SELECT CASE WHEN rate < 80 THEN 'critical' ELSE 'warning' END, 'success_rate' FROM ({RATES}) WHERE rate < 95
  UNION ALL SELECT 'critical', 'stopped_flow' FROM ({A4}) WHERE status = 'failed'
  UNION ALL SELECT 'warning', 'memory' FROM memory WHERE avg_memory_percent > 80
  UNION ALL SELECT 'warning', 'dedup_rate' FROM bounds WHERE {OUTSIDE}
) GROUP BY severity, alert"""


@query("st12_alert_summary", with_views(
    SUMMARY, PAPERS, RUN_LOG, SPANS, MEMORY, BOUNDS, COUNTERS, VECTOR_COUNTERS))
def st12(spark, sf):
    log, none = views.run_log(spark, sf), F.lit(None)
    service, day = F.col("service"), F.col("day")
    totals = materialize(alerts.window_totals(log, _units(), _throttled(), F.col("data_count")), "window-totals")
    days = alerts.day_totals(totals)
    return alerts.alert_summary([
        alerts.window_alarms(totals),
        alerts.alert_rows(
            alerts.stalled_traces(log, NOW), "stalled_trace", alerts.CRITICAL, none, F.col("started_at"), none,
            alerts.MAX_OPEN_MINUTES),
        alerts.alert_rows(
            alerts.low_success(days), "success_rate", F.col("severity"), service, day, F.col("success_rate"),
            F.when(F.col("severity") == alerts.CRITICAL, 80).otherwise(95)),
        alerts.alert_rows(
            alerts.stopped_flows(status.vector_status(_vector_counters(spark, sf))), "stopped_flow", alerts.CRITICAL,
            none, none, none, none),
        alerts.alert_rows(
            days.where(F.col("avg_memory_percent") > alerts.MAX_MEMORY_PERCENT), "memory", alerts.WARNING, service, day,
            F.col("avg_memory_percent"), alerts.MAX_MEMORY_PERCENT),
        alerts.alert_rows(
            alerts.dedup_rate_bounds(views.papers(spark, sf, blank_keys=True), "record_no").where("outside"),
            "dedup_rate", alerts.WARNING, none, none, F.col("duplicate_rate"), F.col("mean_rate")),
    ])


# -- retention ---------------------------------------------------------------------------

@query("r1_tier_plan", with_views(f"""
SELECT CAST(published_date AS VARCHAR) AS day, count(*) AS objects, CAST(sum(strlen(text)) AS BIGINT) AS bytes,
  CASE WHEN DATE '{LATER}' - published_date >= 90 THEN 'archive'
       WHEN DATE '{LATER}' - published_date >= 30 THEN 'infrequent' ELSE 'standard' END AS tier
FROM papers GROUP BY published_date""", PAPERS))
def r1(spark, sf):
    return with_day(retention.tier_plan(
        views.papers(spark, sf), F.col("published_date"), F.octet_length("text"), LATER))


@query("r2_log_retention", with_views(
    "SELECT event_id FROM run_log WHERE CAST(ts AS DATE) >= DATE '2024-02-10' - 30", RUN_LOG))
def r2(spark, sf):
    """The log as a store of days, after the expired days were deleted from it."""
    log, path = views.run_log(spark, sf), scratch_dir(spark, "log-store")
    retention.store_logs(log, path)
    retention.drop_expired(spark, path, "2024-02-10")
    return retention.read_logs(spark, path, log.schema).select("event_id")


@query("r2_retained_logs", with_views(
    "SELECT event_id FROM run_log WHERE CAST(ts AS DATE) >= DATE '2024-02-10' - 30", RUN_LOG))
def r2_view(spark, sf):
    """The same as a filter, for logs that lie elsewhere."""
    return retention.retained_logs(views.run_log(spark, sf), "2024-02-10").select("event_id")


# -- embedding ---------------------------------------------------------------------------

LETTERS = [chr(97 + i) for i in range(26)]
# Whole texts; one above the limits of a call in pieces, averaged by length.
STRIPPED = f"SELECT doc_id, trim(text, {SQL_STRIP}) AS t FROM documents"


def pooled_counts(letters, source: str) -> str:
    """The columns of `source` but its text `t`, and counts: for each letter the mean over the pieces, weighted by length."""
    counted = ", ".join(f"list_sum([length(p) * (length(p) - length(replace(p, '{c}', ''))) FOR p IN pieces]) / length(t)::DOUBLE" for c in letters)
    return f"""SELECT * EXCLUDE (t, pieces), CAST([{counted}] AS DOUBLE[]) AS counts FROM (
      SELECT *, CASE WHEN strlen(t) <= 10000 AND length(t) <= 8192 THEN [t]
                ELSE [substr(t, 1 + 2500 * k, 2500) FOR k IN range(0, (length(t) + 2499) // 2500)] END AS pieces
      FROM ({source}))"""


def u1_sql() -> str:
    shown = ", ".join(f"round(counts[{i + 1}] / greatest(norm, 1e-12), 6) AS {c}" for i, c in enumerate(LETTERS))
    return f"""SELECT doc_id, CAST(26 AS INTEGER) AS dimension, {shown} FROM (
  SELECT *, sqrt(list_sum([v * v FOR v IN counts])) AS norm FROM ({pooled_counts(LETTERS, STRIPPED)}))"""


@query("u1_embed_texts", u1_sql())
def u1(spark, sf):
    texts = views.table(spark, sf, "documents").select("doc_id", "text")
    e = embed.embed_texts(texts)
    return e.select(
        "doc_id", "dimension", *[F.round(F.get("embedding", F.lit(i)), 6).alias(c) for i, c in enumerate(LETTERS)])


def u2_sql() -> str:
    shown = ", ".join(f"round(counts[{i + 1}], 6) AS {c}" for i, c in enumerate("aeiou"))
    return f"SELECT doc_id, 'vowels-1' AS model_version, CAST(5 AS INTEGER) AS dimension, {shown} FROM ({pooled_counts('aeiou', STRIPPED)})"


@query("u2_encoder_plug_in", u2_sql())
def u2(spark, sf):
    """Another encoder with its own dimension and version, and without normalization."""
    texts = views.table(spark, sf, "documents").select("doc_id", "text")
    e = embed.embed_texts(texts, partial(embed.letter_counts, "aeiou"), "vowels-1", normalize=False)
    return e.select(
        "doc_id", "model_version", "dimension",
        *[F.round(F.get("embedding", F.lit(i)), 6).alias(c) for i, c in enumerate("aeiou")])
