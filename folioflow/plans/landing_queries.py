"""Registered queries: sources, sinks, upserts, streams and the whole run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.functions.timestamps import rfc3339
from folioflow.operators import alerts, dedup, joins, quality, records
from folioflow.operators.embed import letter_counts
from folioflow.plans import jobs, views
from folioflow.plans.aggregate_queries import FIRST, LETTERS, pooled_counts
from folioflow.plans.registry import query, with_views
from folioflow.plans.scalar_queries import COMBINED, FEED, VECTOR_REASON
from folioflow.plans.views import LANDED, PAPERS, RUN_LOG, SQL_STRIP, VECTORS
from folioflow.session import scratch_dir
from folioflow.sources import feeds, landing, run_log
from folioflow.sources.tables import KeyedTable, dead_letters, store_vectors
from folioflow.streaming import alarms
from folioflow.streaming import landing as stream

BATCH_TIME = datetime(2024, 1, 20, 12, 0, 0, tzinfo=timezone.utc)
#: Bytes of text in a file that a query writes as a whole, about.
FILE_BYTES = 16 << 20
#: Bytes around the text of an element.
AROUND = 128
FIELDS = "record_no, element_no, paper_id, source, title, abstract, published_date, n_authors, category"


def _landed_files(spark, sf, name):
    """The JSON lines of the papers as gzip landing files in a new folder.

    Folders per source, as the landing write has them: a plain write may leave an empty
    first file, and a file without any paper is an error.
    """
    path = scratch_dir(spark, name)
    lines = views.landing_lines(spark, sf).select("collect_source", "value")
    lines.write.partitionBy("collect_source").option("compression", "gzip").text(path)
    return path


def _landed_json(papers, name):
    """Papers as gzip JSON lines in folders per source."""
    path = scratch_dir(papers.sparkSession, name)
    rows = papers.withColumn("collect_source", F.col("source"))
    rows.write.partitionBy("collect_source").option("compression", "gzip").json(path)
    return path


def _bucketed(rows, key, text):
    """Adds `bucket`, the file a row goes to, and gives the number of buckets: as many as keep a file near FILE_BYTES."""
    total = rows.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + AROUND)).first()[0] or 0
    n = max(1, -(-total // FILE_BYTES))
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(n))), n


def _plain(papers, *more):
    """Normalized papers in columns that compare well."""
    return papers.select(
        *more, "paper_id", "source", "title", "abstract", "published_date",
        F.size("authors").alias("n_authors"), F.try_element_at("categories", F.lit(1)).alias("category"),
    )


def _numbered(landed):
    """Usable records with the number of their paper, and 1 for the second of an envelope."""
    good = landed.where("record is not null and record_error is null").select(
        "record", F.from_json("record", "record_no long, title string").alias("_m")
    ).select("record", "_m.record_no", F.col("_m.title").isNull().cast("int").alias("element_no"))
    return _plain(records.normalize_records(good, keep=("record_no", "element_no")), "record_no", "element_no")


# -- sources -----------------------------------------------------------------------------

@query("s1_feed_scan", with_views("""
SELECT 'https://papers.example.org/abs/' || CAST(record_no AS VARCHAR) || 'v1' AS id,
  '[' || lang || ']' AS title, source || ' ' || CAST(n_chars AS VARCHAR) AS summary,
  chr(8195) || 'A. ' || lang || '|' || source || chr(160) AS authors, lang || '|' || source AS terms,
  CASE lang WHEN 'es' THEN 0 WHEN 'de' THEN 1 ELSE 3 END AS links FROM papers""", PAPERS))
def s1(spark, sf):
    p = views.papers(spark, sf).select(
        "record_no", F.concat(F.lit("["), "lang", F.lit("]")).alias("title"),
        F.concat_ws(" ", "source", F.col("n_chars").cast("string")).alias("summary"))
    entries = views.feed_entries(spark, sf).drop("title", "summary").join(p, "record_no")
    path = scratch_dir(spark, "feed")
    (
        entries.select(*schemas.FEED_ENTRY.fieldNames()).write.format("xml")
        .option("rootTag", "feed").option("rowTag", "entry").save(path)
    )
    return feeds.read_feed(spark, path).select(
        "id", "title", "summary", F.array_join("author.name", "|").alias("authors"),
        F.array_join("category._term", "|").alias("terms"),
        F.coalesce(F.size("link"), F.lit(0)).alias("links"),
    )


@query("s1_feed_errors", """SELECT 'good' AS feed, count(*) AS entries, CAST(0 AS BIGINT) AS errors FROM documents
UNION ALL SELECT 'malformed', 0, 1""")
def s1_errors(spark, sf):
    """A feed of all documents in files of bounded size, and the file of document 7 again with an entry that does not close."""
    path = scratch_dir(spark, "feeds")
    docs, n = _bucketed(views.table(spark, sf, "documents").select("doc_id"), F.col("doc_id"), F.lit(""))
    entry = F.concat(F.lit("<entry><id>"), "doc_id", F.lit("</id></entry>"))
    broken = F.when(F.col("doc_id") == 7, F.lit("<entry><id>7</entry>")).otherwise(entry)
    malformed = docs.filter(F.col("bucket") == F.pmod(F.xxhash64(F.lit(7).cast("bigint")), F.lit(n)))
    for name, rows, column in (("good", docs, entry), ("malformed", malformed, broken)):
        lines = rows.select("bucket", column.alias("e")).groupBy("bucket").agg(F.concat(F.lit("<feed>"), F.array_join(F.collect_list("e"), "\n"), F.lit("</feed>")).alias("value"))
        lines.write.partitionBy("bucket").text(f"{path}/feed={name}")
    files = f"{path}/*/*/*.txt"
    read = feeds.read_feed(spark, files).agg(F.count("id").alias("entries"))
    bad = feeds.feed_errors(spark, files).select(F.regexp_extract("file_path", "feed=([^/]*)/", 1).alias("feed"))
    good = read.select(F.lit("good").alias("feed"), "entries", F.lit(0).cast("long").alias("errors"))
    return good.unionByName(bad.groupBy("feed").agg(F.lit(0).cast("long").alias("entries"), F.count(F.lit(1)).alias("errors")))


@query("s2_landing_scan", "SELECT doc_id, text, source FROM documents")
def s2(spark, sf):
    docs = views.table(spark, sf, "documents")
    path = _landed_json(docs.select(F.col("doc_id").cast("string").alias("paper_id"), "text", "source"), "landing")
    return landing.read_landing(spark, path).select(
        F.from_json("record", "paper_id string, text string, source string").alias("r")
    ).select(F.col("r.paper_id").cast("long").alias("doc_id"), "r.text", "r.source")


@query("s3_multi_shape_parse", with_views("""
SELECT outcome, count(*) AS records FROM (
  SELECT 'ok' AS outcome FROM landed
  UNION ALL SELECT 'json_parsing' FROM lines WHERE broken
  UNION ALL SELECT 'data_conversion' FROM lines WHERE NOT broken AND kind = 2) GROUP BY outcome""", LANDED))
def s3(spark, sf):
    landed = landing.read_landing(spark, _landed_files(spark, sf, "shapes"))
    return landed.groupBy(
        F.coalesce("file_error", "record_error", F.lit("ok")).alias("outcome")
    ).agg(F.count(F.lit(1)).alias("records"))


@query("s4_envelope_explode", with_views("""
SELECT record_no, element_no, 'feed' AS envelope_source, paper_id || 'v' || (element_no + 1) AS paper_id
FROM papers, (VALUES (CAST(0 AS BIGINT)), (CAST(1 AS BIGINT))) v(element_no)""", PAPERS))
def s4(spark, sf):
    paper = lambda v: F.struct(F.concat("paper_id", F.lit(v)).alias("id"))
    envelopes = views.papers(spark, sf).select("record_no", F.to_json(F.struct(
        F.array(paper("v1"), paper("v2")).alias("papers"), F.lit("feed").alias("source"), F.lit(2).alias("count"),
    )).alias("record")).withColumnRenamed("record_no", "envelope_no")
    exploded = records.explode_envelopes(envelopes, keep=("envelope_no",))
    return records.normalize_records(exploded, keep=("envelope_no", "record_no", "envelope_source")).select(
        F.col("envelope_no").alias("record_no"), F.col("record_no").alias("element_no"), "envelope_source", "paper_id")


@query("s5_run_log_scan", with_views("""
SELECT service, level, event, coalesce(error_code, 'none') AS error_code, count(*) AS lines,
  CAST(sum(duration_ms) AS BIGINT) AS duration_ms, CAST(sum(data_count) AS BIGINT) AS data_count,
  CAST(sum(attempt) AS BIGINT) AS attempts, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS last_at
FROM run_log GROUP BY ALL""", RUN_LOG))
def s5(spark, sf):
    path = scratch_dir(spark, "log")
    log = views.run_log(spark, sf)
    log.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"), "level",
        F.col("event").alias("message"), "service", "trace_id", "duration_ms", "data_count",
        F.when(F.col("error_code").isNotNull(), F.struct(
            F.lit("API_ERROR").alias("type"), F.lit("failed").alias("message"), F.col("error_code").alias("code"),
        )).alias("error"),
        F.struct("event", "attempt").alias("metadata"),
    ).write.json(path)
    return run_log.log_events(run_log.read_run_log(spark, path)).groupBy(
        "service", "level", "event", F.coalesce("error_code", F.lit("none")).alias("error_code")
    ).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("duration_ms").alias("duration_ms"),
        F.sum("data_count").alias("data_count"), F.sum("attempt").alias("attempts"),
        rfc3339(F.max("ts")).alias("last_at"),
    )


@query("f6_record_normalize", with_views(f"SELECT {FIELDS} FROM landed", LANDED))
def f6(spark, sf):
    landed = landing.read_landing(spark, _landed_files(spark, sf, "records"))
    return _numbered(landed)


@query("f7_batch_stamp", with_views("""
SELECT record_no, 'trace-1' AS trace_id, '2024-01-20T12:00:00Z' AS batch_timestamp, 'processed' AS processing_status,
  true AS same_time FROM papers""", PAPERS))
def f7(spark, sf):
    papers = views.papers(spark, sf).drop("trace_id", "batch_timestamp")
    return records.stamp_batch(papers, "trace-1", BATCH_TIME).select(
        "record_no", "trace_id", rfc3339(F.col("batch_timestamp")).alias("batch_timestamp"), "processing_status",
        (F.col("created_at") == F.col("updated_at")).alias("same_time"))


@query("p1_key_required", with_views("""
SELECT record_no, 'missing or invalid paper_id' AS reason FROM lines WHERE kind = 2 AND NOT broken""", LANDED))
def p1(spark, sf):
    lines = views.landing_lines(spark, sf).where(~F.col("value").startswith('{"papers"'))
    envelopes = views.landing_lines(spark, sf).where(F.col("value").startswith('{"papers"'))
    single = lines.select("record_no", F.col("value").alias("record"))
    of_envelopes = records.explode_envelopes(
        envelopes.withColumnsRenamed({"record_no": "envelope_no", "value": "record"})
        .where(~F.col("record").endswith(" junk")), keep=("envelope_no",),
    ).select(F.col("envelope_no").alias("record_no"), "record")
    keyed = records.normalize_records(
        single.where(~F.col("record").endswith(" junk")).unionByName(of_envelopes), keep=("record_no",))
    return keyed.select("record_no", quality.key_reason(F.col("paper_id")).alias("reason")).where("reason is not null")


@query("p7_landing_filter", "SELECT count(*) AS records FROM documents")
def p7(spark, sf):
    """Only `.gz` files under the folder count; the same rows as plain files do not."""
    path = scratch_dir(spark, "raw-data")
    docs = views.table(spark, sf, "documents").select(F.md5("text").alias("paper_id"), "source")
    docs.write.option("compression", "gzip").json(f"{path}/zipped")
    docs.write.json(f"{path}/plain")
    return landing.read_landing(spark, path).agg(F.count("record").alias("records"))


@query("u_all_union_files", with_views(
    "SELECT source, count(*) AS papers FROM papers GROUP BY source", PAPERS))
def u_all(spark, sf):
    """Two landing folders of one batch, read apart and put together."""
    p = views.papers(spark, sf).select("paper_id", "source", "title")
    parts = []
    for name, rows in (("english", F.col("lang") == "en"), ("other", F.col("lang") != "en")):
        path = _landed_json(views.papers(spark, sf).where(rows).select(*p.columns), name)
        parts.append(landing.read_landing(spark, path))
    return records.normalize_records(dedup.union_batches(*parts)).groupBy("source").agg(
        F.count(F.lit(1)).alias("papers"))


# -- sinks -------------------------------------------------------------------------------

def _collected(spark, sf):
    return views.papers(spark, sf).select(
        F.col("paper_id").alias("id"), "source", "title", "abstract", "categories",
        F.lit(BATCH_TIME).alias("collected_at"))


@query("k1_gzip_landing_write", with_views(
    "SELECT paper_id, source, title, abstract, lang AS category, '2024-01-20' AS folder FROM papers", PAPERS))
def k1(spark, sf):
    path = scratch_dir(spark, "raw-data")
    landing.write_landing(_collected(spark, sf), path)
    landed = landing.read_landing(spark, path).withColumn(
        "folder", F.regexp_extract("file_path", "collect_date=([^/]*)/", 1))
    return records.normalize_records(landed, keep=("folder",)).select(
        "paper_id", "source", "title", "abstract", F.element_at("categories", 1).alias("category"), "folder")


@query("k2_upload_stats", with_views(
    """SELECT source, count(*) AS papers, CAST(sum(2 + 1 + strlen(to_json(paper_id)) + strlen(to_json(source)) + strlen(to_json(title))
         + strlen(to_json(abstract)) + strlen(to_json([lang])) + strlen('"id":,"source":,"title":,"abstract":,"categories":') - 1 + 1) AS BIGINT) AS original_bytes,
         true AS has_files, true AS is_ratio FROM papers GROUP BY source""", PAPERS))
def k2(spark, sf):
    path, papers = scratch_dir(spark, "raw-data"), _collected(spark, sf)
    landing.write_landing(papers, path)
    return landing.upload_stats(papers.drop("collected_at"), path).select(
        "source", "papers", "original_bytes", ((F.col("files") > 0) & (F.col("compressed_bytes") > 0)).alias("has_files"),
        (F.abs(F.col("compression_ratio") * F.col("original_bytes") - F.col("compressed_bytes")) < 1e-3).alias("is_ratio"))


def _halves(spark, sf):
    """A stored collection (en, fr, de) and a new one (fr, de, es), first rows per key."""
    p = views.papers(spark, sf).select("record_no", "paper_id", "source", "title", "lang")
    stored = dedup.deduplicate(p.where(F.col("lang").isin("en", "fr", "de")), F.col("record_no"))
    fresh = dedup.deduplicate(p.where(F.col("lang").isin("fr", "de", "es")), -F.col("record_no"))
    return stored, fresh.withColumn("title", F.concat(F.lit("new "), "title"))


HALVES = """stored AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY record_no) AS rn
    FROM papers WHERE lang IN ('en', 'fr', 'de')) WHERE rn = 1),
fresh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY record_no DESC) AS rn
    FROM papers WHERE lang IN ('fr', 'de', 'es')) WHERE rn = 1)"""
UPSERT_SQL = """SELECT record_no, paper_id, source, 'new ' || title AS title, lang FROM fresh UNION ALL
SELECT record_no, paper_id, source, title, lang FROM stored WHERE paper_id NOT IN (SELECT paper_id FROM fresh)"""


@query("k3_upsert_frame", with_views(UPSERT_SQL, PAPERS, HALVES))
def k3_frame(spark, sf):
    stored, fresh = _halves(spark, sf)
    return joins.upsert_frame(stored, fresh, ["paper_id"])


@query("k3_paper_upsert", with_views(UPSERT_SQL, PAPERS, HALVES))
def k3(spark, sf):
    """The same through a stored table; the second run of the batch changes nothing."""
    stored, fresh = _halves(spark, sf)
    table = KeyedTable(spark, scratch_dir(spark, "papers"), stored.schema, ["paper_id"])
    table.upsert(stored)
    table.upsert(fresh)
    table.upsert(fresh)
    return table.read()


def _stored_vectors(spark, sf):
    v = views.vectors(spark, sf).withColumns({
        "text": F.concat(F.lit("text "), "paper_id"), "processing_time_ms": F.col("label").cast("long")})
    declared = v.select("paper_id", "dimension")
    ready = records.vector_records(v, F.col("created_at")).join(declared, "paper_id").withColumn(
        "embedding_metadata", F.col("embedding_metadata").withField("dimension", F.col("dimension"))
    ).drop("dimension")
    table = KeyedTable(spark, scratch_dir(spark, "vectors"), schemas.VECTOR_RECORD, ["paper_id", "vector_type"])
    rejected = store_vectors(table, ready, quality.record_reason())
    return table, rejected


@query("k5_vector_upsert", with_views(f"""
SELECT paper_id, vector_type, model_version, trace_id, round(embedding[1], 6) AS first_value
FROM vectors WHERE ({VECTOR_REASON}) IS NULL""", VECTORS))
def k5(spark, sf):
    table, _ = _stored_vectors(spark, sf)
    return table.read().select(
        "paper_id", "vector_type", F.col("embedding_metadata.model_version").alias("model_version"),
        F.col("processing_info.trace_id").alias("trace_id"), F.round(F.element_at("embedding", 1), 6).alias("first_value"))


@query("k6_write_if_absent", with_views("SELECT count(*) AS papers, 'first' AS run FROM papers", PAPERS))
def k6(spark, sf):
    path = scratch_dir(spark, "once")
    p = views.papers(spark, sf).select("paper_id")
    for run in ("first", "second"):
        landing.write_if_absent(p.withColumn("run", F.lit(run)), path)
    return spark.read.parquet(path).groupBy("run").agg(F.count(F.lit(1)).alias("papers"))


@query("k7_dead_letters", with_views(f"""
SELECT 'vector_storage' AS stage, trace_id, paper_id, {VECTOR_REASON} AS reason FROM vectors
WHERE ({VECTOR_REASON}) IS NOT NULL""", VECTORS))
def k7(spark, sf):
    _, rejected = _stored_vectors(spark, sf)
    path = scratch_dir(spark, "dead-letters")
    dead_letters(rejected.withColumn("trace_id", F.col("processing_info.trace_id")), "vector_storage").write.parquet(path)
    return spark.read.parquet(path).drop("failed_at")


# -- streams -----------------------------------------------------------------------------

@query("st1_landing_stream", with_views(f"SELECT {FIELDS} FROM landed", LANDED))
def st1(spark, sf):
    source = _landed_files(spark, sf, "stream-in")
    out, checkpoint = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-state")
    alarms.run_to_table(stream.landing_stream(spark, source), out, checkpoint)
    return _numbered(spark.read.parquet(out))


def _run_stream(spark, sf, vectorize):
    source, checkpoint = _landed_files(spark, sf, "stream-in"), scratch_dir(spark, "stream-state")
    store = stream.Store(spark, scratch_dir(spark, "store"))
    stream.process_landing(
        spark, source, store, checkpoint, factory=letter_counts if vectorize else None).awaitTermination()
    return store


@query("st2_stream_papers", with_views(
    "SELECT DISTINCT paper_id, title, abstract, category IS NULL AS from_envelope FROM landed", LANDED))
def st2(spark, sf):
    return _run_stream(spark, sf, False).papers.read().select(
        "paper_id", "title", "abstract", (F.size("categories") == 0).alias("from_envelope"))


@query("st2_stream_batch_results", with_views("""
SELECT CAST(sum(n) AS BIGINT) AS original_count, count(*) AS unique_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
  'success' AS status,
  (SELECT count(*) FROM lines WHERE broken OR kind = 2) AS record_errors
FROM (SELECT paper_id, count(*) AS n FROM landed GROUP BY paper_id)""", LANDED))
def st2_results(spark, sf):
    return _run_stream(spark, sf, False).batch_results.read().groupBy("status").agg(
        *[F.sum(c).alias(c) for c in ("original_count", "unique_count", "duplicate_count", "record_errors")])


STREAM_VECTORS = with_views(
    f"""SELECT paper_id, text_length, round(counts[1] / greatest(norm, 1e-12), 6) AS a,
          round(counts[5] / greatest(norm, 1e-12), 6) AS e, round(counts[26] / greatest(norm, 1e-12), 6) AS z
        FROM (SELECT paper_id, text_length, counts, sqrt(list_sum([v * v FOR v IN counts])) AS norm
              FROM ({pooled_counts(LETTERS, f"SELECT paper_id, text_length, trim(text, {SQL_STRIP}) AS t FROM texts")}))""",
    LANDED, f"""texts AS (SELECT paper_id, text, CAST(strlen(text) AS INTEGER) AS text_length
            FROM (SELECT DISTINCT paper_id, {COMBINED} AS text FROM landed WHERE title <> '' OR abstract <> ''))""")


def _shown_vectors(store):
    parts = {"a": 0, "e": 4, "z": 25}
    return store.vectors.read().select(
        "paper_id", F.col("embedding_metadata.text_length").alias("text_length"),
        *[F.round(F.get("embedding", F.lit(i)), 6).alias(c) for c, i in parts.items()])


@query("st3_stream_vectors", STREAM_VECTORS)
def st3(spark, sf):
    return _shown_vectors(_run_stream(spark, sf, True))


def _fails_on_the():
    """An encoder that takes no text with `the` in it."""
    encode = letter_counts()

    def some(texts):
        if any("the" in t for t in texts):
            raise ValueError("cannot encode")
        return encode(texts)

    return some


def _two_runs(spark, sf):
    """A first run whose encoder fails for some papers, and a second one over what is left."""
    source, checkpoint = _landed_files(spark, sf, "stream-in"), scratch_dir(spark, "stream-state")
    store = stream.Store(spark, scratch_dir(spark, "store"))
    stream.process_landing(spark, source, store, checkpoint, factory=_fails_on_the).awaitTermination()
    stream.revectorize(store, stream.trace_of_batch("landing", 0), letter_counts, "letter-counts", attempt="second")
    return store


@query("st3_rerun_vectors", STREAM_VECTORS)
def st3_rerun(spark, sf):
    return _shown_vectors(_two_runs(spark, sf))


RERUN_TEXTS = f"""texts AS (SELECT paper_id, text, trim(text, {SQL_STRIP}) AS t FROM (
  SELECT DISTINCT paper_id, {COMBINED} AS text FROM landed WHERE title <> '' OR abstract <> ''))"""


@query("w4_latest_vector_result", with_views("""
SELECT 'second' AS attempt, 'completed' AS status, count(*) AS total_papers, count(*) AS vectors_stored,
  CAST(0 AS BIGINT) AS failed_embeddings FROM texts WHERE contains(t, 'the')""", LANDED, RERUN_TEXTS))
def w4_results(spark, sf):
    """The state of the trace after both runs: the second handled what the first could not."""
    return joins.latest_per_trace(_two_runs(spark, sf).vector_results.read(), ["finished_at"]).select(
        "attempt", "status", "total_papers", "vectors_stored", "failed_embeddings")


@query("s2_bad_files", "SELECT file, outcome, count(*) AS records FROM (" + """
  SELECT 'good' AS file, 'ok' AS outcome FROM documents
  UNION ALL SELECT * FROM (VALUES ('cut', 'file error'), ('corrupt', 'file error'))) GROUP BY ALL""")
def s2_bad_files(spark, sf):
    """A cut and a corrupt file beside the good ones: an error row each, and no record is lost.

    The good files are of bounded size. The bad ones are the first one's bytes, changed.
    """
    docs = views.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("paper_id"), "text")
    path = scratch_dir(spark, "good-files")
    rows, _ = _bucketed(docs, F.col("paper_id"), F.col("text"))
    rows.repartition("bucket").write.partitionBy("bucket").option("compression", "gzip").json(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(path)
    first = files.agg(F.min("path")).first()[0]
    good, cut, corrupt = (F.struct(F.lit(n).alias("name"), c.alias("body")) for n, c in {
        "good": F.col("content"),
        "cut": F.substring(F.col("content"), F.lit(1), F.octet_length("content") - 10),
        "corrupt": F.concat(F.lit(b"\x1f\x8b"), F.substring(F.col("content"), 11, 100_000)),
    }.items())
    named = F.explode(F.when(F.col("path") == first, F.array(good, cut, corrupt)).otherwise(F.array(good)))
    rows = files.select("modificationTime", F.xxhash64("path").alias("file"), named.alias("v")).select(
        F.concat("v.name", F.lit("."), "file", F.lit(".gz")).alias("path"), "modificationTime", F.col("v.body").alias("content"))
    outcome = F.when(F.col("file_error").isNotNull(), "file error").otherwise(F.coalesce("record_error", F.lit("ok")))
    return landing.decode_files(rows).groupBy(
        F.substring_index("file_path", ".", 1).alias("file"), outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("records"))


def _whole_files(spark, sf, name, record):
    """All papers of the table in gzip files of bounded size, each of them one JSON text."""
    path = scratch_dir(spark, name)
    papers, _ = _bucketed(views.papers(spark, sf).select("paper_id", "title", "record_no"), F.col("record_no"), F.col("title"))
    texts = papers.groupBy("bucket").agg(F.to_json(record(F.collect_list(F.struct("paper_id", "title", "record_no")))).alias("value"))
    texts.write.partitionBy("bucket").option("compression", "gzip").text(path)
    return landing.read_landing(spark, path).select(F.from_json("record", "paper_id string, title string, record_no long").alias("r")).select("r.*")


WHOLE_FILES = with_views("SELECT paper_id, title, record_no FROM papers", PAPERS)


@query("s3_array_files", WHOLE_FILES)
def s3_array(spark, sf):
    return _whole_files(spark, sf, "array", lambda papers: papers)


@query("s4_envelope_files", WHOLE_FILES)
def s4_envelope(spark, sf):
    return _whole_files(spark, sf, "envelope", lambda papers: F.struct(papers.alias("papers"), F.lit("feed").alias("source")))


@query("k5_last_write_in_batch", with_views("""
SELECT paper_id, record_no FROM (SELECT paper_id, record_no, row_number() OVER (PARTITION BY paper_id ORDER BY record_no DESC) AS rn
FROM papers) WHERE rn = 1""", PAPERS))
def k5_last(spark, sf):
    """One upsert whose rows repeat keys: the last row of a key stays."""
    rows = views.papers(spark, sf).select("paper_id", "record_no").orderBy("record_no")
    table = KeyedTable(spark, scratch_dir(spark, "last-write"), rows.schema, ["paper_id"])
    table.upsert(rows)
    return table.read()


CLOSED = """closed AS (SELECT * FROM run_log, (SELECT max(ts) - INTERVAL 10 MINUTES AS mark FROM run_log))"""


def _log_stream(spark, sf):
    return views.as_run_log(views.events_stream(spark, sf))


@query("st4_error_alarm_stream", with_views("""
SELECT strftime(w, '%Y-%m-%dT%H:%M:%SZ') AS window_start, service, total FROM (
  SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS w, service, max(mark) AS mark,
    CAST(count(*) FILTER (level = 'ERROR') AS BIGINT) AS total FROM closed GROUP BY 1, 2)
WHERE total > 1 AND w + INTERVAL 5 MINUTES <= mark""", RUN_LOG, CLOSED))
def st4_stream(spark, sf):
    """Windows that the watermark has closed; the last ones stay open in the stream."""
    out, checkpoint = scratch_dir(spark, "alarm"), scratch_dir(spark, "alarm-state")
    alarms.run_to_table(alerts.error_alarm(_log_stream(spark, sf), threshold=1), out, checkpoint)
    return spark.read.parquet(out).select(rfc3339(F.col("window_start")).alias("window_start"), "service", "total")


@query("st6_stalled_traces_stream", with_views("""
SELECT s.trace_id, strftime(s.started_at, '%Y-%m-%dT%H:%M:%S.%g') AS started_at FROM (
  SELECT trace_id, ts AS started_at FROM run_log WHERE event = 'processing_start') s, marks
WHERE started_at + INTERVAL 31 MINUTES <= mark AND NOT EXISTS (
  SELECT 1 FROM run_log c WHERE c.event = 'processing_complete' AND c.trace_id = s.trace_id
    AND c.ts >= s.started_at AND c.ts <= s.started_at + INTERVAL 30 MINUTES)""", RUN_LOG, """marks AS (
  SELECT least(max(ts) FILTER (event = 'processing_start'), max(ts) FILTER (event = 'processing_complete'))
         - INTERVAL 10 MINUTES AS mark FROM run_log)"""))
def st6_stream(spark, sf):
    out, checkpoint = scratch_dir(spark, "stalled"), scratch_dir(spark, "stalled-state")
    alarms.run_to_table(alarms.stalled_trace_stream(_log_stream(spark, sf)), out, checkpoint)
    return spark.read.parquet(out).select(
        "trace_id", F.date_format("started_at", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("started_at"))


@query("e1_collect_feed", with_views("""
SELECT entry_id AS id, clean_title AS title, regexp_replace(published, '[.]?0*$', '') || 'Z' AS published_date, '2024-01-20' AS day
FROM entries WHERE published IS NOT NULL AND lang IN ('en', 'fr') AND published >= '2024-02-01' AND published < '2024-10-01'""", FEED))
def e1(spark, sf):
    """Feed entries to the papers in two categories, landed and read back."""
    papers = jobs.collect_feed(views.feed_entries(spark, sf), ["en", "fr"], "2024-02-01", "2024-09-30")
    path = scratch_dir(spark, "raw-data")
    landing.write_landing(papers.withColumn("collected_at", F.lit(BATCH_TIME)), path)
    landed = landing.read_landing(spark, path).withColumn(
        "day", F.regexp_extract("file_path", "collect_date=([^/]*)/", 1))
    return records.normalize_records(landed, keep=("day",)).select(
        F.col("paper_id").alias("id"), "title", "published_date", "day")


# -- the whole run -----------------------------------------------------------------------

def vectorize_traces(spark, sf):
    """Papers, first per key, embedded with the stand-in encoder: one status row per trace."""
    papers = dedup.deduplicate(
        views.papers(spark, sf).select("record_no", "paper_id", "trace_id", "title", "abstract"), F.col("record_no"))
    return jobs.vectorization_results(jobs.embed_papers(papers)).select(
        "trace_id", "status", "total_papers", "embeddings_generated", "vectors_stored", "failed_embeddings",
        "failed_storage", F.round("overall_success_rate", 6).alias("overall_success_rate"))


@query("e3_vectorize_traces", with_views("""
SELECT trace_id, CASE WHEN n = 0 OR ok = n THEN 'completed' WHEN ok > 0 THEN 'partial_success' ELSE 'failed' END AS status,
  n AS total_papers, ok AS embeddings_generated, ok AS vectors_stored, n - ok AS failed_embeddings,
  CAST(0 AS BIGINT) AS failed_storage, round(100.0::DOUBLE * ok / nullif(n, 0), 6) AS overall_success_rate
FROM (SELECT trace_id, count(*) FILTER (title <> '' OR abstract <> '') AS n, count(*) FILTER (
        (title <> '' OR abstract <> '') AND trim(""" + COMBINED + f""", {SQL_STRIP}) <> '') AS ok
      FROM first_rows GROUP BY trace_id)""", PAPERS, FIRST))
def e3(spark, sf):
    return vectorize_traces(spark, sf)
