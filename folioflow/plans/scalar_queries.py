"""Registered queries: column functions, validation and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions import text as X
from folioflow.functions import timestamps as TS
from folioflow.functions import vectors as V
from folioflow.operators import embed, lookup, quality, records
from folioflow.plans import views
from folioflow.plans.registry import query, with_views
from folioflow.plans.views import PAPERS, RUN_LOG, SQL_STRIP, SQL_WHITE_SPACE, VECTORS
from folioflow.session import scratch_dir
from folioflow.sources.tables import KeyedTable

# -- functions ---------------------------------------------------------------------------

FEED = PAPERS + f""",
entries AS (
  SELECT *, CAST(record_no AS VARCHAR) || 'v1' AS entry_id,
         CASE WHEN source IN ('src3', 'src5') THEN NULL
              WHEN source = 'src7' THEN CAST(published_date AS VARCHAR) || 'T12:34:56.250'
              ELSE CAST(published_date AS VARCHAR) || 'T12:34:56.000' END AS published,
         trim(title, {SQL_WHITE_SPACE}) AS clean_title, trim(abstract, {SQL_WHITE_SPACE}) AS clean_abstract,
         CASE WHEN lang IN ('es', 'de') THEN ''
              ELSE 'https://papers.example.org/abs/' || CAST(record_no AS VARCHAR) || 'v1' END AS url
  FROM papers)"""
MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"


@query("f1_entry_to_paper", with_views(
    """SELECT entry_id AS id, 'arxiv' AS source, clean_title AS title, clean_abstract AS abstract,
              'A. ' || lang || '|' || source AS authors, published AS published_date,
              lang || '|' || source AS categories, url
       FROM entries WHERE published IS NOT NULL""", FEED))
def f1(spark, sf):
    return records.entries_to_papers(views.feed_entries(spark, sf)).select(
        "id", "source", "title", "abstract", F.array_join("authors", "|").alias("authors"),
        F.date_format("published_date", MILLIS).alias("published_date"),
        F.array_join("categories", "|").alias("categories"), "url",
    )


@query("f2_id_from_url", "SELECT page_id, split_part(url, '/', -1) AS id FROM pages")
def f2(spark, sf):
    return views.table(spark, sf, "pages").select("page_id", X.last_path_segment(F.col("url")).alias("id"))


@query("f3_alternate_link", with_views("SELECT record_no, url FROM entries", FEED))
def f3(spark, sf):
    return views.feed_entries(spark, sf).select("record_no", records.alternate_link(F.col("link")).alias("url"))


@query("f4_unicode_trim", with_views(
    f"""SELECT record_no, trim(chr(160) || title || chr(12288) || chr(10), {SQL_WHITE_SPACE}) AS title,
               trim(abstract, {SQL_WHITE_SPACE}) AS abstract FROM papers""", PAPERS))
def f4(spark, sf):
    padded = F.concat(F.lit("\xa0"), F.col("title"), F.lit("\u3000\n"))
    return views.papers(spark, sf).select(
        "record_no", X.unicode_trim(padded).alias("title"), X.unicode_trim(F.col("abstract")).alias("abstract")
    )


@query("f5_strict_timestamp", with_views("SELECT record_no, published FROM entries", FEED))
def f5(spark, sf):
    return views.feed_entries(spark, sf).select(
        "record_no", F.date_format(TS.feed_timestamp(F.col("published")), MILLIS).alias("published")
    )


@query("f5_rejected_dates", with_views("SELECT count(*) AS entries FROM entries WHERE published IS NULL", FEED))
def f5_rejected(spark, sf):
    return records.rejected_entries(views.feed_entries(spark, sf)).agg(F.sum("entries").alias("entries"))


@query("f8_field_mapping", "SELECT doc_id AS id, source AS feed, text AS abstract, lang AS categories FROM documents")
def f8(spark, sf):
    mapping = {"id": "doc_id", "feed": "source", "abstract": "text", "categories": "lang"}
    return records.map_fields(views.table(spark, sf, "documents"), mapping)


COMBINED = f"""CASE WHEN title <> '' AND abstract <> ''
    THEN trim(title, {SQL_WHITE_SPACE}) || '. ' || trim(abstract, {SQL_WHITE_SPACE})
    WHEN title <> '' THEN trim(title, {SQL_WHITE_SPACE})
    WHEN abstract <> '' THEN trim(abstract, {SQL_WHITE_SPACE}) ELSE '' END"""


@query("f9_combine_text", with_views(f"SELECT record_no, {COMBINED} AS text FROM papers", PAPERS))
def f9(spark, sf):
    return views.papers(spark, sf).select(
        "record_no", X.combine_title_abstract(F.col("title"), F.col("abstract")).alias("text")
    )


# The byte cut in SQL: characters are listed with their running byte length.
F10_SQL = f"""WITH long_texts AS (SELECT doc_id, text FROM documents WHERE strlen(text) > 10000),
chars AS (
  SELECT doc_id, unnest(list) AS c, generate_subscripts(list, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '(?s).') AS list FROM long_texts)),
sums AS (SELECT doc_id, i, sum(strlen(c)) OVER (PARTITION BY doc_id ORDER BY i) AS bytes FROM chars),
ends AS (SELECT doc_id, max(i) FILTER (bytes <= 10000) AS n, max(bytes) FILTER (bytes <= 10000) AS b
         FROM sums GROUP BY doc_id),
cut AS (
  SELECT d.doc_id, CASE WHEN n IS NULL THEN text
    ELSE left(text, n) || CASE WHEN b < 10000 THEN chr(65533) ELSE '' END END AS text
  FROM documents d LEFT JOIN ends e ON d.doc_id = e.doc_id)
SELECT doc_id, left(trim(text, {SQL_STRIP}), 8192) AS encoder_input FROM cut"""


@query("f10_truncation_chain", F10_SQL)
def f10(spark, sf):
    return views.table(spark, sf, "documents").select("doc_id", X.encoder_input(F.col("text")).alias("encoder_input"))


@query("f11_measures", "SELECT doc_id, CAST(strlen(text) AS INTEGER) AS text_length FROM documents")
def f11(spark, sf):
    return views.table(spark, sf, "documents").select("doc_id", F.octet_length("text").alias("text_length"))


@query("f11_vector_dimension", with_views(
    "SELECT paper_id, CAST(len(embedding) AS INTEGER) AS dimension FROM vectors", VECTORS))
def f11_dimension(spark, sf):
    return views.vectors(spark, sf).select("paper_id", F.size("embedding").alias("dimension"))


@query("f12_vector_record", with_views(
    """SELECT paper_id, 'title_abstract' AS vector_type, model_version AS model_name, model_version,
              CAST(len(embedding) AS INTEGER) AS dimension, CAST(strlen('text of ' || paper_id) AS INTEGER) AS text_length,
              'title_abstract_combination' AS preprocessing, 'text of ' || paper_id AS content,
              'title|abstract' AS source_fields, 'en' AS language,
              strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at, trace_id, CAST(label AS BIGINT) AS processing_time_ms
       FROM vectors""", VECTORS))
def f12(spark, sf):
    v = views.vectors(spark, sf).withColumns({
        "text": F.concat(F.lit("text of "), F.col("paper_id")), "processing_time_ms": F.col("label"),
    })
    return records.vector_records(v, F.col("created_at")).select(
        "paper_id", "vector_type", "embedding_metadata.*",
        F.col("source_text.content").alias("content"),
        F.array_join("source_text.source_fields", "|").alias("source_fields"),
        F.col("source_text.language").alias("language"),
        TS.rfc3339(F.col("processing_info.created_at")).alias("created_at"),
        F.col("processing_info.trace_id").alias("trace_id"),
        F.col("processing_info.processing_time_ms").alias("processing_time_ms"),
    )


@query("f13_mean_pooling", """
SELECT label, CAST(i - 1 AS INTEGER) AS pos, round(avg(x), 6) AS mean
FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
GROUP BY label, i""")
def f13(spark, sf):
    pooled = embed.mean_pool(views.table(spark, sf, "embeddings"), "label")
    return pooled.select("label", F.posexplode("embedding").alias("pos", "x")).select(
        "label", "pos", F.round("x", 6).alias("mean")
    )


@query("f14_l2_normalize", """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round(x / greatest(norm, 1e-12), 6) AS x FROM (
  SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i, sqrt(list_sum([v * v FOR v IN e])) AS norm
  FROM (SELECT vec_id, CASE WHEN vec_id % 50 = 0 THEN [0.0::DOUBLE, 0.0::DOUBLE]
               ELSE [3 * v FOR v IN CAST(embedding AS DOUBLE[])] END AS e FROM embeddings))""")
def f14(spark, sf):
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 3)
    zero = F.array(F.lit(0.0), F.lit(0.0))
    e = views.table(spark, sf, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 50 == 0, zero).otherwise(scaled).alias("e"))
    return e.select("vec_id", F.posexplode(V.l2_normalize(F.col("e"))).alias("pos", "x")).select(
        "vec_id", "pos", F.round("x", 6).alias("x"))


@query("f15_partition_values", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day_folder, strftime(ts, '%Y%m%d-%H%M%S') AS file_stamp,
  'raw-data/' || strftime(ts, '%Y-%m-%d') || '/' || event_type || '-papers-' || strftime(ts, '%Y%m%d-%H%M%S') || '.gz' AS landing_key
FROM events""")
def f15(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return views.table(spark, sf, "events").select(
        "event_id", TS.day_folder(ts).alias("day_folder"), TS.file_stamp(ts).alias("file_stamp"),
        TS.landing_key("raw-data", F.col("event_type"), ts).alias("landing_key"))


@query("f16_rfc3339", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS rendered FROM events")
def f16(spark, sf):
    return views.table(spark, sf, "events").select(
        "event_id", TS.rfc3339(F.col("ts").cast("timestamp")).alias("rendered"))


@query("f17_stage_error", with_views("""
SELECT event_id, service || ': ' || event || CASE WHEN error_code IS NULL THEN '' ELSE ' (caused by: ' || error_code || ')' END
  AS error_text FROM run_log""", RUN_LOG))
def f17(spark, sf):
    return views.run_log(spark, sf).select(
        "event_id", X.stage_error(F.col("service"), F.col("event"), F.col("error_code")).alias("error_text"))


@query("f18_terms_and_names", with_views(
    "SELECT record_no, lang || '|' || source AS categories, 'A. ' || lang || '|' || source AS authors FROM papers", PAPERS))
def f18(spark, sf):
    return views.feed_entries(spark, sf).select(
        "record_no", F.array_join(records.category_terms(F.col("category")), "|").alias("categories"),
        F.array_join(records.author_names(F.col("author")), "|").alias("authors"))


# -- validation --------------------------------------------------------------------------

@query("p2_empty_key_invalid", with_views(
    "SELECT trace_id, count(*) FILTER (blank_id = '') AS invalid_count FROM papers GROUP BY trace_id", PAPERS))
def p2(spark, sf):
    return views.papers(spark, sf, blank_keys=True).groupBy("trace_id").agg(
        F.count_if(quality.dedup_key_invalid(F.col("paper_id"))).alias("invalid_count"))


P3_INPUT = """SELECT record_no, blank_id, CASE WHEN record_no % 53 = 0 THEN '' ELSE trace_id END AS trace_id,
  CASE WHEN record_no % 59 = 0 THEN '' ELSE title END AS title,
  CASE WHEN record_no % 59 = 0 AND lang <> 'en' THEN '' ELSE abstract END AS abstract FROM papers"""


@query("p3_paper_valid", with_views(f"""
SELECT record_no, CASE WHEN blank_id = '' THEN 'paper_id is empty' WHEN trace_id = '' THEN 'trace_id is empty'
  WHEN title = '' AND abstract = '' THEN 'both title and abstract are empty' END AS reason FROM ({P3_INPUT})""", PAPERS))
def p3(spark, sf):
    no = F.col("record_no")
    p = views.papers(spark, sf, blank_keys=True).withColumns({
        "trace_id": F.when(no % 53 == 0, "").otherwise(F.col("trace_id")),
        "title": F.when(no % 59 == 0, "").otherwise(F.col("title")),
        "abstract": F.when((no % 59 == 0) & (F.col("lang") != "en"), "").otherwise(F.col("abstract")),
    })
    reason = quality.paper_reason(F.col("paper_id"), F.col("trace_id"), F.col("title"), F.col("abstract"))
    return p.select("record_no", reason.alias("reason"))


VECTOR_REASON = """CASE WHEN paper_id = '' THEN 'paper_id is empty' WHEN vector_type = '' THEN 'vector_type is empty'
  WHEN len(embedding) = 0 THEN 'embedding vector is empty'
  WHEN dimension <> len(embedding) THEN 'dimension mismatch: metadata says ' || dimension || ', embedding has ' || len(embedding)
  WHEN model_version = '' THEN 'model_version is empty' WHEN trace_id = '' THEN 'trace_id is empty'
  WHEN isnan(embedding[1]) THEN 'embedding contains NaN at index 0' END"""


@query("p4_vector_valid", with_views(f"SELECT paper_id, {VECTOR_REASON} AS reason FROM vectors", VECTORS))
def p4(spark, sf):
    reason = quality.vector_reason(*[F.col(c) for c in (
        "paper_id", "vector_type", "embedding", "dimension", "model_version", "trace_id")])
    return views.vectors(spark, sf).select("paper_id", reason.alias("reason"))


@query("p5_response_valid", with_views("""
SELECT paper_id, CASE WHEN len(embedding) = 0 THEN 'embedding vector is empty'
  WHEN dimension <> len(embedding) THEN 'dimension mismatch: expected ' || dimension || ', got ' || len(embedding)
  WHEN model_version = '' THEN 'model version is empty'
  WHEN isnan(embedding[1]) THEN 'embedding contains NaN at index 0' END AS reason FROM vectors""", VECTORS))
def p5(spark, sf):
    reason = quality.response_reason(F.col("embedding"), F.col("dimension"), F.col("model_version"))
    return views.vectors(spark, sf).select("paper_id", reason.alias("reason"))


@query("p6_text_valid", f"""
SELECT doc_id, CASE WHEN t = '' THEN 'Text field is required and cannot be empty'
  WHEN trim(t, {SQL_STRIP}) = '' THEN 'Text cannot be only whitespace' END AS reason,
  strlen(trim(t, {SQL_STRIP})) AS stripped_bytes
FROM (SELECT doc_id, CASE doc_id % 20 WHEN 0 THEN '' WHEN 1 THEN ' ' || chr(10) || chr(12288) ELSE text || chr(31) END AS t
      FROM documents)""")
def p6(spark, sf):
    text = (
        F.when(F.col("doc_id") % 20 == 0, "").when(F.col("doc_id") % 20 == 1, " \n\u3000")
        .otherwise(F.concat("text", F.lit("\x1f")))
    )
    return views.table(spark, sf, "documents").select("doc_id", text.alias("t")).select(
        "doc_id", quality.text_reason(F.col("t")).alias("reason"),
        F.octet_length(X.strip_for_encoder(F.col("t"))).cast("long").alias("stripped_bytes"))


@query("p8_lenient_bound", with_views(
    "SELECT record_no, CAST(published_date AS VARCHAR) AS day FROM papers WHERE published_date >= DATE '2024-03-01'", PAPERS))
def p8(spark, sf):
    keep = quality.published_between(F.col("published_date"), "2024-03-01", "not a day")
    return views.papers(spark, sf).where(keep).select("record_no", F.col("published_date").cast("string").alias("day"))


@query("p9_published_range", with_views("""
SELECT record_no, CAST(published_date AS VARCHAR) AS day FROM papers
WHERE published_date >= DATE '2024-03-01' AND published_date <= DATE '2024-06-30'""", PAPERS))
def p9(spark, sf):
    keep = quality.published_between(F.col("published_date"), "2024-03-01", "2024-06-30")
    return views.papers(spark, sf).where(keep).select("record_no", F.col("published_date").cast("string").alias("day"))


@query("p10_category_search", with_views("""
SELECT record_no, lang AS category FROM papers
WHERE lang IN ('en', 'fr') AND published_date >= DATE '2024-03-01' AND published_date <= DATE '2024-06-30'""", PAPERS))
def p10(spark, sf):
    keep = quality.in_categories(F.col("categories"), ["en", "fr", "it"]) & quality.published_between(
        F.col("published_date"), "2024-03-01", "2024-06-30")
    return views.papers(spark, sf).where(keep).select("record_no", F.element_at("categories", 1).alias("category"))


SOURCE_CONFIG = {
    "src0": {"max_results": 1000}, "src4": {"enabled": False}, "src9": {}, "semantic_scholar": {"enabled": False},
}


@query("p11_enabled_sources", with_views(
    "SELECT record_no, source FROM papers WHERE source IN ('src0', 'src4', 'src9')", PAPERS))
def p11(spark, sf):
    return views.papers(spark, sf).where(quality.from_enabled_source(F.col("source"), SOURCE_CONFIG)).select(
        "record_no", "source")


@query("p12_log_level_gate", with_views("SELECT event_id, level FROM run_log WHERE level <> 'DEBUG'", RUN_LOG))
def p12(spark, sf):
    return views.run_log(spark, sf).where(quality.level_enabled(F.col("level"))).select("event_id", "level")


# -- lookups -----------------------------------------------------------------------------

def _stored_papers(spark, sf):
    """All papers in a table of buckets by paper_id; the number of the record keeps copies apart."""
    rows = views.papers(spark, sf).select("paper_id", "record_no", "source", "title", "trace_id", "batch_timestamp")
    table = KeyedTable(spark, scratch_dir(spark, "stored-papers"), rows.schema, ["paper_id", "record_no"], bucket_by=("paper_id",))
    table.upsert(rows)
    return table


@query("s6_key_lookup", with_views("""
SELECT record_no, paper_id, source FROM papers WHERE paper_id = (SELECT md5(text) FROM documents WHERE doc_id = 42)""", PAPERS))
def s6(spark, sf):
    """The key comes from a row of the documents, and the stored table opens the bucket of that key."""
    papers = _stored_papers(spark, sf)
    key = views.papers(spark, sf).where(F.col("record_no") == 42).select("paper_id")
    return papers.get_many(key).select("record_no", "paper_id", "source")


@query("s6_vector_key_lookup", with_views(
    "SELECT paper_id, vector_type, dimension FROM vectors WHERE paper_id = '77' AND vector_type = 'title_abstract'", VECTORS))
def s6_vector(spark, sf):
    return lookup.vector_by_key(views.vectors(spark, sf), "77", "title_abstract").select(
        "paper_id", "vector_type", "dimension")


@query("s7_trace_retrieval", with_views("""
SELECT paper_id, source, title, strftime(batch_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS batch_timestamp
FROM papers WHERE trace_id = 'batch-3' ORDER BY batch_timestamp DESC, paper_id""", PAPERS))
def s7(spark, sf):
    papers = _stored_papers(spark, sf)
    return trace_lookup(papers, _papers_by_trace(papers))


def _papers_by_trace(papers):
    keys = T.StructType([papers.schema["trace_id"], *(papers.schema[k] for k in papers.keys)])
    by_trace = KeyedTable(papers.spark, scratch_dir(papers.spark, "papers-by-trace"), keys, keys.names, bucket_by=("trace_id",))
    by_trace.upsert(papers.read().select(*keys.names))
    return by_trace


def trace_lookup(papers, by_trace):
    """By the index of the papers by trace: the bucket of the trace there, then the buckets of the papers it names."""
    named = by_trace.get(trace_id="batch-3").select(*papers.keys)
    return lookup.papers_of_trace(papers.get_many(named), "batch-3").select(
        "paper_id", "source", "title", TS.rfc3339(F.col("batch_timestamp")).alias("batch_timestamp"))


@query("s8_source_published_range", with_views("""
SELECT record_no, source, CAST(published_date AS VARCHAR) AS day FROM papers
WHERE source = 'src4' AND published_date BETWEEN DATE '2024-02-01' AND DATE '2024-08-31'""", PAPERS))
def s8(spark, sf):
    return lookup.papers_of_source(views.papers(spark, sf), "src4", "2024-02-01", "2024-08-31").select(
        "record_no", "source", F.col("published_date").cast("string").alias("day"))


@query("s9_vector_type_created_range", with_views("""
SELECT paper_id, strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at FROM vectors
WHERE vector_type = 'title_abstract'
  AND created_at BETWEEN TIMESTAMP '2024-01-01 01:00:00' AND TIMESTAMP '2024-01-01 05:00:00'""", VECTORS))
def s9(spark, sf):
    return lookup.vectors_of_type(
        views.vectors(spark, sf), "title_abstract", F.col("created_at"), "2024-01-01 01:00:00", "2024-01-01 05:00:00"
    ).select("paper_id", TS.rfc3339(F.col("created_at")).alias("created_at"))


@query("s10_model_version_lookup", with_views("SELECT paper_id FROM vectors WHERE model_version = 'm1'", VECTORS))
def s10(spark, sf):
    return lookup.vectors_of_model(views.vectors(spark, sf), F.col("model_version"), "m1").select("paper_id")


@query("t1_search_page", with_views("""
SELECT record_no, paper_id, CAST(published_date AS VARCHAR) AS day FROM papers
ORDER BY published_date DESC, paper_id, record_no LIMIT 50 OFFSET 20""", PAPERS))
def t1(spark, sf):
    return lookup.newest(views.papers(spark, sf), ["paper_id", "record_no"], 20, 50).select(
        "record_no", "paper_id", F.col("published_date").cast("string").alias("day"))
