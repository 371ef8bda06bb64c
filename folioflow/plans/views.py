"""Views over the given tables in the shapes the operators read, in Spark and in SQL.

Every view derives from a whole table. Faults are injected by row number so that each
validation rule has rows; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def papers(spark: SparkSession, sf_dir: str, blank_keys: bool = False) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    key: Column = F.md5("text")
    if blank_keys:
        key = F.when(F.col("doc_id") % 97 == 0, "").otherwise(key)
    title = F.substring_index("text", "\n", 1)
    return docs.select(
        F.col("doc_id").alias("record_no"),
        key.alias("paper_id"),
        "source",
        title.alias("title"),
        F.expr("substring(text, length(substring_index(text, '\\n', 1)) + 2)").alias("abstract"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 366).cast("int")).alias("published_date"),
        F.array("lang").alias("categories"),
        F.concat(F.lit("batch-"), F.expr("doc_id div 100").cast("string")).alias("trace_id"),
        F.expr("timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(doc_id div 100 as int))").alias(
            "batch_timestamp"),
        "lang", "text", "n_chars",
    )


PAPERS = """papers AS (
  SELECT doc_id AS record_no, md5(text) AS paper_id, source,
         split_part(text, chr(10), 1) AS title,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substring(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract,
         DATE '2024-01-01' + CAST(doc_id % 366 AS INTEGER) AS published_date,
         'batch-' || CAST(doc_id // 100 AS VARCHAR) AS trace_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(doc_id // 100 AS INTEGER)) AS batch_timestamp,
         lang, text, n_chars,
         CASE WHEN doc_id % 97 = 0 THEN '' ELSE md5(text) END AS blank_id
  FROM documents)"""


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a run log. The stored timestamps have no zone; they are UTC."""
    return as_run_log(table(spark, sf_dir, "events"))


def as_run_log(events: DataFrame) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    count = F.get_json_object("props", "$.k").cast("long")
    services = ["data-collector", "batch-processor", "vector-coordinator", "embedding-api"]
    codes = ["VALIDATION_ERROR", "MODEL_LOAD_ERROR", "EMBEDDING_ERROR", "INTERNAL_ERROR"]

    def pick(values: list[str], number: Column) -> Column:
        out = F.lit(values[-1])
        for i, v in reversed(list(enumerate(values[:-1]))):
            out = F.when(number == i, v).otherwise(out)
        return out

    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        pick(services, F.col("user_id") % 4).alias("service"),
        F.when(kind == "error", "ERROR").when((kind == "view") & (value > 20), "WARN")
        .when(kind == "view", "DEBUG").otherwise("INFO").alias("level"),
        F.when(kind == "signup", "processing_start").when(kind == "click", "data_parsing")
        .when(kind == "view", "metrics").when(kind == "purchase", "processing_complete")
        .otherwise("error").alias("event"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string")).alias("trace_id"),
        F.floor(value * 10).cast("long").alias("duration_ms"),
        count.alias("data_count"),
        (1 + count % 3).alias("attempt"),
        F.when(kind == "error", pick(codes, count % 4)).alias("error_code"),
        "value",
    )


RUN_LOG = """run_log AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts,
         CASE user_id % 4 WHEN 0 THEN 'data-collector' WHEN 1 THEN 'batch-processor'
                          WHEN 2 THEN 'vector-coordinator' ELSE 'embedding-api' END AS service,
         CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'view' AND value > 20 THEN 'WARN'
              WHEN event_type = 'view' THEN 'DEBUG' ELSE 'INFO' END AS level,
         CASE event_type WHEN 'signup' THEN 'processing_start' WHEN 'click' THEN 'data_parsing'
                         WHEN 'view' THEN 'metrics' WHEN 'purchase' THEN 'processing_complete'
                         ELSE 'error' END AS event,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS trace_id,
         CAST(floor(value * 10) AS BIGINT) AS duration_ms,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS data_count,
         1 + CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS attempt,
         CASE WHEN event_type = 'error' THEN
           CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 WHEN 0 THEN 'VALIDATION_ERROR'
             WHEN 1 THEN 'MODEL_LOAD_ERROR' WHEN 2 THEN 'EMBEDDING_ERROR' ELSE 'INTERNAL_ERROR' END
         END AS error_code,
         value
  FROM events)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector records in flat columns: one fault for each validation rule, and rows that break several of them."""
    number = F.col("vec_id") % 50
    fault = lambda *numbers: number.isin(*numbers)
    stored = F.col("embedding").cast("array<double>")
    with_nan = F.transform(stored, lambda x, i: F.when(i == 0, F.lit(float("nan"))).otherwise(x))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("paper_id"),
        F.lit("title_abstract").alias("vector_type"),
        F.when(fault(0, 8), F.array().cast("array<double>")).when(fault(1, 5, 6, 7), with_nan).otherwise(stored).alias(
            "embedding"),
        F.when(fault(2, 5), 63).otherwise(64).alias("dimension"),
        F.when(fault(3, 5, 6, 8), "").otherwise(F.concat(F.lit("m"), (F.col("label") % 2).cast("string"))).alias(
            "model_version"),
        F.when(fault(4, 5, 6, 7, 8), "").otherwise(F.concat(F.lit("batch-"), F.col("label").cast("string"))).alias("trace_id"),
        F.expr("timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(vec_id as int))").alias(
            "created_at"),
        "label",
    )


VECTORS = """vectors AS (
  SELECT CAST(vec_id AS VARCHAR) AS paper_id, 'title_abstract' AS vector_type,
         CASE WHEN vec_id % 50 IN (0, 8) THEN CAST([] AS DOUBLE[])
              WHEN vec_id % 50 IN (1, 5, 6, 7) THEN list_concat([CAST('nan' AS DOUBLE)], CAST(embedding[2:] AS DOUBLE[]))
              ELSE CAST(embedding AS DOUBLE[]) END AS embedding,
         CASE WHEN vec_id % 50 IN (2, 5) THEN 63 ELSE 64 END AS dimension,
         CASE WHEN vec_id % 50 IN (3, 5, 6, 8) THEN '' ELSE 'm' || CAST(label % 2 AS VARCHAR) END AS model_version,
         CASE WHEN vec_id % 50 IN (4, 5, 6, 7, 8) THEN '' ELSE 'batch-' || CAST(label AS VARCHAR) END AS trace_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(vec_id AS INTEGER)) AS created_at,
         label
  FROM embeddings)"""


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The papers as feed entries: padded texts, bad and fractional dates, missing links."""
    p = papers(spark, sf_dir)
    stamp = F.concat(F.col("published_date").cast("string"), F.lit("T12:34:56"))
    page = F.concat(F.lit("https://papers.example.org/abs/"), F.col("record_no").cast("string"), F.lit("v1"))

    def link(href: Column, rel: str) -> Column:
        return F.struct(href.alias("_href"), F.lit(rel).alias("_rel"), F.lit("text/html").alias("_type"))

    related = link(F.concat(page, F.lit(".pdf")), "related")
    return p.select(
        "record_no",
        page.alias("id"),
        F.concat(F.lit(" \xa0"), F.col("title"), F.lit("\u3000\n")).alias("title"),
        F.concat(F.lit("\t"), F.col("abstract")).alias("summary"),
        F.when(F.col("source") == "src3", F.concat(stamp, F.lit("+00:00")))
        .when(F.col("source") == "src5", "not a date")
        .when(F.col("source") == "src7", F.concat(stamp, F.lit(".250Z")))
        .otherwise(F.concat(stamp, F.lit("Z"))).alias("published"),
        F.array(
            F.struct(F.concat(F.lit("\u2003A. "), F.col("lang")).alias("name")),
            F.struct(F.concat(F.col("source"), F.lit("\xa0")).alias("name")),
        ).alias("author"),
        F.array(F.struct(F.col("lang").alias("_term")), F.struct(F.col("source").alias("_term"))).alias("category"),
        F.when(F.col("lang") == "es", F.array().cast("array<struct<_href:string,_rel:string,_type:string>>"))
        .when(F.col("lang") == "de", F.array(related))
        .otherwise(F.array(related, link(page, "alternate"), link(F.concat(page, F.lit("#2")), "alternate")))
        .alias("link"),
    )


# White space as DuckDB's trim takes it, built from code points; the same characters as in
# functions.text.WHITE_SPACE.
SQL_WHITE_SPACE = "||".join(
    f"chr({n})" for n in [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)
SQL_STRIP = SQL_WHITE_SPACE + "||" + "||".join(f"chr({n})" for n in range(28, 32))


def landing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The papers as JSON lines of all kinds, good and bad, and envelopes (French papers)."""
    p = papers(spark, sf_dir)
    kind = F.col("record_no") % 8
    body = F.to_json(F.struct(
        "title", "abstract", F.col("published_date").cast("string").alias("published_date"), "categories", "record_no",
    ))
    as_text = lambda name, c: F.concat(F.lit(f'"{name}":"'), c, F.lit('",'))
    key = (
        F.when(kind == 0, F.concat(F.lit('"paper_id":null,'), as_text("id", F.col("paper_id"))))
        .when(kind == 1, F.concat(F.lit('"paper_id":12,'), as_text("id", F.col("paper_id"))))
        .when(kind == 2, F.lit('"paper_id":"","id":7,'))
        .otherwise(as_text("paper_id", F.col("paper_id")))
    )
    source = (
        F.when(kind == 3, F.lit("")).when(kind == 4, F.lit('"source":4,'))
        .when(kind == 7, F.lit('"source":"",')).otherwise(as_text("source", F.col("source")))
    )
    authors = (
        F.when(kind == 5, F.concat(F.lit('"authors":["A",1,null,"'), F.col("lang"), F.lit('"],')))
        .when(kind == 6, F.lit('"authors":"A",')).otherwise(F.lit('"authors":["A","B","C"],'))
    )
    record = F.concat(F.lit("{"), key, source, authors, F.substr(body, F.lit(2)))
    broken = F.col("record_no") % 31 == 30
    line = (
        F.when(broken, F.concat(record, F.lit(" junk")))
        .when(F.col("lang") == "fr", F.concat(
            F.lit('{"papers":['), record, F.lit(',{"id":"'), F.col("paper_id"), F.lit('v2","record_no":'),
            F.col("record_no").cast("string"), F.lit('}],"source":"feed","count":2}')))
        .otherwise(record)
    )
    return p.select("record_no", line.alias("value"), F.col("source").alias("collect_source"))


# The rows of `landing_lines` that are usable, after normalization.
LANDED = PAPERS + """,
lines AS (SELECT *, record_no % 8 AS kind, record_no % 31 = 30 AS broken FROM papers),
landed AS (
  SELECT record_no, 0 AS element_no, paper_id,
         CASE WHEN kind IN (3, 4) THEN 'unknown' WHEN kind = 7 THEN '' ELSE source END AS source,
         title, abstract, CAST(published_date AS VARCHAR) AS published_date,
         CASE WHEN kind = 5 THEN 2 WHEN kind = 6 THEN 0 ELSE 3 END AS n_authors, lang AS category
  FROM lines WHERE NOT broken AND kind <> 2
  UNION ALL
  SELECT record_no, 1, paper_id || 'v2', 'unknown', '', '', '', 0, NULL FROM lines WHERE NOT broken AND lang = 'fr')"""


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder of files."""
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema)
    if events.inputFiles()[0].endswith("/events.parquet"):
        return stream.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.parquet(f"{sf_dir}/events.parquet")
