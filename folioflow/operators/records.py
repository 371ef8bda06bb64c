"""Projections between the feed, the landing records, the papers and the vectors."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import last_path_segment, unicode_trim
from folioflow.functions.timestamps import feed_timestamp
from folioflow.functions.variants import text_of, texts_of, variant_fields

# Fixed values of the records.
FEED_SOURCE = "arxiv"
UNKNOWN_SOURCE = "unknown"
PROCESSED = "processed"
VECTOR_TYPE = "title_abstract"
PREPROCESSING = "title_abstract_combination"
SOURCE_FIELDS = ("title", "abstract")
LANGUAGE = "en"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def alternate_link(links: Column) -> Column:
    """Address of the first link with rel = alternate, else ''."""
    first = F.get(F.filter(links, lambda link: link["_rel"] == "alternate"), F.lit(0))
    return _text(first["_href"])


def category_terms(categories: Column) -> Column:
    terms = F.transform(categories, lambda c: _text(c["_term"]))
    return F.coalesce(terms, F.array().cast("array<string>"))


def author_names(authors: Column) -> Column:
    names = F.transform(authors, lambda a: unicode_trim(_text(a["name"])))
    return F.coalesce(names, F.array().cast("array<string>"))


def entries_to_papers(entries: DataFrame, source: str = FEED_SOURCE) -> DataFrame:
    """Feed entries to collected papers; entries with an unreadable date are left out."""
    return entries.select(
        last_path_segment(_text(F.col("id"))).alias("id"),
        F.lit(source).alias("source"),
        unicode_trim(_text(F.col("title"))).alias("title"),
        unicode_trim(_text(F.col("summary"))).alias("abstract"),
        author_names(F.col("author")).alias("authors"),
        feed_timestamp(F.col("published")).alias("published_date"),
        category_terms(F.col("category")).alias("categories"),
        F.lit(None).cast("string").alias("raw_xml"),
        alternate_link(F.col("link")).alias("url"),
    ).where(F.col("published_date").isNotNull())


def rejected_entries(entries: DataFrame) -> DataFrame:
    """published, entries: how many entries are left out for each date that can't be read."""
    unread = entries.where(feed_timestamp(F.col("published")).isNull())
    return unread.groupBy("published").agg(F.count(F.lit(1)).alias("entries"))


KEY_FIELDS = ("paper_id", "id")
RECORD_FIELDS = (
    *KEY_FIELDS, "source", "title", "abstract", "authors", "published_date", "categories", "raw_xml",
)


def _key(fields: str) -> Column:
    """`paper_id`, else `id`; only non-empty JSON strings count. Null when neither is usable."""
    return F.coalesce(*[F.nullif(text_of(F.col(f"{fields}.{name}")), F.lit("")) for name in KEY_FIELDS])


def normalize_records(landed: DataFrame, record: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """Loosely typed JSON objects (text) to the fixed paper columns.

    Wrong-typed scalars become '', arrays keep their string elements, and a source that is
    absent or no string becomes `unknown` (an empty one stays empty). `paper_id` is null
    where no usable key exists; see `quality.key_reason`.
    """
    parsed = landed.select(*keep, variant_fields(F.col(record), RECORD_FIELDS).alias("_r"))
    text = lambda name: text_of(F.col(f"_r.{name}"))
    return parsed.select(
        *keep,
        _key("_r").alias("paper_id"),
        F.coalesce(text("source"), F.lit(UNKNOWN_SOURCE)).alias("source"),
        _text(text("title")).alias("title"),
        _text(text("abstract")).alias("abstract"),
        texts_of(F.col("_r.authors")).alias("authors"),
        _text(text("published_date")).alias("published_date"),
        texts_of(F.col("_r.categories")).alias("categories"),
        text("raw_xml").alias("raw_xml"),
    )


def explode_envelopes(df: DataFrame, envelope: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelope objects to one row per element of `papers`.

    The envelope's own source is kept beside the record, it is not written into it.
    """
    parsed = df.select(*keep, variant_fields(F.col(envelope), ("papers", "source")).alias("_e"))
    papers = F.try_variant_get(F.col("_e.papers"), "$", "array<variant>")
    return parsed.select(
        *keep, text_of(F.col("_e.source")).alias("envelope_source"), F.posexplode(papers).alias("record_no", "_p"),
    ).select(
        *keep, "envelope_source", F.col("record_no").cast("long").alias("record_no"), F.to_json("_p").alias("record"),
    )


def new_trace_id() -> str:
    return str(uuid.uuid4())


def stamp_batch(papers: DataFrame, trace_id: str, batch_time: datetime | None = None) -> DataFrame:
    """One trace id and one time for the whole batch, on every row."""
    now = F.lit(batch_time or datetime.now(timezone.utc))
    return papers.withColumns({
        "trace_id": F.lit(trace_id),
        "batch_timestamp": now,
        "processing_status": F.lit(PROCESSED),
        "created_at": now,
        "updated_at": now,
    })


def map_fields(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Project source fields to target names: `mapping` is target -> source."""
    return df.select([F.col(source).alias(target) for target, source in mapping.items()])


def vector_records(embedded: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Embedded texts (paper_id, text, trace_id, embedding, ...) to vector records.

    The text length is in bytes and of the text before truncation; the name of the model
    is the same as its version.
    """
    return embedded.select(
        "paper_id",
        F.lit(VECTOR_TYPE).alias("vector_type"),
        "embedding",
        F.struct(
            F.col("model_version").alias("model_name"),
            F.col("model_version").alias("model_version"),
            F.size("embedding").alias("dimension"),
            F.octet_length("text").alias("text_length"),
            F.lit(PREPROCESSING).alias("preprocessing"),
        ).alias("embedding_metadata"),
        F.struct(
            F.col("text").alias("content"),
            F.array(*[F.lit(f) for f in SOURCE_FIELDS]).alias("source_fields"),
            F.lit(LANGUAGE).alias("language"),
        ).alias("source_text"),
        F.struct(
            (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
            F.col("trace_id").alias("trace_id"),
            F.col("processing_time_ms").cast("long").alias("processing_time_ms"),
        ).alias("processing_info"),
    )
