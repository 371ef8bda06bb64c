"""Validation as reason columns (null = valid), and the collection filters.

A reason column lets one pass give the kept rows, the rejected rows and the counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import strip_for_encoder
from folioflow.functions.timestamps import lenient_day
from folioflow.functions.vectors import first_nan_index

# The first rule that fails gives the reason.
KEY_MISSING = "missing or invalid paper_id"
PAPER_ID_EMPTY = "paper_id is empty"
TRACE_ID_EMPTY = "trace_id is empty"
TEXT_EMPTY = "both title and abstract are empty"
VECTOR_TYPE_EMPTY = "vector_type is empty"
EMBEDDING_EMPTY = "embedding vector is empty"
MODEL_VERSION_EMPTY = "model_version is empty"
RESPONSE_MODEL_EMPTY = "model version is empty"
INPUT_EMPTY = "Text field is required and cannot be empty"
INPUT_BLANK = "Text cannot be only whitespace"
ALWAYS_OPTIONAL_SOURCE = "semantic_scholar"


def _empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def _nan_reason(embedding: Column) -> Column:
    # The index is looked up only for the rows that have a NaN.
    return F.concat(F.lit("embedding contains NaN at index "), first_nan_index(embedding).cast("string"))


def _has_nan(embedding: Column) -> Column:
    return F.exists(embedding, lambda x: F.isnan(x))


def key_reason(paper_id: Column) -> Column:
    return F.when(paper_id.isNull(), F.lit(KEY_MISSING))


def dedup_key_invalid(paper_id: Column) -> Column:
    """True for keys that deduplication counts as invalid, not as duplicates."""
    return _empty(paper_id)


def paper_reason(paper_id: Column, trace_id: Column, title: Column, abstract: Column) -> Column:
    return (
        F.when(_empty(paper_id), PAPER_ID_EMPTY)
        .when(_empty(trace_id), TRACE_ID_EMPTY)
        .when(_empty(title) & _empty(abstract), TEXT_EMPTY)
    )


def vector_reason(
    paper_id: Column, vector_type: Column, embedding: Column, dimension: Column,
    model_version: Column, trace_id: Column,
) -> Column:
    size = F.coalesce(F.size(embedding), F.lit(0))
    mismatch = F.concat(
        F.lit("dimension mismatch: metadata says "), F.coalesce(dimension, F.lit(0)).cast("string"),
        F.lit(", embedding has "), size.cast("string"),
    )
    return (
        F.when(_empty(paper_id), PAPER_ID_EMPTY)
        .when(_empty(vector_type), VECTOR_TYPE_EMPTY)
        .when(size <= 0, EMBEDDING_EMPTY)
        .when(F.coalesce(dimension, F.lit(0)) != size, mismatch)
        .when(_empty(model_version), MODEL_VERSION_EMPTY)
        .when(_empty(trace_id), TRACE_ID_EMPTY)
        .when(_has_nan(embedding), _nan_reason(embedding))
    )


def record_reason() -> Column:
    """`vector_reason` on the nested columns of a vector record."""
    return vector_reason(
        F.col("paper_id"), F.col("vector_type"), F.col("embedding"),
        F.col("embedding_metadata.dimension"), F.col("embedding_metadata.model_version"),
        F.col("processing_info.trace_id"),
    )


def response_reason(embedding: Column, dimension: Column, model_version: Column) -> Column:
    size = F.coalesce(F.size(embedding), F.lit(0))
    declared = F.coalesce(dimension, F.lit(0))
    mismatch = F.concat(
        F.lit("dimension mismatch: expected "), declared.cast("string"),
        F.lit(", got "), size.cast("string"),
    )
    return (
        F.when(size <= 0, EMBEDDING_EMPTY)
        .when(declared != size, mismatch)
        .when(_empty(model_version), RESPONSE_MODEL_EMPTY)
        .when(_has_nan(embedding), _nan_reason(embedding))
    )


def text_reason(text: Column) -> Column:
    return F.when(_empty(text), INPUT_EMPTY).when(strip_for_encoder(text) == "", INPUT_BLANK)


def split_by_reason(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a `reason` column)."""
    marked = df.withColumn("reason", reason)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def published_between(published: Column, date_from: str | None, date_to: str | None) -> Column:
    """Inclusive day range; an absent bound, or one that is no `YYYY-MM-DD`, is ignored.

    The bounds are literals, so the comparison folds to plain column bounds and reaches
    the scan.
    """
    low, high = lenient_day(F.lit(date_from).cast("string")), lenient_day(F.lit(date_to).cast("string"))
    return (low.isNull() | (published >= low)) & (high.isNull() | (published < F.date_add(high, 1)))


def in_categories(categories: Column, wanted: Iterable[str]) -> Column:
    return F.arrays_overlap(categories, F.array(*[F.lit(c) for c in wanted]))


def enabled_sources(config: Mapping[str, Mapping]) -> list[str]:
    """Names that may be collected: all but one are always on, that one only if enabled."""
    return sorted(
        name for name, entry in config.items()
        if name != ALWAYS_OPTIONAL_SOURCE or entry.get("enabled", False)
    )


def from_enabled_source(source: Column, config: Mapping[str, Mapping]) -> Column:
    """The configuration is a small dict on the driver, so the gate is an IN filter that
    the scan can use, not a join."""
    return source.isin(enabled_sources(config))


def level_enabled(level: Column, debug: bool = False) -> Column:
    return F.lit(True) if debug else level != "DEBUG"
