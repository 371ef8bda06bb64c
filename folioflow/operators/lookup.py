"""Reads by key and by the secondary access paths of the two tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def paper_by_id(papers: DataFrame, paper_id: str) -> DataFrame:
    return papers.where(F.col("paper_id") == paper_id)


def vector_by_key(vectors: DataFrame, paper_id: str, vector_type: str) -> DataFrame:
    return vectors.where((F.col("paper_id") == paper_id) & (F.col("vector_type") == vector_type))


def papers_of_trace(papers: DataFrame, trace_id: str) -> DataFrame:
    """All papers of a trace, newest batch first; the key makes the order stable."""
    return papers.where(F.col("trace_id") == trace_id).orderBy(F.desc("batch_timestamp"), "paper_id")


def papers_of_source(papers: DataFrame, source: str, published_from, published_to) -> DataFrame:
    """Papers of a source in a closed range of publication dates, in date order."""
    published = F.col("published_date")
    return papers.where(
        (F.col("source") == source) & published.between(F.lit(published_from), F.lit(published_to))
    ).orderBy("published_date", "paper_id")


def vectors_of_type(vectors: DataFrame, vector_type: str, created: Column, created_from, created_to) -> DataFrame:
    return vectors.where(
        (F.col("vector_type") == vector_type) & created.between(F.lit(created_from), F.lit(created_to))
    ).orderBy(created, "paper_id")


def vectors_of_model(vectors: DataFrame, model_version: Column, wanted: str) -> DataFrame:
    """Papers that have a vector of this model, by paper id."""
    return vectors.where(model_version == wanted).orderBy("paper_id")


def newest(papers: DataFrame, tie_break: list[str], start: int, max_results: int) -> DataFrame:
    """One page of the newest papers; offset and limit become a top-k, not a full sort."""
    return papers.orderBy(F.desc("published_date"), *tie_break).offset(start).limit(max_results)
