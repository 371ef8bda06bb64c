"""Documents to a training mix: language, exact copies, near copies, benchmark leaks, source weights.

Each stage takes the documents that its predecessor kept, as written, and returns a
DataFrame with the columns of `documents`; the last one adds mix_slot and mix_seq, which
give the order. Decisions are made per doc_id: rows that share an id stay or go together.
A stage on an empty table returns an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import chosen_path, containment, cuckoo, language, mixing
from folioflow.session import configure, remove, scratch_dir, scratch_scope

#: Calibrated probability of the best language below which a document is rejected.
LEAST_SCORE = 0.4


def _with_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    own = ids.select(F.col("doc_id").alias("__doc_id")).distinct()
    return docs.join(own, F.col("doc_id").eqNullSafe(F.col("__doc_id")), how)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those whose language stays unsure, go. The model is learnt from the labels of all of them."""
    model = language.train(docs.select("text", "lang"))
    found = docs.withColumn("__found", language.predictor(model)(F.col("text")))
    least = LEAST_SCORE if len(model.names) > 1 else 0.0
    return found.filter((F.col("__found.lang_pred") != language.UNKNOWN) & (F.col("__found.score") >= least)).drop("__found")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest stays, then the smallest id."""
    return _with_ids(docs, cuckoo.exact_dedup(docs).filter("kept"), "left_semi")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 or more, the smallest id stays."""
    return _with_ids(docs, chosen_path.jaccard_join(docs).filter("doc_id <=> class_id"), "left_semi")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain 0.8 or more of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_ids(docs, containment.contained_items(docs, items), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
]

#: The language model and the chosen paths are not in the reach of SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, as written. Scratch tables of a stage, and the rows of the one before it, go once it is written."""
    docs, before = configure(spark).read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
