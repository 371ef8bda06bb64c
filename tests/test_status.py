"""Truth tables of the two status rules."""

import itertools

from folioflow.operators import status


def batch_rule(success, failed, error):
    state, message = "success", None
    if failed > 0:
        state, message = "partial_success", f"{failed} items failed to upsert"
    if error and success == 0:
        state, message = "failed", message or error
    elif error:
        state, message = "partial_success", message or error
    return state, message


def test_batch_status(spark):
    cases = list(itertools.product([0, 1, 30], [0, 25], [None, "bad file"]))
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(cases)], "i int, success_items long, failed_items long, file_error string")
    for row in status.batch_status(df).collect():
        assert (row.status, row.error_message) == batch_rule(*cases[row.i]), cases[row.i]
        assert row.processed_count == cases[row.i][0]


def vector_rule(trace, retrieval, total, generated, storage, stored, bad_embeddings, bad_storage):
    if not trace:
        return "failed"
    if retrieval:
        return "failed"
    if total == 0:
        return "completed"
    if generated == 0 or storage:
        return "failed"
    if not bad_embeddings and not bad_storage:
        return "completed"
    return "partial_success" if stored > 0 else "failed"


def test_vector_status(spark):
    cases = list(itertools.product(
        ["", "t"], [None, "r"], [0, 5], [0, 5], [None, "s"], [0, 3], [0, 1], [0, 2]))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], (
        "i int, trace_id string, retrieval_error string, total_papers long, embeddings_generated long, "
        "storage_error string, vectors_stored long, failed_embeddings long, failed_storage long"))
    rows = status.vector_status(df).collect()
    assert len(rows) == len(cases)
    for row in rows:
        expected = vector_rule(*cases[row.i])
        assert row.status == expected, cases[row.i]
        assert (row.error_message is not None) == (expected == "failed"), cases[row.i]


def test_vector_status_messages(spark):
    df = spark.createDataFrame(
        [("", None, 1, 1, None, 1, 0, 0), ("t", "no index", 1, 1, None, 1, 0, 0), ("t", None, 2, 0, None, 0, 2, 0),
         ("t", None, 2, 2, "gone", 0, 0, 0), ("t", None, 2, 2, None, 0, 0, 2)],
        "trace_id string, retrieval_error string, total_papers long, embeddings_generated long, "
        "storage_error string, vectors_stored long, failed_embeddings long, failed_storage long")
    assert [r.error_message for r in status.vector_status(df).collect()] == [
        "validation: traceID cannot be empty",
        "data_retrieval: failed to retrieve papers for vectorization (caused by: no index)",
        "embedding_generation: no embeddings were generated successfully",
        "vector_storage: failed to store vector records (caused by: gone)",
        "all vectorization operations failed",
    ]


def test_rates_and_throughput_are_null_without_base(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [(0, 0, 0, 0), (4, 2, 1, 500)], "total_papers long, embeddings_generated long, vectors_stored long, ms long")
    out = status.success_rates(df).withColumn(
        "tps", status.throughput_per_second(F.col("vectors_stored"), F.col("ms")))
    assert [tuple(r)[4:] for r in out.collect()] == [(None, None, None, None), (50.0, 50.0, 25.0, 2.0)]
