"""Encoder failures, truncation and vector checks."""

import math
import sys
from functools import partial

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from folioflow.functions.text import encoder_input, unicode_trim
from folioflow.functions.timestamps import feed_timestamp, lenient_day
from folioflow.functions.vectors import l2_normalize
from folioflow.operators import embed, quality

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers do not see this file


def broken_model():
    raise RuntimeError("no such model")


def fragile():
    def encode(texts):
        if any("bad" in t for t in texts):
            raise ValueError("cannot encode")
        return np.array([[3.0, 4.0] if "nan" not in t else [math.nan, 1.0] for t in texts])

    return encode


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(
        [(0, "good"), (1, "bad"), (2, ""), (3, None), (4, " 　\x1f"), (5, "nan"), (6, "fine")], "i int, text string")


def by_i(df):
    return {r.i: r for r in df.collect()}


def test_one_failure_does_not_stop_others(texts):
    rows = by_i(embed.check_responses(embed.embed_texts(texts.coalesce(1), fragile, "m1")))
    assert [rows[i].error_code for i in range(7)] == [
        None, "EMBEDDING_ERROR", "VALIDATION_ERROR", "VALIDATION_ERROR", "VALIDATION_ERROR", "INVALID_RESPONSE", None]
    assert rows[0].embedding == pytest.approx([0.6, 0.8])
    assert (rows[0].dimension, rows[0].model_version) == (2, "m1")
    assert rows[1].error_message == "Failed to generate embedding"
    assert rows[2].error_message == quality.INPUT_EMPTY
    assert rows[4].error_message == quality.INPUT_BLANK
    assert rows[5].error_message == "embedding contains NaN at index 0"


def wrong_rows(extra):
    return lambda texts: np.zeros((max(0, len(texts) + extra), 2))


@pytest.mark.parametrize("extra", [1, -1])
def test_wrong_number_of_vectors_is_a_failed_call(texts, extra):
    rows = by_i(embed.embed_texts(texts, partial(wrong_rows, extra), "m"))
    assert [rows[i].error_code for i in (0, 1, 5, 6)] == ["EMBEDDING_ERROR"] * 4


def constant(value):
    return lambda texts: np.full((len(texts), 1), float(value))


def test_two_factories_of_one_name(texts):
    for value in (2, 3):
        rows = by_i(embed.embed_texts(texts, partial(constant, value), "same", normalize=False))
        assert rows[0].embedding == [float(value)]


def test_whole_long_texts_are_embedded(spark):
    long = "a" * 9_000 + "b" * 3_000
    df = spark.createDataFrame([(0, long), (1, "é" * 6_000 + "b" * 100)], "i int, text string")
    rows = by_i(embed.embed_texts(df, partial(embed.letter_counts, "ab"), "m", normalize=False))
    sizes = [2500, 2500, 2500, 2500, 2000]
    a = [2500, 2500, 2500, 1500, 0]
    assert rows[0].embedding == pytest.approx([sum(s * x for s, x in zip(sizes, a)) / 12_000, sum(s * (s - x) for s, x in zip(sizes, a)) / 12_000])
    assert rows[1].embedding[1] > 0
    cut = by_i(embed.embed_texts(df, partial(embed.letter_counts, "ab"), "m", normalize=False, truncate=True))
    assert cut[0].embedding == [8192.0, 0.0]


def test_many_texts_keep_their_order(spark, monkeypatch):
    df = spark.range(3000).select("id", F.when(F.col("id") % 7 == 0, "").otherwise(
        F.repeat(F.lit("a"), (F.col("id") % 50).cast("int") + 1)).alias("text"))
    out = embed.embed_texts(df, normalize=False, tasks=3)
    wrong = out.where(
        F.when(F.col("id") % 7 == 0, F.col("embedding").isNotNull())
        .otherwise(F.get("embedding", F.lit(0)) != F.col("id") % 50 + 1))
    assert out.count() == 3000 and wrong.count() == 0


def test_model_that_does_not_load(texts):
    rows = by_i(embed.embed_texts(texts, broken_model, "m2"))
    assert rows[0].error_code == "MODEL_LOAD_ERROR" and rows[0].embedding is None
    assert rows[2].error_code == "VALIDATION_ERROR"


def test_encoder_runs_once_in_the_plan(texts):
    out = embed.check_responses(embed.embed_texts(texts)).where("error_code is null").select("embedding", "dimension")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("text, expected", [
    ("a" * 10_000, "a" * 8_192),
    (" " + "b" * 8_192 + " ", "b" * 8_192),
    ("中" * 3_334, "中" * 3_333 + "�"),
    ("é" * 5_001, "é" * 5_000),
    ("x" + "é" * 5_000, "x" + "é" * 4_999 + "�"),
    ("\U0001f600" * 2_500, "\U0001f600" * 2_500),
    ("\x1c a \x1f", "a"),
])
def test_encoder_input(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(encoder_input(F.col("t"))).first()[0] == expected


def test_trim_takes_all_white_space(spark):
    df = spark.createDataFrame([(" \xa0\x85a b　\n​",)], "t string")
    assert df.select(unicode_trim(F.col("t"))).first()[0] == "a b　\n​"


@pytest.mark.parametrize("text, ok", [
    ("2024-01-02T03:04:05Z", True), ("2024-01-02T03:04:05.5Z", True), ("2024-01-02T03:04:05.123456789Z", True),
    ("2024-01-02T03:04:05+00:00", False), ("2024-01-02 03:04:05Z", False), ("2024-13-02T03:04:05Z", False),
    (" 2024-01-02T03:04:05Z", False), ("", False), (None, False),
])
def test_feed_timestamp(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    assert (df.select(feed_timestamp(F.col("t"))).first()[0] is not None) == ok


@pytest.mark.parametrize("text, ok", [("2024-02-29", True), ("2024-02-30", False), ("2024-2-3", False), (None, False)])
def test_lenient_day(spark, text, ok):
    assert (spark.range(1).select(lenient_day(F.lit(text).cast("string"))).first()[0] is not None) == ok


def test_normalize_zero_and_tiny(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([1e-13, 0.0],), ([3.0, 4.0],)], "e array<double>")
    rows = [r[0] for r in df.select(l2_normalize(F.col("e"))).collect()]
    assert rows[0] == [0.0, 0.0] and rows[1] == pytest.approx([0.1, 0.0]) and rows[2] == pytest.approx([0.6, 0.8])


def vector_case(**change):
    row = {"paper_id": "p", "vector_type": "t", "embedding": [1.0, 2.0], "dimension": 2, "model_version": "m",
           "trace_id": "x"}
    return {**row, **change}


@pytest.mark.parametrize("change, reason", [
    ({}, None),
    ({"embedding": [math.inf, 1.0]}, None),
    ({"paper_id": "", "trace_id": ""}, "paper_id is empty"),
    ({"vector_type": ""}, "vector_type is empty"),
    ({"embedding": [], "dimension": 0}, "embedding vector is empty"),
    ({"embedding": None}, "embedding vector is empty"),
    ({"dimension": 3, "model_version": ""}, "dimension mismatch: metadata says 3, embedding has 2"),
    ({"model_version": None}, "model_version is empty"),
    ({"trace_id": ""}, "trace_id is empty"),
    ({"embedding": [1.0, math.nan]}, "embedding contains NaN at index 1"),
])
def test_vector_reason(spark, change, reason):
    schema = ("paper_id string, vector_type string, embedding array<double>, dimension int, "
              "model_version string, trace_id string")
    df = spark.createDataFrame([vector_case(**change)], schema)
    got = df.select(quality.vector_reason(*[F.col(c) for c in df.columns])).first()[0]
    assert got == reason


def noted(path):
    """An encoder that notes the process it is loaded in, and the sizes of its calls."""
    import os
    import uuid

    name = os.path.join(path, f"load-{os.getpid()}-{uuid.uuid4().hex}")
    open(name, "w").close()
    encode = embed.letter_counts()

    def run(texts):
        with open(os.path.join(path, f"call-{uuid.uuid4().hex}"), "w") as out:
            out.write(f"{len(texts) * max(map(len, texts))} {sum(map(len, texts))}")
        return encode(texts)

    return run


def test_one_load_per_worker_process(spark, tmp_path):
    folder = str(tmp_path)
    texts = spark.range(0, 400, 1, 20).select(F.concat(F.lit("text "), "id").alias("text"))
    factory = partial(noted, folder)
    for _ in range(2):
        assert embed.embed_texts(texts, factory).where("error_code is null").count() == 400
    loads = [f.name.split("-")[1] for f in tmp_path.iterdir() if f.name.startswith("load-")]
    assert len(loads) == len(set(loads)) <= 8


def test_calls_pad_little_and_keep_the_order(spark, tmp_path):
    folder = str(tmp_path)
    rows = [(i, "abcdefghij"[i % 10] * (1 + (i * 37) % 500)) for i in range(1024)]
    texts = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    for r in embed.embed_texts(texts, partial(noted, folder), normalize=False).collect():
        assert r.embedding[r.id % 10] == len(rows[r.id][1]) == sum(r.embedding)
    sizes = [tuple(map(int, f.read_text().split())) for f in tmp_path.iterdir() if f.name.startswith("call-")]
    assert len(sizes) == 4 and sum(padded for padded, _ in sizes) < 1.35 * sum(own for _, own in sizes)  # in the given order it is twice as much
