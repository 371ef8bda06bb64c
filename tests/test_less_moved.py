"""What the two runs of a trace move: shuffles of whole rows, and columns that nothing reads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.operators import dedup
from folioflow.operators.embed import letter_counts
from folioflow.sources.tables import KeyedTable
from folioflow.streaming import landing as stream


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "3", 3)], "id string, text string, n int")
    made = KeyedTable(spark, str(tmp_path / "table"), rows.schema, ["id"])
    made.upsert(rows, "one")
    return made


def test_one_put_alone_is_read_without_a_shuffle(spark, table):
    """F2"""
    assert "Exchange" not in plan(table.read())
    assert sorted(map(tuple, table.read().collect())) == [("a", "2", 2), ("b", "3", 3)]


def test_the_newest_row_of_several_puts(spark, table):
    table.upsert(spark.createDataFrame([("a", None, None), ("c", "5", 5), (None, "6", 6)], table.schema), "two")
    want = [("a", None, None), ("b", "3", 3), ("c", "5", 5), (None, "6", 6)]
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(want, key=str)
    table.compact()
    table.upsert(spark.createDataFrame([("b", "7", 7)], table.schema), "three")
    want[1] = ("b", "7", 7)
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(want, key=str)


def test_some_columns_of_many_keys(spark, table):
    keys = spark.createDataFrame([("a",), ("x",)], "id string")
    table.upsert(spark.createDataFrame([("a", "9", 9)], table.schema), "two")
    found = table.get_many(keys, ["n"])
    assert found.columns == ["id", "n"] and found.collect() == [("a", 9)]
    assert "text" not in plan(found)
    table.compact()
    assert table.get_many(keys, ["n"]).collect() == [("a", 9)]
    empty = KeyedTable(spark, table.path + "-empty", table.schema, ["id"])
    assert empty.get_many(keys, ["n"]).columns == ["id", "n"]


def test_rows_told_apart_are_not_shuffled_by_their_key_again(spark):
    """the rows after the choice of one per key are known to be dealt by it."""
    rows = spark.range(100).select(F.concat(F.lit("k"), F.col("id") % 7).alias("key"), F.col("id").alias("n"))
    first = dedup.first_per_key(rows, "key", F.col("n"))
    assert first.columns == ["key", "n"]
    assert plan(dedup.last_per_key(first, "key", F.col("n"))).count("Exchange") == 1
    assert sorted(map(tuple, first.collect())) == [(f"k{i}", i) for i in range(7)]


def test_keys_that_compare_equal_but_differ_stay_those_of_the_row(spark):
    rows = spark.createDataFrame([(-0.0, 1), (0.0, 2)], "key double, n int")
    assert str(dedup.first_per_key(rows, "key", F.col("n")).collect()[0]["key"]) == "-0.0"


def test_a_second_run_shuffles_whole_rows_of_its_own_papers_only(spark, tmp_path):
    """which papers these are is told from narrow rows; an index entry that a later trace has taken over is left alone."""
    store = stream.Store(spark, str(tmp_path / "store"))
    schema = store.papers.schema
    rows = spark.createDataFrame([(f"p{i}", "t1", f"title {i}", "") for i in range(5)], "paper_id string, trace_id string, title string, abstract string")
    papers = rows.select(*(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
    store.papers.upsert(papers, "t1")
    store.papers_by_trace.upsert(papers.select("trace_id", "paper_id"), "t1")
    store.papers.upsert(papers.where("paper_id = 'p4'").withColumn("trace_id", F.lit("t2")), "t2")

    def only_odd():
        def encode(texts):
            if any(int(t.rstrip(". ")[-1]) % 2 == 0 for t in texts):
                raise ValueError("even")
            return np.ones((len(texts), 2))
        return encode

    stream.vectorize(store, "t1", only_odd, "m", attempt="first")
    stream.revectorize(store, "t1", letter_counts, "m", attempt="second")
    results = {r["attempt"]: (r["total_papers"], r["vectors_stored"]) for r in store.vector_results.read().collect()}
    assert results["second"][0] == results["second"][1]
    stored = {r["paper_id"]: r["t"] for r in store.vectors.read().select("paper_id", F.col("source_text.content").alias("t")).collect()}
    assert {"p0", "p1", "p2", "p3"} <= set(stored) and all(stored.values())
    assert store.papers_of("t1", ["trace_id"]).columns == ["paper_id", "trace_id"]
