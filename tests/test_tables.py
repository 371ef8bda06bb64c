"""Keyed tables: upsert, repeats, copies within a batch, and filters that reach the scan."""

import os
import random

import pytest
from plan_metrics import files_read
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow import session
from folioflow.session import scratch_dir
from folioflow.sources.tables import KeyedTable

SCHEMA = T.StructType([
    T.StructField("k", T.StringType()), T.StructField("t", T.StringType()), T.StructField("v", T.LongType()),
])


@pytest.fixture()
def table(spark):
    return KeyedTable(spark, scratch_dir(spark, "table"), SCHEMA, ["k", "t"], sort_by=("t",), buckets=4)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_empty(spark, table):
    assert content(table) == []
    table.upsert(frame(spark, []))
    assert content(table) == []
    table.upsert(frame(spark, [("a", "x", 1)]))
    table.upsert(frame(spark, []))
    assert content(table) == [("a", "x", 1)]


def test_last_write_wins(spark, table):
    table.upsert(frame(spark, [("a", "x", 1), ("b", "x", 1)]))
    table.upsert(frame(spark, [("a", "x", 2), ("a", "y", 2)]))
    table.upsert(frame(spark, [("a", "x", 3)]))
    assert content(table) == [("a", "x", 3), ("a", "y", 2), ("b", "x", 1)]


def test_last_of_a_batch_wins(spark, table):
    table.upsert(frame(spark, [("a", "x", 1), ("a", "x", 2), ("b", "x", 5), ("a", "x", 3)]).coalesce(1))
    assert content(table) == [("a", "x", 3), ("b", "x", 5)]


def test_repeats_change_nothing(spark, table):
    rng, expected = random.Random(1), {}
    for i in range(6):
        rows = {(f"k{rng.randrange(12)}", "x"): i for _ in range(5)}
        expected.update(rows)
        for _ in range(1 + i % 2):
            table.upsert(frame(spark, [(*k, v) for k, v in rows.items()]))
        assert content(table) == sorted((*k, v) for k, v in expected.items())


def test_filters_reach_the_scan(spark, table):
    table.upsert(frame(spark, [("a", "x", 1), ("a", "y", 2)]))
    table.compact()
    plan = table.read().where("k = 'a' and t = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,a)" in plan and "EqualTo(t,x)" in plan and "Exchange" not in plan


def test_a_named_put_replaces_itself(spark, table):
    table.upsert(frame(spark, [("a", "x", 1), ("b", "x", 1)]), "odd/name %20=é")
    table.upsert(frame(spark, [("b", "x", 9)]), "other")
    table.upsert(frame(spark, [("a", "x", 2)]), "odd/name %20=é")
    assert content(table) == [("a", "x", 2), ("b", "x", 9)]
    assert sorted(tuple(r) for r in table.read_put("odd/name %20=é").collect()) == [("a", "x", 2)]
    assert table.read_put("unknown") is None


def test_compaction_keeps_the_rows(spark, table):
    rng, expected = random.Random(2), {}
    for i in range(8):
        rows = {(f"k{rng.randrange(12)}", "xy"[i % 2]): i for _ in range(5)}
        expected.update(rows)
        table.upsert(frame(spark, [(*k, v) for k, v in rows.items()]), f"put {i}")
        if i % 3 == 2:
            table.compact()
            assert table.read_put(f"put {i}") is None and session.list_names(spark, f"{table.path}/puts") == []
        assert content(table) == sorted((*k, v) for k, v in expected.items())
    assert len(session.list_names(spark, f"{table.path}/base")) == 1


def test_a_put_after_a_compaction_with_its_name(spark, table):
    table.upsert(frame(spark, [("a", "x", 1)]), "t")
    table.compact()
    table.upsert(frame(spark, [("a", "x", 2)]), "t")
    assert content(table) == [("a", "x", 2)]


def test_unfinished_writes_are_not_seen(spark, table):
    """A put without its last file, and a compaction that stopped before or after its layout."""
    table.upsert(frame(spark, [("a", "x", 1)]), "t")
    table.upsert(frame(spark, [("a", "x", 2), ("b", "x", 2)]), "u")
    folder = max(session.list_names(spark, f"{table.path}/puts"))
    session.remove(spark, f"{table.path}/puts/{folder}/_SUCCESS")
    assert content(table) == [("a", "x", 1)]
    frame(spark, [("z", "z", 0)]).withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"{table.path}/base/0000000002")
    assert content(table) == [("a", "x", 1)]
    table.compact()  # goes over what a stopped one has left
    assert content(table) == [("a", "x", 1)]
    layout = table.layout()
    frame(spark, [("a", "x", 0)]).withColumns({"_written": F.lit(int(layout.folded[0])), "_bucket": F.lit(0)}).write.partitionBy("_bucket").parquet(
        f"{table.path}/puts/_put={layout.folded[0]}-t")  # as if it had stopped before the deletion
    assert content(table) == [("a", "x", 1)]


def test_number_of_buckets(spark, table):
    rows = [(f"k{i}", "x", i) for i in range(200)]
    table.upsert(frame(spark, rows))
    other = KeyedTable(spark, table.path, SCHEMA, ["k", "t"], buckets=8)
    with pytest.raises(ValueError, match="has 4 buckets, not 8"):
        other.upsert(frame(spark, rows[:3]))
    with pytest.raises(ValueError, match="has 4 buckets"):
        other.read()
    table.rebucket(8)
    other.upsert(frame(spark, [("k1", "x", -1)]))
    assert content(table) == content(other) == sorted([*(r for r in rows if r[0] != "k1"), ("k1", "x", -1)])
    assert KeyedTable(spark, table.path, SCHEMA, ["k", "t"]).layout().buckets == 8


def test_one_bucket_is_opened_for_a_key(spark):
    table = KeyedTable(spark, scratch_dir(spark, "table"), SCHEMA, ["k", "t"], buckets=16, bucket_by=("k",))
    table.upsert(frame(spark, [(f"k{i}", t, i) for i in range(300) for t in "xy"]))
    table.compact()
    table.upsert(frame(spark, [("k7", "x", -7), ("new", "x", 0)]))
    one = table.get(k="k7", t="x")
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in text and "EqualTo(k,k7)" in text
    assert [tuple(r) for r in one.collect()] == [("k7", "x", -7)] and files_read(one) <= 2
    assert sorted(tuple(r) for r in table.get(k="k7").collect()) == [("k7", "x", -7), ("k7", "y", 7)]
    assert sorted(tuple(r) for r in table.get(t="y").collect()) == sorted((f"k{i}", "y", i) for i in range(300))
    assert table.get(k="nobody").collect() == []

    keys = spark.createDataFrame([(1, "k7"), (2, "k9"), (3, "k9"), (4, "k300")], "n int, k string").where("n < 4")
    many = table.get_many(keys)
    assert sorted(tuple(r) for r in many.collect()) == [("k7", "x", -7), ("k7", "y", 7), ("k9", "x", 9), ("k9", "y", 9)]


def test_keys_of_a_frame_prune_buckets_at_run_time(spark):
    table = KeyedTable(spark, scratch_dir(spark, "table"), SCHEMA, ["k", "t"], buckets=16, bucket_by=("k",))
    table.upsert(frame(spark, [(f"k{i}", "x", i) for i in range(300)]))
    table.compact()
    path = scratch_dir(spark, "keys")
    spark.createDataFrame([(i, f"k{i}") for i in range(300)], "n int, k string").write.parquet(path)
    many = table.get_many(spark.read.parquet(path).where("n = 42"))
    assert "dynamicpruning" in many._jdf.queryExecution().executedPlan().toString().lower()
    assert [tuple(r) for r in many.collect()] == [("k42", "x", 42)]
    assert files_read(many) <= 1 + len([f for f in os.listdir(path) if f.endswith(".parquet")])


def test_no_scratch_is_used(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_dir", lambda spark, name: 1 / 0)
    table = KeyedTable(spark, str(tmp_path / "table"), SCHEMA, ["k", "t"])
    for v in (1, 2):
        table.upsert(frame(spark, [("a", "x", v)]))
    assert content(table) == [("a", "x", 2)]


def test_scratch_scopes(spark, tmp_path, monkeypatch):
    """A scope deletes what is named in it and not in a scope within; nothing outside."""
    monkeypatch.setattr(session, "scratch_base", lambda spark: str(tmp_path))
    names = lambda: sorted(n.partition("-")[0] for n in os.listdir(tmp_path) if n[0] != ".")
    out = session.materialize(frame(spark, [("a", "x", 1)]), "outside")
    assert names() == ["outside"]
    with session.scratch_scope(spark):
        one = session.materialize(frame(spark, [("a", "x", 2)]), "one")
        with session.scratch_scope(spark):
            session.materialize(one, "two")
            scratch_dir(spark, "unwritten")
            assert names() == ["one", "outside", "two"]
        assert one.count() == 1 and names() == ["one", "outside"]
    assert out.count() == 1 and names() == ["outside"]
