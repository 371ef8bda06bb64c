"""Writes in batches whose outcome the sink decides."""

import sys
from collections import defaultdict

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.operators import batches
from folioflow.session import scratch_dir
from folioflow.sources import batch_sink
from folioflow.sources.tables import KeyedTable

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers do not see this file

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("g", T.StringType()), T.StructField("no", T.LongType()), T.StructField("bad", T.StringType())])


def items(spark, n=230, bad=(3, 77, 78, 200)):
    """Two groups, one with three quarters of the rows and one of nulls, in no order."""
    rows = [(f"k{i}", None if i % 4 == 0 else "a", i, f"bad {i}" if i in bad else None) for i in range(n)]
    return spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)


def expected(n=230, bad=(3, 77, 78, 200)):
    """(group, batch) -> (numbers of its rows, error)."""
    out = defaultdict(list)
    seen = defaultdict(int)
    for i in range(n):
        g = "" if i % 4 == 0 else "a"
        out[g, seen[g] // 25].append(i)
        seen[g] += 1
    return {b: (rows, next((f"bad {i}" for i in rows if i in bad), None)) for b, rows in out.items()}


def outcome_rows(outcomes):
    found = defaultdict(list)
    for r in outcomes.collect():
        found[r["g"] or "", r["batch_no"]].append((r["no"], r["error"]))
    return {b: (sorted(n for n, _ in rows), {e for _, e in rows}) for b, rows in found.items()}


def test_a_table_refuses_whole_batches(spark):
    table = KeyedTable(spark, scratch_dir(spark, "table"), SCHEMA, ["k"])
    outcomes = batch_sink.put_batches(table, items(spark), F.col("bad"), "g", "no")
    wanted = expected()
    assert outcome_rows(outcomes) == {b: (rows, {error}) for b, (rows, error) in wanted.items()}
    assert sorted(r.no for r in table.read().collect()) == sorted(i for rows, error in wanted.values() if error is None for i in rows)
    stats = batches.upsert_stats(outcomes, ["g", "batch_no"], F.col("error").isNotNull()).first()
    failed = [rows for rows, error in wanted.values() if error]
    assert (stats.total_items, stats.failed_items, stats.failed_batches) == (230, sum(map(len, failed)), len(failed))
    assert stats.success_batches == len(wanted) - len(failed)


def client(path):
    """Refuses batches with a bad row, leaves all but one row over on every call, and notes what it has stored."""
    import os
    import uuid

    def put(rows):
        for reason in rows["bad"].to_pylist():
            if reason:
                raise ValueError(reason)
        taken = rows.slice(0, 10)
        with open(os.path.join(path, uuid.uuid4().hex), "w") as out:
            out.write(",".join(map(str, taken["no"].to_pylist())))
        return list(range(10, rows.num_rows))

    return put


@pytest.mark.parametrize("attempts", [2, 3])
def test_a_client_gets_batches_in_order_and_what_it_left_over(spark, tmp_path, attempts):
    folder = str(tmp_path)
    outcomes = batch_sink.send_batches(items(spark), lambda: client(folder), "g", "no", attempts=attempts)
    for b, (rows, errors) in outcome_rows(outcomes).items():
        own, error = expected()[b]
        assert rows == own
        if error:
            assert errors == {f"ValueError: {error}"}
        elif attempts * 10 < len(own):
            assert errors == {f"failed to process {len(own) - attempts * 10} items after {attempts} attempts"}
        else:
            assert errors == {None}
    stored = [list(map(int, f.read_text().split(","))) for f in tmp_path.iterdir()]
    assert all(s == sorted(s) and len(s) <= 10 for s in stored)
    good = [i for rows, error in expected().values() if error is None for i in rows[: attempts * 10]]
    assert sorted(i for s in stored for i in s) == sorted(good)


def test_nothing_to_send(spark):
    assert batch_sink.send_batches(items(spark).limit(0), lambda: 1 / 0, "g", "no").collect() == []
    table = KeyedTable(spark, scratch_dir(spark, "table"), SCHEMA, ["k"])
    assert batch_sink.put_batches(table, items(spark).limit(0), F.col("bad"), "g", "no").collect() == []
