"""Ordered operators against brute force, with hot groups that span many blocks."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from folioflow.operators import alerts, batches, dedup


def hot_rows(n=900, seed=3):
    rng = random.Random(seed)
    numbers = rng.sample(range(10 * n), n)
    return [(no, "hot" if rng.random() < 0.6 else rng.choice("abcde"), rng.choice(["k1", "k2", f"u{no}", ""]))
            for no in numbers]


@pytest.fixture(scope="module")
def rows():
    return hot_rows()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "record_no long, trace_id string, paper_id string").repartition(7).cache()


@pytest.mark.parametrize("block", [1, 50, 1_000, 100_000])
def test_number_rows(frame, rows, block):
    expected, seen = {}, {}
    for no, trace, _ in sorted(rows):
        seen[trace] = seen.get(trace, 0) + 1
        expected[no] = seen[trace]
    got = {r.record_no: r.row_no for r in batches.number_rows(frame, "trace_id", "record_no", block).collect()}
    assert got == expected


def test_null_group_is_numbered_whole(spark):
    df = spark.createDataFrame([(i, None) for i in range(60)], "record_no long, trace_id string")
    got = batches.with_batch_no(df, "trace_id", "record_no").groupBy("batch_no").count().collect()
    assert sorted((r.batch_no, r["count"]) for r in got) == [(0, 25), (1, 25), (2, 10)]


def test_deduplicate_keeps_first(frame, rows):
    first = {}
    for no, trace, key in sorted(rows):
        if key:
            first.setdefault(key, (no, trace, key))
    got = {tuple(r) for r in dedup.deduplicate(frame, F.col("record_no")).collect()}
    assert got == set(first.values())


def test_dedup_stats_add_up(frame, rows):
    row = dedup.dedup_stats(frame).first()
    keys = [k for _, _, k in rows]
    assert row.original_count == len(rows)
    assert row.unique_count == len({k for k in keys if k})
    assert row.invalid_count == keys.count("")
    assert row.unique_count + row.duplicate_count + row.invalid_count == row.original_count


def test_dedup_stats_of_nothing(frame):
    assert tuple(dedup.dedup_stats(frame.limit(0)).first()) == (0, 0, 0, 0)


def test_upsert_stats_fail_whole_batches(frame):
    numbered = batches.with_batch_no(frame, "trace_id", "record_no")
    row = batches.upsert_stats(numbered, ["trace_id", "batch_no"], F.col("record_no") % 97 == 0).first()
    assert row.success_items + row.failed_items == row.total_items == 900
    assert row.success_batches + row.failed_batches == row.batch_count
    assert row.failed_batches > 0 and row.failed_items > row.failed_batches


@pytest.mark.parametrize("segment", [10, 37, 100_000])
def test_rolling_bounds(spark, segment):
    rng = random.Random(5)
    data = [(f"t{i}", i * 3, rng.random()) for i in range(120)]
    df = spark.createDataFrame(data, "trace_id string, batch_order long, duplicate_rate double").repartition(5)
    got = {r.trace_id: r for r in alerts.rolling_bounds(df, 8, 1.5, segment).collect()}
    assert len(got) == len(data)
    for i, (trace, _, rate) in enumerate(data):
        before = [x for _, _, x in data[max(0, i - 8):i]]
        row = got[trace]
        if before:
            assert row.mean_rate == pytest.approx(sum(before) / len(before))
        else:
            assert row.mean_rate is None
        if len(before) > 1:
            sd, mean = statistics.stdev(before), sum(before) / len(before)
            assert row.sd_rate == pytest.approx(sd)
            assert row.outside == (rate < mean - 1.5 * sd or rate > mean + 1.5 * sd)
        else:
            assert row.sd_rate is None and row.outside is False
