"""Importance resampling, against a plain version; the selection, against a sort."""

import hashlib
import math
import random
import zlib
from collections import Counter

import fixtures as fx
import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import importance, texts, word_strings


def features(text, grams):
    w = fx.lower_words(text)
    return [" ".join(w[i : i + n]) for n in range(grams[0], grams[1] + 1) for i in range(len(w) - n + 1)]


def brute_force(docs, target, percent, least, grams):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s = Counter(bucket(f) for _, t in docs for f in features(t, grams))
    t = Counter(bucket(f) for x in target for f in features(x, grams))
    s_all, t_all = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    rows = []
    for d, text in docs:
        own = features(text, grams)
        gains = [math.floor(1000 * math.log((t[bucket(f)] + 1) * s_all / ((s[bucket(f)] + 1) * t_all))) for f in own]
        weight = sum(gains) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(fx.lower_words(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = i
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize(("percent", "least", "grams"), [(10, 20, (1, 1)), (50, 1, (1, 2)), (100, 0, (2, 3)), (0, 20, (1, 1))])
def test_odd_documents(spark, percent, least, grams):
    docs = fx.documents(spark, [(200, "Kelvin K ÄÖİ a-b_c", "en", "a"), (201, "x" * 100_000, None, None)]).withColumnRenamed("hash", "weight").withColumnRenamed("row", "key")
    target = spark.createDataFrame([(1, fx.prose(2, 120), "odd"), (2, None, "odd"), (3, "an the", "odd"), (None, "", "odd")], "item_id bigint, text string, bucket string")
    found = importance.resample(docs, target, percent, least, grams).collect()
    wanted = brute_force(fx.pairs(docs), [r["text"] for r in target.collect()], percent, least, grams)
    assert sorted((tuple(r) for r in found), key=repr) == wanted


def test_empty_tables(spark):
    docs = fx.documents(spark)
    target = spark.createDataFrame([], "item_id bigint, text string")
    assert importance.resample(fx.empty(spark), target).collect() == []
    found = importance.resample(docs, target).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_force(fx.pairs(docs), [], 10, 20, (1, 1))


@pytest.mark.parametrize("pivots", [1, 4, 15])
def test_selection_equals_sort(spark, pivots):
    r = random.Random(pivots)
    rows = [(r.randint(0, 40), r.choice([None, *range(50)]), r.randint(0, 3), i) for i in range(700)]
    df = spark.createDataFrame(rows, "score bigint, doc_id bigint, n_features bigint, row bigint").withColumn("key", importance._key())
    keys = sorted((-s, int(d is None), d or 0, n, i) for s, d, n, i in rows)
    for k in (1, 2, 350, 699, 700):
        assert importance.kth_key(df, k, pivots) == keys[k - 1]
    assert importance.kth_key(df, 0) is None and importance.kth_key(df, 701) is None
    ranks = importance.ranked(df.where(F.col("row") < 500)).select("row", "rank").collect()
    assert [x["row"] for x in sorted(ranks, key=lambda x: x["rank"])] == [k[4] for k in keys if k[4] < 500]
    assert sorted(x["rank"] for x in ranks) == list(range(1, 501))


def test_word_runs():
    body, at = texts.flat(__import__("pyarrow").array(["One two, THREE", None, "", "x", "a b c d"]))
    runs, row, words = word_strings.word_runs(body, at, texts.WORD_BYTE, (2, 3), lower=True)
    assert list(zip(row.tolist(), [x.decode() for x in runs.to_pylist()], strict=True)) == [
        (0, "one two"), (0, "two three"), (4, "a b"), (4, "b c"), (4, "c d"), (0, "one two three"), (4, "a b c"), (4, "b c d")]
    assert words.tolist() == [3, 0, 0, 1, 4] and np.bincount(row).tolist() == [3, 0, 0, 0, 5]
