"""Importance resampling towards a target: hashed n-gram weights, Gumbel scores, the top by distributed quickselect.

Features are all runs of some consecutive words, hashed to buckets. One pass counts the
buckets of the documents and of the target (an array of BUCKETS counts on the driver,
whatever the data); a second one scores every document by the array of gains. The scores
are written once. The key of the last document that is drawn is found by quickselect: a
few random keys cut the candidates in three ways each (below, equal, above), the counts of
all parts are exact, and only the part that holds the place goes on. The rows up to that
key, and no others, are sorted by range and ranked.

Keys are (score descending, doc_id, n_features, row), with null ids last; the row number
only tells repeated rows apart, so that no key is shared and exactly so many are drawn.

Cases: null and empty texts and those without words have no features and weight 0. Rows
with a null id draw with the name `<seed>:`. Without target or documents all counts are 0,
which the formula allows. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.texts import SLICE_BYTES, WORD_BYTE, flat, slices
from folioflow.llm.word_strings import word_runs
from folioflow.session import materialize, remove, scratch_dir

BUCKETS = 10_000
#: Random keys of a round of the selection; a round leaves one of twice as many parts, about.
PIVOTS = 15
ORDER = "struct<score:bigint,no_id:int,doc_id:bigint,n_features:bigint,row:bigint>"


def _buckets(body: np.ndarray, at: np.ndarray, grams: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of each feature, its row, and the words of each row. Each different feature is hashed once."""
    runs, row, words = word_runs(body, at, WORD_BYTE, grams, lower=True)
    encoded = runs.dictionary_encode()
    crc = np.fromiter(map(zlib.crc32, encoded.dictionary.to_pylist()), np.int64, len(encoded.dictionary)) % BUCKETS
    return crc[encoded.indices.to_numpy(zero_copy_only=False)], row, words


def _count(grams: tuple[int, int]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            body, at = flat(batch.column(0))
            for first, last in slices(at, SLICE_BYTES):
                found, _, _ = _buckets(body[at[first] : at[last]], at[first : last + 1] - at[first], grams)
                total += np.bincount(found, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    return count


def bucket_counts(texts: DataFrame, text_col: str = "text", grams: tuple[int, int] = (1, 1)) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends one row per bucket."""
    found = texts.select(F.col(text_col).alias("text")).mapInArrow(_count(grams), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in found:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds: the logarithm of its smoothed share in the target over that in the source, in thousandths."""
    s_all, t_all = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log(((t + 1.0) * s_all) / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weigh(gain: np.ndarray, grams: tuple[int, int]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, at = flat(batch.column(1))
            for first, last in slices(at, SLICE_BYTES):
                found, row, words = _buckets(body[at[first] : at[last]], at[first : last + 1] - at[first], grams)
                features = np.bincount(row, minlength=last - first)
                sums = np.zeros(last - first, np.int64)
                np.add.at(sums, row, gain[found])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], pa.array(words, pa.int64()), pa.array(features, pa.int64()), pa.array(sums // np.maximum(features, 1), pa.int64())],
                    ["doc_id", "n_words", "n_features", "weight"])

    return weigh


def scored(docs: DataFrame, target: DataFrame, grams: tuple[int, int] = (1, 1), seed: str = "2024", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight and score (the weight and a Gumbel number drawn from seed and id) of every document."""
    gain = gains(bucket_counts(docs, text_col, grams), bucket_counts(target, "text", grams))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    weighed = rows.mapInArrow(_weigh(gain, grams), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weighed.withColumn("score", F.col("weight") + gumbel.cast("long"))


def _key() -> Column:
    return F.struct(
        (-F.col("score")).alias("score"), F.col("doc_id").isNull().cast("int").alias("no_id"),
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), "n_features", "row").cast(ORDER)


def _literal(key: tuple) -> Column:
    return F.struct(*(F.lit(v) for v in key)).cast(ORDER)


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> tuple | None:
    """The k-th smallest `key` of the rows, from 1; None where k is not among them.

    Every round writes the candidates that are left to the shared folder, so that the next one reads no more.
    """
    spark, left, path = rows.sparkSession, rows.select("key"), None
    try:
        while k >= 1:
            chosen = sorted({tuple(r.key) for r in left.orderBy(F.rand(k)).limit(pivots).collect()})
            if not chosen:
                return None
            # 2 for a pivot below the row's key, 1 for an equal one: odd sums are equal to a pivot, even ones lie between two.
            part = reduce(add, (F.when(F.col("key") > p, 2).when(F.col("key") == p, 1).otherwise(0) for p in map(_literal, chosen)))
            counts = {r.part: r["count"] for r in left.groupBy(part.alias("part")).count().collect()}
            at = 0
            while at <= 2 * len(chosen) and k > counts.get(at, 0):
                k -= counts.get(at, 0)
                at += 1
            if at > 2 * len(chosen):
                return None
            if at % 2:
                return chosen[at // 2]
            inside = F.lit(True)
            if at:
                inside &= F.col("key") > _literal(chosen[at // 2 - 1])
            if at < 2 * len(chosen):
                inside &= F.col("key") < _literal(chosen[at // 2])
            before, path = path, scratch_dir(spark, "candidates")
            left.where(inside).write.parquet(path)
            if before:
                remove(spark, before)
            left = spark.read.schema(rows.select("key").schema).parquet(path)
        return None
    finally:
        if path:
            remove(spark, path)


def ranked(rows: DataFrame) -> DataFrame:
    """The rows with `rank` by `key`, from 1: sorted by range, each range numbered apart behind the counts of those before it."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(rows.repartitionByRange(n, "key").withColumn("range", F.spark_partition_id()), "winners")
    counts = sorted((r.range, r["count"]) for r in dealt.groupBy("range").count().collect())  # one row per range
    before = dict(zip((r for r, _ in counts), np.cumsum([0, *(c for _, c in counts)]).tolist(), strict=False))
    own = F.row_number().over(Window.partitionBy("range").orderBy("key")).cast("long")
    if not before:
        return dealt.withColumn("rank", own)
    offset = F.element_at(F.create_map(*(F.lit(v) for r, b in before.items() for v in (r, b))), F.col("range"))
    return dealt.withColumn("rank", own + offset)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, grams: tuple[int, int] = (1, 1), seed: str = "2024",
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every document with doc_id, n_features, weight, score and rank; rank is null for those that are not drawn."""
    rows = materialize(scored(docs, target, grams, seed, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "scores")
    rows = rows.withColumn("key", _key())
    able = rows.where(F.col("n_words") >= least_words)
    last = kth_key(able, percent * able.count() // 100)
    out = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= least_words) & (F.col("key") <= _literal(last))
    rest = rows.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked(rows.where(drawn).select(*out, "key")).select(*out, "rank").unionByName(rest)
