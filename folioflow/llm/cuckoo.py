"""Exact deduplication with a sharded cuckoo-filter index.

A text is its SHA-256 after white space is taken out. Digests are dealt to shards; each
shard keeps a cuckoo filter of 16-bit fingerprints before the stored digests. A digest
that the filter doesn't know is new and the store isn't read; a hit is verified against
the stored digests of its bucket. An overflow doubles the filter and fills it again from
the stored keys. Copies are counted up in each Arrow batch before they are dealt out, so
a group with a third of all rows reaches its shard as one row per batch.

Cases: null and empty texts, and texts of white space only, are equal to each other. Rows
that tie in length and id share their fate. Rows with a null id count, but stay behind
those with one. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import materialize

#: Deleted before texts are compared. Fixed: [\x20\x09-\x0D].
WHITE_SPACE = b" \t\n\x0b\x0c\r"
#: Digests in a shard, which one task holds.
SHARD_ROWS = 500_000
SLOTS, KICKS = 4, 200
NO_ID = (1 << 63) - 1


class CuckooFilter:
    """Fingerprints of digests, with deletion. `add` returns False when the table is too full."""

    def __init__(self, buckets: int = 64):
        self.buckets = buckets  # a power of two
        self.table: list[list[int]] = [[] for _ in range(buckets)]

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "big") + 1
        at = int.from_bytes(digest[2:10], "big") & (self.buckets - 1)
        return mark, at, self._other(at, mark)

    def _other(self, at: int, mark: int) -> int:
        return (at ^ (mark * 0x5BD1E995 >> 3)) & (self.buckets - 1)

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.table[a] or mark in self.table[b]

    def add(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        at = a if len(self.table[a]) < SLOTS else b
        for kick in range(KICKS):
            bucket = self.table[at]
            if len(bucket) < SLOTS:
                bucket.append(mark)
                return True
            bucket[kick % SLOTS], mark = mark, bucket[kick % SLOTS]
            at = self._other(at, mark)
        return False

    def remove(self, digest: bytes) -> None:
        mark, a, b = self._places(digest)
        (self.table[a] if mark in self.table[a] else self.table[b]).remove(mark)


class CuckooIndex:
    """Live digests of a shard: per digest how many rows, and of them the longest with the smallest id."""

    def __init__(self) -> None:
        self.filter = CuckooFilter()
        self.stored: dict[bytes, dict[bytes, list[int]]] = {}
        self.verified = self.resized = 0

    def _entry(self, digest: bytes) -> list[int] | None:
        if digest not in self.filter:
            return None
        self.verified += 1
        return self.stored.get(digest[:3], {}).get(digest)

    def insert(self, digest: bytes, rows: int, chars: int, doc: int) -> bool:
        """True if the digest was new."""
        entry = self._entry(digest)
        if entry is not None:
            entry[0] += rows
            if (-chars, doc) < (-entry[1], entry[2]):
                entry[1:] = chars, doc
            return False
        self.stored.setdefault(digest[:3], {})[digest] = [rows, chars, doc]
        if not self.filter.add(digest):
            self._resize()
        return True

    def delete(self, digest: bytes, rows: int) -> bool:
        """True if the digest was live. The last row takes the digest with it; `delete` below chooses anew which row stays."""
        entry = self._entry(digest)
        if entry is None:
            return False
        entry[0] -= rows
        if entry[0] <= 0:
            del self.stored[digest[:3]][digest]
            self.filter.remove(digest)
        return True

    def _resize(self) -> None:
        """A filter of twice the size, filled from the stored keys: fingerprints alone can't be moved to it."""
        self.resized += 1
        buckets = self.filter.buckets * 2
        while True:
            self.filter = CuckooFilter(buckets)
            if all(self.filter.add(d) for bucket in self.stored.values() for d in bucket):
                return
            buckets *= 2

    def entries(self) -> Iterator[tuple[bytes, int, int, int]]:
        for bucket in self.stored.values():
            for digest, entry in bucket.items():
                yield digest, *entry


def _digest_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        found = [hashlib.sha256(t.as_buffer().to_pybytes().translate(None, WHITE_SPACE)).digest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.binary()), pc.cast(pc.utf8_length(texts), pa.int64())], ["doc_id", "digest", "chars"])


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest of the text without white space, and the code points of the text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_digest_batches, "doc_id bigint, digest binary, chars bigint")


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest of a batch, with the row that would stay."""
    for batch in batches:
        if not batch.num_rows:
            continue
        digests = batch.column(1).to_pylist()
        chars = batch.column(2).to_numpy(zero_copy_only=False)
        ids = pc.fill_null(batch.column(0), NO_ID).to_numpy(zero_copy_only=False)
        best: dict[bytes, list] = {}
        for i in np.lexsort((ids, -chars)).tolist():
            best.setdefault(digests[i], [0, chars[i], ids[i]])[0] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.keys(), pa.binary()), *(pa.array([v[k] for v in best.values()], pa.int64()) for k in range(3))],
            ["digest", "rows", "chars", "keep_id"])


INDEX = "digest binary, rows bigint, chars bigint, keep_id bigint"


def _run_shard(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows above zero are insertions, below zero deletions; insertions are taken first."""
    index, gone = CuckooIndex(), []
    for batch in batches:
        for digest, rows, chars, doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows > 0:
                index.insert(digest, rows, chars, doc)
            else:
                gone.append((digest, -rows))
    for digest, rows in gone:
        index.delete(digest, rows)
    live = list(index.entries())
    for i in range(0, len(live), 10_000):
        columns = zip(*live[i : i + 10_000], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
            ["digest", "rows", "chars", "keep_id"])


def insert(digests: DataFrame, index: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """The index (digest, rows, chars, keep_id) with the rows of `text_digests` put in."""
    return _apply(digests.select("doc_id", "digest", "chars").mapInArrow(_count_batches, INDEX), index, total or digests.count())


def delete(digests: DataFrame, index: DataFrame, rows: DataFrame) -> DataFrame:
    """The index without these rows; a digest goes when none of its rows is left.

    `rows` are those that are left in the index (as `text_digests` gives them). Where the row
    that stayed is among the deleted ones, the row that stays now is chosen from them.
    """
    counted = digests.select("doc_id", "digest", "chars").mapInArrow(_count_batches, INDEX)
    left = materialize(_apply(counted.withColumn("rows", -F.col("rows")), index, digests.count()), "index-left")
    gone = digests.select("digest", F.coalesce("doc_id", F.lit(NO_ID)).alias("keep_id")).distinct()
    lost = left.join(gone, ["digest", "keep_id"], "left_semi").select("digest")
    again = rows.join(lost, "digest", "left_semi").select("doc_id", "digest", "chars").mapInArrow(_count_batches, INDEX)
    best = again.groupBy("digest").agg(F.min(F.struct((-F.col("chars")).alias("chars"), "keep_id")).alias("best"))
    chosen = left.join(best, "digest", "left")
    return chosen.select("digest", "rows", *(F.coalesce(F.when(F.col("best").isNotNull(), v), F.col(n)).alias(n) for n, v in (
        ("chars", -F.col("best.chars")), ("keep_id", F.col("best.keep_id")))))


def _apply(changes: DataFrame, index: DataFrame | None, total: int) -> DataFrame:
    shards = max(total // SHARD_ROWS + 1, int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    every = changes if index is None else index.select(*changes.columns).unionByName(changes)
    return every.repartition(shards, "digest").mapInArrow(_run_shard, INDEX)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the longest stays, then the smallest id."""
    digests = materialize(text_digests(docs, id_col, text_col), "digests")
    index = materialize(insert(digests), "dedup-index").select("digest", "rows", "keep_id")
    keep = F.when(F.col("keep_id") != NO_ID, F.col("keep_id"))
    return digests.join(index, "digest").select(
        "doc_id", keep.alias("keep_id"), F.col("rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
