"""Keyed Parquet tables: a put appends its own files, reads take the newest row per key, a compaction folds puts.

    <path>/layout/<version>.json    number of buckets, folder of the base, puts that are in it
    <path>/base/<version>/_bucket=<b>/…    one row per key, sorted, with Bloom filters on the keys
    <path>/puts/_put=<stamp>-<name>/_bucket=<b>/…    the rows of one put, one per key

So a put reads and writes what it brings, however large the table is. Reading joins the
base with the keys of the puts since the last compaction. Rows lie in buckets of their key;
`get` opens the bucket of a literal key and `get_many` those of the keys of a DataFrame
(dynamic partition pruning). A put has a name, and putting it again replaces it, so a retry
is safe. A put counts once its `_SUCCESS` file is there, a compaction once its layout file
is; both appear in one step, so a reader sees all of one or nothing. A table has one writer
at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow import session
from folioflow.operators.dedup import last_per_key

BUCKETS = 16
_BUCKET, _WRITTEN = "_bucket", "_written"


@dataclass(frozen=True)
class Layout:
    """What a reader needs to know: version, buckets, the base's folder, and the stamps of the puts it holds."""

    version: int
    buckets: int
    base: str | None = None
    folded: tuple[str, ...] = ()


@dataclass
class KeyedTable:
    """`bucket_by`: the keys that choose the bucket (all of them by default).

    `sort_by`: columns by which the base is sorted, so that filters on them skip row groups.
    `buckets` is taken when the table is first written; another number afterwards is an
    error, and `rebucket` changes it.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    sort_by: tuple[str, ...] = ()
    buckets: int | None = None
    bucket_by: tuple[str, ...] = ()

    def _bucket_of(self, *values: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*values), F.lit(buckets)).cast("int")

    def _chosen_by(self) -> list[str]:
        return list(self.bucket_by or self.keys)

    def layout(self) -> Layout | None:
        """The newest layout, or None before the first put."""
        names = [n for n in session.list_names(self.spark, f"{self.path}/layout") if n.endswith(".json")]
        if not names:
            return None
        read = json.loads(session.read_text(self.spark, f"{self.path}/layout/{max(names)}"))
        layout = Layout(read["version"], read["buckets"], read["base"], tuple(read["folded"]))
        if self.buckets not in (None, layout.buckets):
            raise ValueError(f"{self.path} has {layout.buckets} buckets, not {self.buckets}; rebucket() changes that")
        return layout

    def _commit(self, layout: Layout) -> Layout:
        session.write_text(self.spark, f"{self.path}/layout/{layout.version:010d}.json", json.dumps(layout.__dict__))
        return layout

    def _puts(self, layout: Layout) -> dict[str, str]:
        """name -> folder of the puts that are complete and not in the base; of several with one name the newest."""
        found = {}
        for folder in sorted(n for n in session.list_names(self.spark, f"{self.path}/puts") if n.startswith("_put=")):
            stamp, _, name = folder.removeprefix("_put=").partition("-")
            if stamp not in layout.folded and session.exists(self.spark, f"{self.path}/puts/{folder}/_SUCCESS"):
                found[unquote(name)] = folder
        return found

    def _files(self, folders: list[str], root: str, extra: tuple[str, ...] = ()) -> DataFrame | None:
        if not folders:
            return None
        stored = T.StructType([*self.schema.fields, *(T.StructField(n, T.LongType()) for n in extra), T.StructField(_BUCKET, T.IntegerType())])
        return self.spark.read.schema(stored).option("basePath", root).parquet(*folders).select(*stored.fieldNames())

    def _parts(self, layout: Layout | None) -> tuple[DataFrame | None, DataFrame | None]:
        """The base, and the rows of the puts."""
        if layout is None:
            return None, None
        root, base = f"{self.path}/puts", f"{self.path}/{layout.base}"
        base = self._files([base], base) if layout.base else None
        return base, self._files([f"{root}/{f}" for f in sorted(self._puts(layout).values())], root, (_WRITTEN,))

    def _alone(self, layout: Layout | None) -> bool:
        """True if there are no two puts, so that no key comes twice in them."""
        return layout is None or len(self._puts(layout)) < 2

    def _newest(self, base: DataFrame | None, puts: DataFrame | None, alone: bool) -> DataFrame:
        """One row per key, with its bucket. Rows of one put alone are not shuffled for that; beside a base they are needed twice, and a shuffle is read twice."""
        keys = [_BUCKET, *self.keys]
        if puts is not None:
            puts = (puts if alone and base is None else last_per_key(puts, keys, F.col(_WRITTEN))).drop(_WRITTEN)
        if base is None or puts is None:
            rows = base if puts is None else puts
            return self.spark.createDataFrame([], self.schema).withColumn(_BUCKET, F.lit(0)) if rows is None else rows
        return base.join(puts.select(*keys), keys, "left_anti").select(*puts.columns).unionByName(puts)

    def read(self) -> DataFrame:
        layout = self.layout()
        return self._newest(*self._parts(layout), self._alone(layout)).drop(_BUCKET)

    def get(self, **key) -> DataFrame:
        """The rows of a literal key, or of the part of it that chooses the bucket: one bucket is opened."""
        layout = self.layout()
        own = F.lit(True)
        for name, value in key.items():
            own = own & (F.col(name) == F.lit(value))
        if layout is not None and set(self._chosen_by()) <= set(key):
            own = own & (F.col(_BUCKET) == self._bucket_of(*(F.lit(key[n]).cast(self.schema[n].dataType) for n in self._chosen_by()), buckets=layout.buckets))
        parts = (p if p is None else p.where(own) for p in self._parts(layout))
        return self._newest(*parts, self._alone(layout)).where(own).drop(_BUCKET)

    def get_many(self, keys: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """The rows whose key is in `keys` (which has the columns that choose the bucket); only buckets of such keys are opened.

        With `columns` only the keys and these columns are read and shuffled.
        """
        layout = self.layout()
        if layout is None:
            return self.read() if columns is None else self.read().select(*dict.fromkeys([*self.keys, *columns]))
        on = [n for n in self.keys if n in keys.columns]
        wanted = keys.select(*on).withColumn(_BUCKET, self._bucket_of(*map(F.col, self._chosen_by()), buckets=layout.buckets))
        own = self.schema.fieldNames() if columns is None else [*dict.fromkeys([*self.keys, *columns])]
        parts = (p if p is None else p.select(*own, *(c for c in (_WRITTEN, _BUCKET) if c in p.columns)).join(wanted, [_BUCKET, *on], "left_semi") for p in self._parts(layout))
        return self._newest(*parts, self._alone(layout)).select(*own)

    def read_put(self, name: str) -> DataFrame | None:
        """The rows of one put, as long as no compaction has folded it; of no other file."""
        layout = self.layout()
        folder = None if layout is None else self._puts(layout).get(name)
        if folder is None:
            return None
        return self._files([f"{self.path}/puts/{folder}"], f"{self.path}/puts", (_WRITTEN,)).drop(_BUCKET, _WRITTEN)

    def upsert(self, rows: DataFrame, name: str | None = None, unique: bool = False) -> None:
        """Put `rows`; of several with one key the last wins. A put with the name of an earlier one replaces it.

        `unique` says that no key comes twice, as in rows of another table with these keys; then they are not shuffled to find out.
        """
        layout = self.layout() or self._commit(Layout(1, self.buckets or BUCKETS))
        stamp = f"{time.time_ns():020d}"
        bucketed = rows.select(*self.schema.fieldNames())
        if not unique:
            arrived = bucketed.withColumn("_arrival", F.monotonically_increasing_id())
            bucketed = last_per_key(arrived, self.keys, F.col("_arrival")).drop("_arrival")
        bucketed = bucketed.withColumns({
            _WRITTEN: F.lit(int(stamp)), _BUCKET: self._bucket_of(*map(F.col, self._chosen_by()), buckets=layout.buckets)})
        name = name or uuid.uuid4().hex
        before = self._puts(layout).get(name)
        bucketed.hint("rebalance", F.col(_BUCKET)).write.partitionBy(_BUCKET).parquet(f"{self.path}/puts/_put={stamp}-{quote(name, safe='')}")
        if before:
            session.remove(self.spark, f"{self.path}/puts/{before}")

    def compact(self, buckets: int | None = None) -> None:
        """Fold all puts into a new base. The cost is that of the table, so run it apart from the puts, now and then."""
        layout = self.layout()
        if layout is None:
            return
        puts, target = self._puts(layout), f"base/{layout.version + 1:010d}"
        buckets = buckets or layout.buckets
        rows = self._newest(*self._parts(layout), len(puts) < 2).withColumn(_BUCKET, self._bucket_of(*map(F.col, self._chosen_by()), buckets=buckets))
        writer = (
            rows.hint("rebalance", F.col(_BUCKET)).sortWithinPartitions(_BUCKET, *self.sort_by).write.mode("overwrite").partitionBy(_BUCKET)
            .option("parquet.bloom.filter.adaptive.enabled", "true")
        )
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.parquet(f"{self.path}/{target}")
        stamps = tuple(f.removeprefix("_put=").partition("-")[0] for f in puts.values())
        self._commit(Layout(layout.version + 1, buckets, target, stamps))
        for folder in (*(f"puts/{f}" for f in puts.values()), *([layout.base] if layout.base else [])):
            session.remove(self.spark, f"{self.path}/{folder}")

    def rebucket(self, buckets: int) -> None:
        """Fold all puts into a base with another number of buckets."""
        if self.layout() is None:
            self._commit(Layout(1, buckets))
        self.compact(buckets)
        self.buckets = None if self.buckets is None else buckets


def store_vectors(table: KeyedTable, records: DataFrame, reason: Column, name: str | None = None, unique: bool = False) -> DataFrame:
    """Upsert the valid vector records; returns the rejected ones with their reason."""
    marked = records.withColumn("reason", reason)
    table.upsert(marked.where(F.col("reason").isNull()).drop("reason"), name, unique)
    return marked.where(F.col("reason").isNotNull())


def dead_letters(rejected: DataFrame, stage: str, failed_at: Column | None = None) -> DataFrame:
    when = F.current_timestamp() if failed_at is None else failed_at
    return rejected.select(F.lit(stage).alias("stage"), "trace_id", "paper_id", "reason", when.alias("failed_at"))
