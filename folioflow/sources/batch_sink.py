"""Writes in batches of 25 whose outcome the sink decides: a table with rules, or a client of some outside store.

Both give one outcome row per item, from which `operators.batches.upsert_stats` counts. A
batch that fails counts all its items as failed, and the others go on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators.batches import WRITE_BATCH, with_batch_no
from folioflow.session import materialize
from folioflow.sources.tables import KeyedTable

#: How often items that a client has left over are handed to it. Fixed.
ATTEMPTS = 3

#: `factory() -> put(rows)`: stores the rows of a batch and gives the places of those it has left over, or raises.
Put = Callable[[pa.Table], list[int] | None]
ClientFactory = Callable[[], Put]


def put_batches(
    table: KeyedTable, rows: DataFrame, reason: Column, group: str, order: str, size: int = WRITE_BATCH, name: str | None = None,
) -> DataFrame:
    """Put `rows` into a table that refuses a batch with any row that has a `reason`; the rows with batch_no and error.

    Batches are numbered per group in the order of the unique integer column `order`. The
    error of a batch is the reason of its first bad row; it is null for what is stored.
    """
    batch = Window.partitionBy(group, "batch_no")
    bad = F.when(F.col("_reason").isNotNull(), F.struct(order, "_reason"))
    numbered = with_batch_no(rows.withColumn("_reason", reason), group, order, size)
    outcomes = materialize(numbered.withColumn("error", F.min(bad).over(batch)["_reason"]).drop("_reason"), "outcomes")
    table.upsert(outcomes.where(F.col("error").isNull()), name)
    return outcomes


def _put(put: Put, rows: pa.Table, attempts: int) -> str | None:
    """The error of a batch, or None."""
    left = rows
    for _ in range(attempts):
        try:
            again = put(left)
        except Exception as problem:  # the next batch goes on
            return f"{type(problem).__name__}: {problem}"
        if not again:
            return None
        left = left.take(again)
    return f"failed to process {left.num_rows} items after {attempts} attempts"


def _batches(parts: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys, over the bounds of Arrow batches; there is one run for each write batch."""
    held: pa.Table | None = None
    for part in parts:
        rows = pa.Table.from_batches([part]) if held is None else pa.concat_tables([held, pa.Table.from_batches([part])])
        if not rows.num_rows:
            continue
        change = pa.array([False] * (rows.num_rows - 1))
        for key in keys:
            values = rows[key].combine_chunks()
            change = pc.or_(change, pc.not_equal(values[1:], values[:-1]))
        cuts = [0, *(i + 1 for i, new in enumerate(change.to_pylist()) if new)]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            yield rows.slice(first, last - first)
        held = rows.slice(cuts[-1])
    if held is not None:
        yield held


def send_batches(
    rows: DataFrame, factory: ClientFactory, group: str, order: str, size: int = WRITE_BATCH, attempts: int = ATTEMPTS,
) -> DataFrame:
    """Hand `rows` to a client in batches; group, `order`, batch_no and error of every row.

    The client is made once per task and gets a batch at a time, as an Arrow table of the
    columns of `rows`. What it leaves over is handed to it again, up to `attempts` times. A
    task that is lost runs again and puts its batches again, so puts have to be by key. The
    outcomes are written down: a batch is not sent twice because they are read twice.
    """
    columns, keys = rows.columns, ["_group", "batch_no"]
    schema = f"`{group}` string, `{order}` bigint, batch_no bigint, error string"

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = None
        for batch in _batches(parts, keys):
            put = put or factory()
            error = _put(put, batch.select(columns), attempts)
            yield pa.RecordBatch.from_arrays(
                [batch["_group"].combine_chunks().cast(pa.string()), batch[order].combine_chunks().cast(pa.int64()), batch["batch_no"].combine_chunks(), pa.array([error] * batch.num_rows, pa.string())],
                [group, order, "batch_no", "error"])

    numbered = with_batch_no(rows, group, order, size).withColumn("_group", F.coalesce(F.col(group).cast("string"), F.lit("")))
    dealt = numbered.repartition(*keys).sortWithinPartitions(*keys, order)
    return materialize(dealt.mapInArrow(send, schema), "outcomes")
