"""Numbering of rows in write batches without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import materialize

WRITE_BATCH = 25
ROWS_PER_BLOCK = 100_000
BLOCKS_PER_SPAN = 1_000


def number_rows(df: DataFrame, group: str, order: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add `row_no` (from 1) in the order of the unique integer column `order` per group.

    A plain window would sort one whole group in one task. Here each group is cut into
    blocks of `order` values; a block has at most `rows_per_block` rows however hot its
    group is. Rows are numbered within the block, and the rows before a block come from
    sums over the small table of block counts (`rows_before`). Window and join share one
    exchange. A null group counts as the empty one. The rows are written down first, since
    they are needed twice: the counts read group and order only.
    """
    df = materialize(df, "numbered")
    blocked = df.withColumns({
        "_group": F.coalesce(F.col(group).cast("string"), F.lit("")),
        "_block": F.expr(f"`{order}` div {int(rows_per_block)}"),
    })
    offsets = rows_before(blocked.groupBy("_group", "_block").agg(F.count(F.lit(1)).alias("_rows")))
    in_block = Window.partitionBy("_group", "_block").orderBy(order)
    return (
        blocked.withColumn("_local", F.row_number().over(in_block))
        .join(offsets, ["_group", "_block"])
        .withColumn("row_no", F.col("_local") + F.col("_before"))
        .select(*df.columns, "row_no")
    )


def rows_before(counts: DataFrame, blocks_per_span: int = BLOCKS_PER_SPAN) -> DataFrame:
    """_group, _block and `_before`, the rows of the blocks before it in its group; from (_group, _block, _rows).

    A prefix sum in two levels: within spans of blocks, spread over tasks, and over the sums
    of the spans. So the only window over a whole group has one row for each span, that is
    for BLOCKS_PER_SPAN * ROWS_PER_BLOCK values of the order.
    """
    def sums(keys: list[str], order: str, rows: str) -> Column:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(rows).over(before), F.lit(0).cast("long"))

    spanned = counts.withColumn("_span", F.floor(F.col("_block") / F.lit(blocks_per_span)).cast("long"))
    spans = spanned.groupBy("_group", "_span").agg(F.sum("_rows").alias("_span_rows"))
    spans = spans.select("_group", "_span", sums(["_group"], "_span", "_span_rows").alias("_spans_before"))
    return spanned.withColumn("_in_span", sums(["_group", "_span"], "_block", "_rows")).join(spans, ["_group", "_span"]).select(
        "_group", "_block", (F.col("_in_span") + F.col("_spans_before")).alias("_before"))


def batch_number(row_no: Column, size: int = WRITE_BATCH) -> Column:
    """Zero-based number of the write batch of a row numbered from 1."""
    return F.floor((row_no - 1) / F.lit(size)).cast("long")


def with_batch_no(df: DataFrame, group: str, order: str, size: int = WRITE_BATCH) -> DataFrame:
    return number_rows(df, group, order).withColumn("batch_no", batch_number(F.col("row_no"), size)).drop("row_no")


def upsert_stats(df: DataFrame, batch_keys: list[str], failed: Column, by: list[str] | None = None) -> DataFrame:
    """Item and batch counters of a write; one failed row fails its whole batch."""
    by = by or []
    keys = list(dict.fromkeys([*by, *batch_keys]))
    per_batch = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_items"), F.max(failed.cast("int")).alias("_failed")
    )
    zero = F.lit(0).cast("long")
    ok = F.col("_failed") == 0
    return per_batch.groupBy(*by).agg(
        F.coalesce(F.sum("_items"), zero).alias("total_items"),
        F.coalesce(F.sum(F.when(ok, F.col("_items"))), zero).alias("success_items"),
        F.coalesce(F.sum(F.when(~ok, F.col("_items"))), zero).alias("failed_items"),
        F.count(F.lit(1)).alias("batch_count"),
        F.count_if(ok).alias("success_batches"),
        F.count_if(~ok).alias("failed_batches"),
    )
