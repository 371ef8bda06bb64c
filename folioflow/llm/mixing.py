"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, by id, are cut into blocks. With `weight` out of `total`, block i
of a source is released at slot floor(i * total / weight), due by the end of slot
ceil((i + 1) * total / weight); no weight is rounded. In each slot the released block with
the earliest deadline is taken (ties: the first source by name).

Slots are worked out in stretches, each on its own, so that they spread over tasks. How many
blocks of each source come before a stretch is known without the stretches before it: the
sums of weights times slots, rounded down, over the sources by name, whose steps are the
slots rounded up or down for each source and add up to all slots. A stretch is long enough
that every source has a block in it, and takes its blocks in the order of their deadlines.
So at its bounds no source is a block or more off its weight, and what happens between them
does not add up. In between the windows bound the deviation to less than one block; where
the rounding asks for a block that is released in a stretch's last slots, it may be taken
that much before its release.

All documents are kept. A source that runs out leaves its later slots empty; the others
keep their order. When one source is left its blocks take the last slots of their windows,
so slots are worked out until all sources but one have run out. `slot`, then `seq`, is the
order of the mix.

Cases: a null source counts as a source of its own, named ''. A source without a weight, or
with a very small one, gets one of LIGHTEST slots. Null ids come first. Rows that tie in id
are put in the order of their other columns' hash; equal rows are interchangeable. An empty
table gives no rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.session import materialize

BLOCK_DOCS = 16
#: Least slots of a stretch, and slots that are gathered at a time.
STRETCH, PART = 1000, 500
#: A source gets one of so many slots at least.
LIGHTEST = 10_000
#: Rows that a range of ids has on average, when a source is numbered in parts.
RANGE_ROWS = 128

# One stretch: `begin` and `quota` are the blocks of each source before and in it, `offset`
# is begin * total - first slot * weight, so that windows count from the first slot.
PICKS = """
flatten(aggregate(
  sequence(0L, (length - 1) div {part}),
  named_struct('done', transform(weights, w -> 0), 'picks', cast(array() as array<array<struct<i:int,nth:int>>>)),
  (whole, p) -> transform(array(aggregate(
    sequence(p * {part}, least(length, (p + 1) * {part}) - 1),
    named_struct('done', whole.done, 'picks', cast(array() as array<struct<i:int,nth:int>>)),
    (state, t) -> transform(
      array(array_min(filter(
        transform(weights, (w, i) -> named_struct(
          'early', if((offset[i] + state.done[i] * total) div w > t, 1, 0),
          'deadline', (offset[i] + (state.done[i] + 1) * total + w - 1) div w, 'i', i)),
        x -> state.done[x.i] < quota[x.i]))),
      x -> named_struct(
        'done', transform(state.done, (d, i) -> d + if(i = x.i, 1, 0)),
        'picks', concat(state.picks, array(named_struct('i', x.i, 'nth', state.done[x.i])))))[0])),
    state -> named_struct('done', state.done, 'picks', concat(whole.picks, array(state.picks))))[0],
  whole -> whole.picks))
"""
BEFORE = "transform(sums, (c, i) -> c * cast({slot} as decimal(20, 0)) div total - if(i = 0, 0L, sums[i - 1] * cast({slot} as decimal(20, 0)) div total))"


@dataclass(frozen=True)
class Targets:
    """The list of sources by name, with whole weights above zero."""

    sources: tuple[str, ...]
    weights: tuple[int, ...]

    @property
    def total(self) -> int:
        return sum(self.weights)

    @property
    def stretch(self) -> int:
        """Slots of a stretch: every source has a block in each."""
        return max(STRETCH, -(-self.total // min(self.weights)))


def targets(weights: DataFrame) -> Targets:
    """`weights`: source, weight. The list of sources comes to the driver. Weights that are not whole are taken in billionths of their sum."""
    given = sorted((r["source"], max(0, r["weight"] or 0)) for r in weights.select("source", "weight").collect())
    total = sum(w for _, w in given)
    unit = 1 if total == 0 or all(w == int(w) for _, w in given) else float(total) / 10**9
    whole = [int(w) if unit == 1 else round(w / unit) for _, w in given]
    least = max(1, -(-sum(whole) // LIGHTEST))
    return Targets(tuple(s for s, _ in given), tuple(max(least, w) for w in whole))


def schedule(spark: SparkSession, own: Targets, slots: int) -> DataFrame:
    """source, block, slot of the first `slots` slots: whose block each of them takes."""
    length = own.stretch
    sums, at = [], 0
    for w in own.weights:
        at += w
        sums.append(at)
    constants = {"weights": (own.weights, "array<bigint>"), "sums": (sums, "array<decimal(38,0)>"), "sources": (own.sources, "array<string>")}
    rows = spark.range(0, -(-slots // length), 1, max(1, min(-(-slots // length), 4 * spark.sparkContext.defaultParallelism))).withColumns(
        {n: F.from_json(F.lit(json.dumps(v)), t) for n, (v, t) in constants.items()})
    rows = rows.withColumns({"total": F.lit(own.total).cast("bigint"), "first": F.col("id") * length, "length": F.least(F.lit(length), F.lit(slots) - F.col("id") * length)})
    rows = rows.withColumns({"begin": F.expr(BEFORE.format(slot="first")), "after": F.expr(BEFORE.format(slot=f"first + {length}"))}).withColumns({
        "quota": F.expr("transform(after, (a, i) -> a - begin[i])"),
        "offset": F.expr("transform(begin, (b, i) -> cast(cast(b as decimal(20, 0)) * total - cast(first as decimal(20, 0)) * weights[i] as bigint))")})
    picked = rows.select("first", "begin", "sources", F.posexplode(F.expr(PICKS.format(part=f"{PART}L"))).alias("place", "pick"))
    return picked.select(
        F.expr("sources[pick.i]").alias("source"),
        F.expr("begin[pick.i] + pick.nth").alias("block"), (F.col("first") + F.col("place")).alias("slot"))


def number_in_source(rows: DataFrame) -> DataFrame:
    """Adds `n`, the place of a row in its source by id, from 0.

    Ids are cut into ranges, ranges of a source are counted, and the counts summed up in
    two levels: no window holds more than some hundred rows, or one row per 65,536 of a source.
    """
    low, high, total = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    width = max(1, ((high or 0) - (low or 0) + 1) * RANGE_ROWS // max(1, total))
    rows = rows.withColumn("part", F.coalesce(F.floor((F.col("doc_id") - F.lit(low or 0)) / width), F.lit(-1)))
    counts = materialize(rows.groupBy("source", "part").count(), "mix-counts").withColumn("upper", F.floor(F.col("part") / 512))
    upper = counts.groupBy("source", "upper").agg(F.sum("count").alias("in_upper"))
    before_upper = F.coalesce(F.sum("in_upper").over(Window.partitionBy("source").orderBy("upper").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = F.coalesce(F.sum("count").over(Window.partitionBy("source", "upper").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("before", before).join(upper.withColumn("before_upper", before_upper), ["source", "upper"]).select(
        "source", "part", (F.col("before") + F.col("before_upper")).alias("before"))
    within = F.row_number().over(Window.partitionBy("source", "part").orderBy("doc_id", "tie")) - 1
    return rows.withColumn("within", within).join(offsets, ["source", "part"]).withColumn("n", F.col("before") + F.col("within"))


def mix(docs: DataFrame, weights: DataFrame | None = None, block_docs: int = BLOCK_DOCS, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Per row: doc_id, source, block, release, deadline, slot, seq. Without weights a source weighs the root of its rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                       F.xxhash64(*(F.col(f"`{c}`") for c, t in docs.dtypes if "map" not in t and "variant" not in t)).alias("tie"))
    return _mixed(rows, weights, block_docs)


def _mixed(rows: DataFrame, weights: DataFrame | None, block_docs: int) -> DataFrame:
    spark = rows.sparkSession
    counted = materialize(rows.groupBy("source").count(), "mix-sources")
    if weights is None:
        weights = counted.select("source", F.floor(1000 * F.sqrt("count")).alias("weight"))
    else:
        weights = counted.select("source").join(weights, "source", "left")
    own = targets(weights)
    blocks = number_in_source(rows).withColumn("block", F.floor(F.col("n") / block_docs)).withColumn("seq", (F.col("n") % block_docs).cast("int"))
    if not own.sources:
        none = {n: F.lit(0).cast("bigint") for n in ("release", "deadline", "slot")}
        return blocks.withColumns(none).select("doc_id", "source", "block", "release", "deadline", "slot", "seq")
    blocks_of = {r["source"]: -(-r["count"] // block_docs) for r in counted.collect()}  # one row per source
    ends = sorted(-(-blocks_of[s] * own.total // w) for s, w in zip(own.sources, own.weights, strict=True))
    taken = schedule(spark, own, ends[-2] if len(ends) > 1 else 0)  # what is left then is of one source
    place = F.col("block").cast("decimal(20,0)") * F.lit(own.total).cast("decimal(18,0)")
    after = (F.col("block") + 1).cast("decimal(20,0)") * F.lit(own.total).cast("decimal(18,0)")
    weight = F.create_map(*(F.lit(v) for s, w in zip(own.sources, own.weights, strict=True) for v in (s, w)))
    blocks = blocks.withColumn("weight", F.element_at(weight, F.col("source")).cast("bigint"))
    blocks = blocks.withColumns({"_place": place, "_after": after + F.col("weight") - 1}).withColumns(
        {"release": F.expr("_place div weight"), "deadline": F.expr("_after div weight")})
    return blocks.join(taken.select("source", "block", "slot"), ["source", "block"], "left").select(
        "doc_id", "source", "block", "release", "deadline", F.coalesce("slot", F.col("deadline") - 1).alias("slot"), "seq")


def mixed_documents(docs: DataFrame, weights: DataFrame | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The rows of `docs`, all columns, with mix_slot and mix_seq, in the order of the mix."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, F.col("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"))
    narrow = materialize(mix(docs, weights, block_docs).select("doc_id", "source", "slot", "seq"), "mix-order")
    same = narrow.groupBy("doc_id", "source").agg(F.min(F.struct("slot", "seq")).alias("place"))  # rows that share an id stay together
    placed = rows.join(same, rows["doc_id"].eqNullSafe(same["doc_id"]) & (rows["source"] == same["source"]))
    return placed.select("row.*", F.col("place.slot").alias("mix_slot"), F.col("place.seq").alias("mix_seq")).orderBy("mix_slot", "mix_seq")
