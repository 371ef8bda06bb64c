"""N-gram Jaccard join by chosen paths.

Texts are sets of word shingles. Equal sets form one class, and only classes are compared.
A class has a sketch of `COORDINATES` MinHash values; its tokens are the pairs of place
and value. A run starts with all classes in one node; a class enters the child nodes of
those tokens that the node samples, each with chance 1 / (`threshold` * `COORDINATES`), so
two classes of the wanted similarity are expected to meet in one child at least. Nodes of
more than `NODE` classes are split again, up to `LEVELS` deep. The runs are repeated until
the chance that a pair at the threshold shares no small node is below 1 - `recall`.

Classes in one node are compared by sketch, all by all, in blocks. What may be similar is
joined to candidate components, and in each component the exact sets are compared, again
block by block: a pair of texts is verified once, however many nodes it shares. No list of
pairs is made: a block gives the links of each class and a tree of each of its parts.

Cases: null texts count as empty. Texts without a word are similar to nothing, each is a
class of its own. A text of fewer than five words has one shingle of all of them. Rows
that share an id but not a text are one document: candidates come from each of its texts,
the smallest text is compared. Ids that are null have no links and no class. Repeated rows are copies. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm import texts
from folioflow.llm.components import connected
from folioflow.session import materialize

THRESHOLD = 0.8
RECALL = 0.999
COORDINATES = 128
#: Classes in a node that are compared without a further split: some million comparisons of sketches, about a second.
NODE = 4096
LEVELS = 4
#: Rows of a node, and of a component with its whole sets, that are compared in one go.
NODE_BLOCK, BLOCK = 2048, 1024
#: Standard deviations of a sketch's estimate that a candidate may lie below the threshold.
SLACK = 4

_TURN = texts.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = texts.mix(np.arange(1001, COORDINATES + 1001, dtype=np.uint64))


def runs_for(recall: float, levels: int = LEVELS) -> int:
    """Runs after which a pair at the threshold is missed with less than 1 - recall.

    The common nodes of such a pair are a branching process with one child expected
    (nearly Poisson), which is alive after `levels` levels with chance q.
    """
    q = 1.0
    for _ in range(levels):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of the hash functions over the set, as 32 well-mixed bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        x = shingles[i : i + 2048, None] * _TURN + _ADD
        least = np.minimum(least, (x ^ (x >> np.uint64(32))).min(axis=0))
    return (texts.mix(least) >> np.uint64(32)).astype(np.uint32)


def _set_batches(batches: Iterable[pa.RecordBatch], make: Callable) -> Iterator[pa.RecordBatch]:
    """`make` of the ids and sets of each slice of the batches."""
    for batch in batches:
        body, at = texts.flat(batch.column(1))
        for i, j in texts.slices(at):
            found = texts.words(body[at[i] : at[j]], at[i : j + 1] - at[i], texts.WORD_BYTE)
            yield make(batch.slice(i, j - i), list(texts.shingles(*found)))


def _sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def make(rows: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        full = [i for i, s in enumerate(sets) if len(s)]
        one = [int(texts.mix(sets[i]).sum()) for i in full]
        two = [int(texts.mix(sets[i] ^ np.uint64(0x5DEECE66D)).sum()) for i in full]
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(pa.array(full, pa.int64())), pa.array([a.to_bytes(8, "big") + b.to_bytes(8, "big") for a, b in zip(one, two, strict=True)], pa.binary()),
             pa.array([sketch(sets[i]).tobytes() for i in full], pa.binary())], ["doc_id", "same", "sketch"])

    return _set_batches(batches, make)


def _enter(runs: int, threshold: float):
    """Child nodes of the classes in `node`; the run's number is the first node."""
    seeds = texts.mix(np.arange(5000, 5000 + COORDINATES, dtype=np.uint64))
    chance = np.uint64(int(2**64 / (threshold * COORDINATES)))

    def enter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([np.frombuffer(x, np.uint32) for x in batch.column("sketch").to_pylist()], np.uint64).reshape(-1, COORDINATES) + seeds
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            if "node" in batch.schema.names:
                roots = batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)[:, None]
            else:
                roots = texts.mix(np.arange(1, runs + 1, dtype=np.uint64))[None, :]
            for k in range(roots.shape[1]):
                child = texts.mix(values * np.uint64(0x9E6C63D0876A9A47) + roots[:, k : k + 1])
                row, place = np.nonzero(texts.mix(child) < chance)
                yield pa.RecordBatch.from_arrays([pa.array(child[row, place].view(np.int64)), pa.array(ids[row])], ["node", "doc_id"])

    return enter


def candidate_nodes(classes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, node: int = NODE, levels: int = LEVELS) -> DataFrame:
    """node, doc_id, members: the nodes with two classes or more, split as far as they have to be. `classes`: doc_id, sketch."""
    done, rows = None, classes.select("doc_id", "sketch")
    enter = _enter(runs_for(recall, levels), threshold)
    for level in range(levels):
        entered = materialize(rows.mapInArrow(enter, "node bigint, doc_id bigint"), "nodes")
        counts = materialize(entered.groupBy("node").agg(F.count("*").alias("members")).filter("members > 1"), "node-counts")
        found = entered.hint("merge").join(counts, "node")  # directly above its shuffles, so that hot nodes can be split
        last = level == levels - 1 or counts.filter(F.col("members") > node).isEmpty()
        small = found if last else found.filter(F.col("members") <= node)
        done = small if done is None else done.unionByName(small)
        if last:
            return done
        rows = found.filter(F.col("members") > node).select("node", "doc_id").join(classes.select("doc_id", "sketch"), "doc_id")


def block_pairs(rows: DataFrame, group: str, size: str, block: int) -> DataFrame:
    """Rows once for each pair of blocks of their group: adds blk, lo and hi. Groups of up to `block` rows are one block."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    cut = rows.withColumn("blk", F.pmod(F.xxhash64("doc_id", F.lit(7)), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cut = cut.withColumn("lo", F.least("blk", "other")).withColumn("hi", F.greatest("blk", "other")).drop("other")
    return cut.repartition(group, "lo", "hi").sortWithinPartitions(group, "lo", "hi", "doc_id")


def _groups(batches: Iterable[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys; the rows are sorted by them."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in key]
        change = np.any([c[1:] != c[:-1] for c in columns], axis=0) if batch.num_rows > 1 else np.zeros(0, bool)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(i, j - i)
            if rest and i == 0 and any(rest[0].column(k)[0].as_py() != part.column(k)[0].as_py() for k in key):
                yield pa.Table.from_batches(rest)
                rest = []
            if i > 0:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(part)
    if rest:
        yield pa.Table.from_batches(rest)


def _trees(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row of the symmetric relation, the smallest id of its part. `ids` are sorted."""
    root = ids.copy()
    left = near.any(axis=1)
    for i in np.flatnonzero(left).tolist():
        part, front = np.zeros(len(ids), bool), np.array([i])
        while left[i] and len(front):
            part[front] = True
            front = np.flatnonzero(near[front].any(axis=0) & ~part)
        root[part] = ids[i]
        left &= ~part
    return root


def _near_sketches(threshold: float):
    least = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / COORDINATES)

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["node", "lo", "hi"]):
            ids = table.column("doc_id").to_numpy()
            x = np.array([np.frombuffer(b, np.uint8) for b in table.column("small").to_pylist()])
            close = np.array([(x == row).sum(axis=1) >= least * COORDINATES for row in x])
            root = _trees(close, ids)
            own = root != ids
            yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(root[own])], ["a", "b"])

    return near


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _set_batches(batches, lambda rows, sets: pa.RecordBatch.from_arrays(
        [rows.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "shingles"]))


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many shingles each two sets share."""
    every = np.concatenate(sets)
    different, place, n = np.unique(every, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = n > 1
    number = np.cumsum(shared) - 1
    own = shared[place]
    row, place = row[own], number[place[own]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    for first in range(0, int(shared.sum()), columns):
        i, j = np.searchsorted(place, [first, first + columns])
        m = np.zeros((len(sets), columns), np.float32)
        m[row[i:j], place[i:j] - first] = 1
        out += m @ m.T
    return out


def _links(threshold: float):
    """doc_id, links (documents), root: of each class in a pair of blocks."""
    def links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["root", "lo", "hi"]):
            ids, blk = table.column("doc_id").to_numpy(), table.column("blk").to_numpy()
            copies = table.column("copies").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            n = np.array([len(s) for s in sets])
            both = overlaps(sets)
            near = both >= threshold * (n[:, None] + n[None, :] - both) - 1e-3
            np.fill_diagonal(near, False)
            if table.column("lo")[0].as_py() != table.column("hi")[0].as_py():
                near &= blk[:, None] != blk[None, :]  # pairs within a block are another task's
            own = near.any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array((near @ copies)[own].astype(np.int64)), pa.array(_trees(near, ids)[own])], ["doc_id", "links", "root"])

    return links


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, class_id (the smallest id connected by links), copy_id (the smallest id of its set), n_copies, n_links.

    `n_links` counts the other documents at least `threshold` similar, copies included.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    known = rows.filter("doc_id is not null")
    sketches = materialize(known.mapInArrow(_sketches, "doc_id bigint, same binary, sketch binary"), "sketches")
    groups = materialize(sketches.groupBy("same").agg(
        F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.min_by("sketch", "doc_id").alias("sketch")), "classes")
    member = materialize(sketches.select("doc_id", "same").join(groups.drop("sketch"), "same").groupBy("doc_id").agg(
        F.min(F.struct("copy_id", "copies")).alias("c")).select("doc_id", "c.copy_id", "c.copies"), "members")
    classes = groups.select(F.col("copy_id").alias("doc_id"), "sketch")
    copies = groups.groupBy(F.col("copy_id").alias("node")).agg(F.min_by("copies", "same").alias("copies"))

    nodes = candidate_nodes(classes, threshold, recall)
    small = classes.select("doc_id", "sketch").mapInArrow(_low_bytes, "doc_id bigint, small binary")
    compared = block_pairs(nodes.join(materialize(small, "small-sketches"), "doc_id"), "node", "members", NODE_BLOCK)
    parts = connected(compared.select("node", "lo", "hi", "doc_id", "small").mapInArrow(_near_sketches(threshold), "a bigint, b bigint"))
    parts = materialize(parts, "candidate-parts")

    sizes = materialize(parts.groupBy("root").agg(F.count("*").alias("members")), "part-sizes")
    own = parts.join(sizes, "root").join(copies, "node").withColumnRenamed("node", "doc_id")
    texts_of = known.join(parts.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    sets = texts_of.select("doc_id", "text").mapInArrow(_sets, "doc_id bigint, shingles binary")
    verified = block_pairs(own.join(sets, "doc_id"), "root", "members", BLOCK).select("root", "lo", "hi", "blk", "doc_id", "copies", "shingles")
    links = materialize(verified.mapInArrow(_links(threshold), "doc_id bigint, links bigint, root bigint"), "links")

    roots = connected(links.select(F.col("doc_id").alias("a"), F.col("root").alias("b")))
    linked = links.groupBy("doc_id").agg(F.sum("links").alias("links")).join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    linked = materialize(linked.select(F.col("doc_id").alias("copy_id"), "links", "root"), "linked")
    classed = materialize(member.join(linked, "copy_id", "left"), "document-classes").select(
        F.col("doc_id").alias("own_id"), "copy_id", "copies", "links", "root")
    joined = rows.select("doc_id").join(classed, F.col("doc_id") == F.col("own_id"), "left")
    return joined.select("doc_id", F.coalesce("root", "copy_id", "doc_id").alias("class_id"), F.coalesce("copy_id", "doc_id").alias("copy_id"),
                         F.coalesce("copies", F.lit(1)).alias("n_copies"), (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"))


def _low_bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One byte of each value of a sketch: enough to compare two, with one chance in 256 to be wrong per value."""
    for batch in batches:
        found = [np.frombuffer(x, np.uint8)[::4].tobytes() for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "small"])
