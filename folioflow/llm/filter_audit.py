"""How five document filters overlap, for every order of them, over a sparse document-term matrix.

Words are encoded by a dictionary of the whole table. The matrix is kept in CSR shards of
some megabytes of text (`document_term_matrix`): the sum of a row is the number of words,
its number of entries that of distinct words, and these decide filters A and B. C and D
are taken from the characters when a shard is built, E from the smallest id of each digest
of a text. What is left are counts per part and set of failed filters, at most 32 times
four rows for each part, from which all orders and steps are summed.

A shard sends each of its words once, so a very frequent word comes once per shard. A
group of copies meets only in a partial minimum, and rows find it again by digest and id,
so no task gets the copies of one text.

Cases: a null text is an empty one, a null source the part ''. A text without words fails
A and not B; an empty one does not fail C. Rows with a null id never fail E and carry no
label; rows that share an id and a text count each, and none of them is a copy of the
other. Several labels of one id count as one, 1 if any of them is 1. An empty table gives
no rows. Columns other than id, text and source are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.packs import ranges
from folioflow.llm.texts import NOT_SPACE_BYTE, flat, mix, powers, slices
from folioflow.llm.word_strings import word_runs
from folioflow.session import materialize, staged

FILTERS = "ABCDE"
#: Fixed: least words; distinct words and capitals in percent; characters that no document may hold.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
FORBIDDEN = "#$%&*|"
#: Bytes of text in a shard, about; a longer text is a shard of its own.
SHARD_BYTES = 4 << 20

_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x41:0x5B] = True
_FORBIDDEN = np.zeros(256, bool)
_FORBIDDEN[list(FORBIDDEN.encode())] = True
_STARTS = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point

#: Words of all shards in a range of the dictionary, about; one task numbers a range.
RANGE_WORDS = 1 << 20

SHARD = "shard bigint, n_terms bigint, doc_ids array<bigint>, parts array<string>, digests array<binary>, capitals array<boolean>, forbidden array<boolean>, indptr binary, indices binary, counts binary, terms binary, sizes binary"
_ARROW = pa.schema([
    ("shard", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())), ("digests", pa.list_(pa.binary())),
    ("capitals", pa.list_(pa.bool_())), ("forbidden", pa.list_(pa.bool_())), *((n, pa.binary()) for n in ("indptr", "indices", "counts", "terms", "sizes"))])


def pack_ints(values: np.ndarray) -> bytes:
    """Integers as 32-bit differences, byte planes apart and compressed: counts and high planes are mostly zeros."""
    steps = np.diff(values.astype("<i4"), prepend=np.int32(0)).astype("<i4")
    return len(steps).to_bytes(8, "little") + pa.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpack_ints(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], decompressed_size=4 * n, codec="zstd")
    steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<i4").ravel()
    return np.cumsum(steps, dtype=np.int32)


def _per_row(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many marks each row has."""
    upto = np.concatenate([[0], np.cumsum(marks)])
    return upto[at[1:]] - upto[at[:-1]]


def _hashes(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each term; it says which range numbers the term, which are then told apart by their bytes."""
    power, inverse = powers(len(body) + 1)
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * power[: len(body)], out=sums[1:])
    return mix((sums[at[1:]] - sums[at[:-1]]) * inverse[at[:-1]])


def _build_shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each slice of documents as a shard whose terms are numbered within it, by their hash."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        whole, bounds = flat(batch.column("text"))
        for first, last in slices(bounds, SHARD_BYTES):
            body, at = whole[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
            words, row, _ = word_runs(body, at, NOT_SPACE_BYTE)
            encoded = words.dictionary_encode()
            order = np.argsort(_hashes(*flat(encoded.dictionary)), kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            terms, ends = flat(encoded.dictionary.take(pa.array(order)))
            different = max(1, len(order))
            cells, counts = np.unique(row * different + place[encoded.indices.to_numpy(zero_copy_only=False)], return_counts=True)
            capitals = 100 * _per_row(_CAPITAL[body], at) > MOST_CAPITALS * _per_row(_STARTS[body], at)
            digests = [hashlib.sha256(body[a:b]).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
            rows = [batch.column("doc_id")[first:last], batch.column("part")[first:last], pa.array(digests, pa.binary()), pa.array(capitals), pa.array(_per_row(_FORBIDDEN[body], at) > 0)]
            blobs = [pack_ints(v) for v in (np.searchsorted(cells, np.arange(last - first + 1) * different), cells % different, counts)]
            columns = [
                pa.array([number]), pa.array([len(order)]), *(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in rows),
                *(pa.array([v], pa.binary()) for v in (*blobs, terms.tobytes(), pack_ints(np.diff(ends))))]
            number += 1
            yield pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _shards(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_build_shards, SHARD)


def _send(count: int):
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The terms of each shard, one row for each range of hashes."""
        for batch in batches:
            for shard, terms, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body, lengths = np.frombuffer(terms, np.uint8), unpack_ints(sizes)
                at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
                out = [(shard, r, body[at[a] : at[b]].tobytes(), pack_ints(lengths[a:b])) for r, a, b in ranges(_hashes(body, at), count)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["shard", "range", "terms", "sizes"])

    return send


def _number(count: int):
    def number(group: pa.Table) -> pa.Table:
        """Numbers the terms of a range in the order of their bytes; `ids` answers each shard's row."""
        pieces = []
        for terms, sizes in zip(group["terms"].to_pylist(), group["sizes"].to_pylist(), strict=True):
            ends = np.concatenate([[0], np.cumsum(unpack_ints(sizes), dtype=np.int64)]).astype(np.int32)
            pieces.append(pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(terms)]))
        encoded = pa.chunked_array(pieces).combine_chunks().dictionary_encode()
        rank = np.empty(len(encoded.dictionary), np.int64)
        rank[pc.sort_indices(encoded.dictionary).to_numpy()] = np.arange(len(rank))
        ids = rank[encoded.indices.to_numpy(zero_copy_only=False)] * count + group["range"][0].as_py()
        ends = np.cumsum([len(p) for p in pieces])
        answers = [ids[a:b].astype("<i8").tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        return pa.table([group["shard"], group["range"], pa.array(answers, pa.binary())], names=["shard", "range", "ids"])

    return number


def _encoded(shards: DataFrame) -> DataFrame:
    """The shards with `ids`, the numbers of their terms in the dictionary of all shards, in the order of the ranges.

    An id is the rank of the term in its range times the number of ranges, plus the range: no two terms share one.
    """
    terms = shards.agg(F.sum("n_terms")).first()[0] or 0
    count = max(-(-terms // RANGE_WORDS), int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sent = shards.select("shard", "terms", "sizes").mapInArrow(_send(count), "shard bigint, range int, terms binary, sizes binary")
    answered = sent.groupBy("range").applyInArrow(_number(count), "shard bigint, range int, ids binary")
    ids = answered.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("range", "ids"))).alias("found"))
    return shards.drop("terms", "sizes").join(ids.select("shard", F.col("found.ids").alias("ids")), "shard", "left")


def _matrix(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Of each shard its row columns, indptr, the entries' columns by the dictionary, and their counts."""
    for batch in batches:
        for i in range(batch.num_rows):
            indptr, indices, counts = (unpack_ints(batch.column(n)[i].as_py()) for n in ("indptr", "indices", "counts"))
            ids = np.frombuffer(b"".join(batch.column("ids")[i].as_py() or []), "<i8")
            rows = {n: batch.column(n)[i].values for n in ("doc_ids", "parts", "digests", "capitals", "forbidden")}
            yield {"shard": batch.column("shard")[i].as_py(), "indptr": indptr, "columns": ids[indices], "counts": counts, **rows}


def _matrix_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for m in _matrix(batches):
        lists = [m["doc_ids"], *(pa.array(m[n].astype(np.int64)) for n in ("indptr", "columns", "counts"))]
        yield pa.RecordBatch.from_arrays([pa.array([m["shard"]]), *(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in lists)], ["shard", "doc_ids", "indptr", "columns", "counts"])


def document_term_matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """CSR shards of the counts of words, whose columns are the ids of one dictionary of all documents.

    shard, doc_ids (a row each), indptr (where each row begins), columns and counts (of its entries).
    """
    shards = materialize(_shards(docs, id_col, text_col, part_col), "matrix-shards")
    return _encoded(shards).mapInArrow(_matrix_rows, "shard bigint, doc_ids array<bigint>, indptr array<bigint>, columns array<bigint>, counts array<bigint>")


ROW = "doc_id bigint, part string, digest binary, n_words bigint, n_distinct bigint, capitals boolean, forbidden boolean"


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the matrix: their sums and numbers of entries, and the marks that came along."""
    for m in _matrix(batches):
        upto = np.concatenate([[0], np.cumsum(m["counts"], dtype=np.int64)])[m["indptr"]]
        yield pa.RecordBatch.from_arrays(
            [m["doc_ids"], m["parts"], m["digests"], pa.array(np.diff(upto), pa.int64()), pa.array(np.diff(m["indptr"]), pa.int64()), m["capitals"], m["forbidden"]],
            ["doc_id", "part", "digest", "n_words", "n_distinct", "capitals", "forbidden"])


def row_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per document: its part, the digest of its text, words and distinct words by the matrix, marks of C and D."""
    with staged(_shards(docs, id_col, text_col, part_col), "matrix-shards") as shards:
        return materialize(_encoded(shards).mapInArrow(_measure, ROW), "matrix-rows")


def failed_filters(rows: DataFrame) -> DataFrame:
    """doc_id, part and `fails` of each row of `row_measures`: bit i is set where filter i of FILTERS fails."""
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    known = F.col("doc_id").isNotNull()
    own = rows.where(known).join(least.where(known), ["digest", "doc_id"], "left").withColumn("copy", F.col("first").isNull())
    every = own.drop("first").unionByName(rows.where(~known).withColumn("copy", F.lit(False)))
    flags = [F.col("n_words") < LEAST_WORDS, 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"), F.col("capitals"), F.col("forbidden"), F.col("copy")]
    return every.select("doc_id", "part", sum((f.cast("int") * (1 << i) for i, f in enumerate(flags)), F.lit(0)).alias("fails"))


def _cells(fails: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails, and how many documents, good and toxic ones they stand for."""
    label = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    known = F.col("doc_id").isNotNull()
    none = {n: F.lit(None).cast("long") for n in ("good", "toxic")}
    marked = fails.where(known).join(label, "doc_id", "left").unionByName(fails.where(~known).withColumns(none))
    zero = F.lit(0).cast("long")
    return marked.groupBy("part", "fails").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), zero).alias("good"), F.coalesce(F.sum("toxic"), zero).alias("toxic"))


def _steps(names: str) -> list[tuple[str, int, int, int]]:
    """Every order of the filters and step of it: order, step, the filter's bit, the bits of those before it."""
    out = []
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order, 1):
            out.append(("".join(names[k] for k in order), step, 1 << i, before))
            before |= 1 << i
    return out


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step; see the module."""
    cells = _cells(failed_filters(row_measures(docs, id_col, text_col, part_col)), labels)
    orders = len(list(permutations(FILTERS)))
    steps = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(bit).alias("bit"), F.lit(before).alias("before")) for o, s, bit, before in _steps(FILTERS)))
    at = cells.withColumn("s", F.explode(steps)).select("part", "fails", "n", "good", "toxic", "s.*")
    failing = F.col("fails").bitwiseAND(F.col("bit")) != 0
    gone = F.col("fails").bitwiseAND(F.col("before")) != 0
    removed = failing & ~gone
    # Of the orders, each filter that a document fails comes first among those in equally many.
    share = F.col("n") * F.when(failing, F.lit(orders) / F.bit_count("fails")).otherwise(0).cast("long")

    def total(rows, value="n"):
        return F.sum(F.when(rows, F.col(value)).otherwise(F.lit(0).cast("long")))

    return at.groupBy("part", "filter_order", "step").agg(
        total(~failing & ~gone).alias("kept"), total(removed).alias("removed"), total(failing & gone).alias("redundant"),
        total(F.col("fails") == F.col("bit")).alias("unique_fails"), total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"), F.sum(share).alias("shapley"))
