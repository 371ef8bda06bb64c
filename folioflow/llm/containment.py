"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

An item is contained in a document if the document has at least `threshold` of the item's
shingles of five words. Items are partitioned by the power of two of their number of
shingles. The MinHash signature of an item is its smallest hashes, so many that an item
of its partition with `threshold` of its shingles in a document must have one of them
there: one more than the largest number of shingles it may lack. So the search loses
nothing, however long the document. The search also takes letters beyond ASCII in lower
case, which only adds candidates; they are verified on the words of the shingles, in which
A-Z alone are.

Cases: null texts count as empty. An item of fewer than five words has one shingle of all
its words. Items without a word match nothing. Rows are told apart by id and text; rows
that share both give one result. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.word_arrays import ascii_lower_words, gram_hash, gram_text, lower_words, starts
from folioflow.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
#: Signature rows up to which they are sent to all executors (24 bytes each); beyond it Spark chooses the join.
BROADCAST_ROWS = 1_000_000


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, size (words in a shingle), n_item (distinct shingles of the item), hash, shingle."""
    text = F.col(text_col)
    words = items.select(F.col(id_col).alias("item_id"), ascii_lower_words(text).alias("words"), lower_words(text).alias("folded")).filter(F.size("words") > 0)
    words = words.withColumn("size", F.least(F.size("words"), F.lit(SHINGLE)))
    runs = words.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size")))).select(
        "item_id", "size", F.expr("slice(words, at + 1, size)").alias("run"), F.expr("slice(folded, at + 1, size)").alias("folded"))
    # The hash has to be that of gram_hash, which takes the words of a run one by one; a run that is shorter has nulls, which it skips.
    runs = runs.select("item_id", "size", gram_hash(F.col("folded"), F.lit(0), SHINGLE).alias("hash"), F.array_join("run", " ").alias("shingle")).distinct()
    counts = runs.groupBy(F.col("item_id").alias("own_id")).agg(F.count("*").alias("n_item"))
    return runs.join(counts, F.col("item_id").eqNullSafe(F.col("own_id"))).select("item_id", "size", "n_item", "hash", "shingle")


def signatures(shingles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """item_id, size, hash: the smallest hashes of each item, as many as its size partition asks for."""
    largest = F.expr("shiftleft(1, int(floor(log2(n_item))) + 1) - 1")
    length = F.floor(F.lit(1 - threshold) * largest + 1e-9).cast("int") + 1
    smallest = shingles.groupBy("item_id", "size", "n_item").agg(F.sort_array(F.collect_list("hash")).alias("hashes"))  # one item's
    return smallest.select("item_id", "size", F.explode(F.slice("hashes", 1, length)).alias("hash"))


def _document_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _sizes(shingles: DataFrame) -> list[int]:
    """Words in the shingles that occur: five, and less if there are shorter items."""
    return sorted(r["size"] for r in shingles.select("size").distinct().collect()) or [SHINGLE]


def _runs(of: Callable[..., Column], size: int) -> Column:
    return F.transform(starts(F.col("words"), size), lambda i: of(F.col("words"), i, size))


def candidates(docs: DataFrame, signature: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id: pairs that share a hash of the item's signature."""
    signature = materialize(signature, "signatures")
    rows = _document_words(docs, id_col, text_col).select("doc_id", "text_hash", lower_words(F.col("text")).alias("words"))
    small = signature.count() <= BROADCAST_ROWS
    found = None
    for size in _sizes(signature):
        own = signature.filter(F.col("size") == size).select("item_id", "hash")
        hashes = _runs(gram_hash, size)
        hits = rows.select("doc_id", "text_hash", F.explode(hashes).alias("hash")).join(F.broadcast(own) if small else own, "hash")
        found = hits if found is None else found.unionByName(hits)
    return found.select("doc_id", "text_hash", "item_id").distinct()


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs doc_id, item_id with n_item and n_found (shingles) and containment, at least `threshold`."""
    own = items.select(F.struct(F.col("item_id").alias("id"), F.xxhash64("text").alias("text_hash")).alias("item_id"), "text")
    shingles = materialize(item_shingles(own), "item-shingles")
    found = materialize(candidates(docs, signatures(shingles, threshold), id_col, text_col), "containment-candidates")
    pairs = found.select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), F.col("item_id").alias("pair_item"))
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash"))
    rows = _document_words(docs, id_col, text_col).join(pairs, same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    words = rows.select("doc_id", "text_hash", ascii_lower_words(F.col("text")).alias("words"))
    held = None
    for size in _sizes(shingles):
        runs = _runs(gram_text, size)
        own = words.select("doc_id", "text_hash", F.lit(size).alias("words_in"), F.explode(F.array_distinct(runs)).alias("run"))
        held = own if held is None else held.unionByName(own)
    wanted = pairs.join(shingles, F.col("pair_item").eqNullSafe(F.col("item_id"))).drop("item_id", "hash")
    both = held.join(wanted, [same, F.col("words_in") == F.col("size"), F.col("run") == F.col("shingle")])
    counted = both.groupBy("doc_id", "text_hash", "pair_item", "n_item").agg(F.count("*").alias("n_found"))
    counted = counted.withColumn("containment", F.col("n_found") / F.col("n_item")).filter(F.col("containment") >= threshold)
    best = F.max(F.struct("containment", "n_found", "n_item")).alias("best")
    return counted.groupBy("doc_id", F.col("pair_item.id").alias("item_id")).agg(best).select(
        "doc_id", "item_id", "best.n_item", "best.n_found", "best.containment")
