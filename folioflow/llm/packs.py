"""Packs: groups of some megabytes of documents that meet again in every step of an operator.

A pack sends what it knows, sorted by hash and cut into ranges (shards), one row for each
range; a shard sees what all packs sent of its range, and answers each pack. So a text is
shuffled once, and what else is exchanged is a few bytes for each different hash of a pack.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a pack, about; a task holds one pack.
PACK_BYTES = 16 << 20
LEAST_PACKS = 36


def packed(docs: DataFrame, pack_bytes: int = PACK_BYTES, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> tuple[DataFrame, int]:
    """pack, doc_id, body (the text in UTF-8, null as empty) and `more`; and the number of packs."""
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    packs = max(LEAST_PACKS, -(-total // pack_bytes))
    pack = F.pmod(F.xxhash64(id_col, text_col), F.lit(packs)).cast("int")
    return docs.select(pack.alias("pack"), F.col(id_col).cast("bigint").alias("doc_id"), body.alias("body"), *(c.alias(n) for n, c in more.items())), packs


def ranges(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """Sorted hashes cut into `shards` equal ranges of values: shard, first, last; empty ones are left out."""
    bounds = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)
    cuts = [0, *np.searchsorted(hashes, bounds).tolist(), len(hashes)]
    for shard, (first, last) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if last > first:
            yield shard, first, last
