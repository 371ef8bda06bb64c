"""Language-model scoring with a probabilistic suffix tree.

The tree predicts the next symbol of a text from the longest of its contexts (up to
`DEPTH` symbols) that the tree has kept. Symbols are the bytes of the words, the most
frequent ones by themselves and the rest as one, a space between words and the end. A
context is kept if it was seen often enough and its next symbols differ from those of its
own suffix: rows times divergence has to reach `DIVERGENCE`. Distributions are smoothed
towards the suffix. Counts are taken over all training texts. The tree has at most
`SYMBOLS` ** `DEPTH` contexts, however much it was learnt from, and so fits a broadcast.

The unigram base needs a count of every different word, which grows with the texts. Words
are counted in packs and summed by ranges of their hashes (64 bits), and each pack gets
back the sums of its own words only.

Cases: a null text counts as empty; an empty text is its end alone. With nothing to learn
from, symbols are equally likely and all counts are 0. Rows with a null id learn. Repeated
rows count repeatedly. Long texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm import packs, texts
from folioflow.llm.language import held_out
from folioflow.session import materialize

DEPTH = 3
SYMBOLS = 64
SPACE, OTHER, END = 0, SYMBOLS - 2, SYMBOLS - 1
LEAST_SEEN = 5
DIVERGENCE = 8.0
SMOOTHING = 8.0
END_HASH = texts.mix(np.array([0xE0D], np.uint64))[0]


def _count_bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, np.int64)
    for batch in batches:
        total += np.bincount(texts.LOWER[texts.flat(batch.column(0))[0]], minlength=256)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["byte", "n"])


class Alphabet:
    def __init__(self, counts: np.ndarray):
        counts = np.where(texts.NOT_SPACE_BYTE, counts, 0)
        own = [b for b in np.lexsort((np.arange(256), -counts)).tolist() if counts[b]][: OTHER - 1]
        self.of = np.full(256, OTHER, np.uint32)
        self.of[~texts.NOT_SPACE_BYTE] = SPACE
        self.of[own] = np.arange(1, len(own) + 1)
        self.others = int((self.of == OTHER).sum())

    def stream(self, body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of `DEPTH` symbols and the next one, for each symbol of each row and its end; where each row begins in it."""
        symbols = self.of[texts.LOWER[body]]
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        word = symbols != SPACE
        before = np.append(False, word[:-1])
        if len(at) > 1:
            before[at[:-1][np.diff(at) > 0]] = False  # no space before the first word of a row
        keep = word | before
        symbols, row = symbols[keep], row[keep]
        upto = np.searchsorted(row, np.arange(len(at)))
        if len(symbols):  # nor after the last
            ends = np.unique(upto[1:][np.diff(upto) > 0]) - 1
            ends = ends[symbols[ends] == SPACE]
            symbols, row = np.delete(symbols, ends), np.delete(row, ends)
            upto = np.searchsorted(row, np.arange(len(at)))
        n = len(at) - 1
        padded = np.full(len(symbols) + DEPTH * (n + 1), END, np.uint32)
        place = np.arange(len(symbols)) + DEPTH * (row + 1)
        padded[place] = symbols
        codes = padded[DEPTH:].copy()
        for j in range(1, DEPTH + 1):
            codes += padded[DEPTH - j : len(padded) - j] * np.uint32(SYMBOLS**j)
        begin = upto + DEPTH * np.arange(n + 1)
        wanted = np.ones(len(codes), bool)
        for j in range(1, DEPTH):  # of the padding, only the first end is predicted
            wanted[begin[1:] - j] = False
        return codes[wanted], upto + np.arange(n + 1)


def _count_codes(alphabet: Alphabet):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** (DEPTH + 1), np.uint32)
        for batch in batches:
            body, at = texts.flat(batch.column(0))
            for i, j in texts.slices(at):
                np.add.at(total, alphabet.stream(body[at[i] : at[j]], at[i : j + 1] - at[i])[0], np.uint32(1))
        seen = np.flatnonzero(total)
        for first in range(0, len(seen), 100_000):
            own = seen[first : first + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own].astype(np.int64))], ["code", "n"])

    return count


class SuffixTree:
    """levels[k]: the kept contexts of k + 1 symbols and the distributions of what follows them."""

    def __init__(self, alphabet: Alphabet, codes: np.ndarray, n: np.ndarray):
        self.alphabet, self.levels = alphabet, []
        self.root = (np.bincount(codes % SYMBOLS, n, SYMBOLS) + 0.5) / (n.sum() + 0.5 * SYMBOLS)
        shorter = np.tile(self.root, (1, 1))
        of_shorter = {0: 0}
        for depth in range(1, DEPTH + 1):
            context, row = np.unique(codes // SYMBOLS % SYMBOLS**depth, return_inverse=True)
            seen = np.bincount(row * SYMBOLS + codes % SYMBOLS, n, len(context) * SYMBOLS).reshape(-1, SYMBOLS)
            suffix = shorter[[of_shorter[c] for c in (context % SYMBOLS ** (depth - 1)).tolist()]] if len(context) else np.zeros((0, SYMBOLS))
            total = seen.sum(axis=1, keepdims=True)
            p = seen / np.maximum(total, 1)
            divergence = (p * np.log(np.where(p > 0, p, 1) / suffix)).sum(axis=1)
            kept = (total[:, 0] >= LEAST_SEEN) & (total[:, 0] * divergence >= DIVERGENCE)
            shorter = np.where(kept[:, None], (seen + SMOOTHING * suffix) / (total + SMOOTHING), suffix)
            of_shorter = {c: i for i, c in enumerate(context.tolist())}
            self.levels.append((context[kept], shorter[kept]))

    def table(self) -> np.ndarray:
        """log10 of the probability of every code, by the longest kept suffix of its context."""
        out = self.root[None, :].astype(np.float32)
        for depth, (context, p) in enumerate(self.levels, 1):
            out = np.tile(out, (SYMBOLS, 1)) if depth > 1 else np.repeat(out, SYMBOLS, 0)
            out[context] = p
        out = np.log10(out)
        out[:, OTHER] -= np.float32(np.log10(max(1, self.alphabet.others)))
        return out.reshape(-1)

    def scores(self, table: np.ndarray, body: np.ndarray, at: np.ndarray) -> np.ndarray:
        codes, begin = self.alphabet.stream(body, at)
        sums = np.append(0, np.cumsum(table[codes], dtype=np.float64))
        return sums[begin[1:]] - sums[begin[:-1]]


def fit(train: DataFrame) -> SuffixTree:
    """`train`: text. One number per byte and per code comes to the driver; codes are at most SYMBOLS ** (DEPTH + 1)."""
    rows = train.select(F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInArrow(_count_bytes, "byte bigint, n bigint").groupBy("byte").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(256, np.int64)
    counts[counted.byte.to_numpy()] = counted.n.to_numpy()
    alphabet = Alphabet(counts)
    codes = rows.mapInArrow(_count_codes(alphabet), "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    return SuffixTree(alphabet, codes.code.to_numpy(np.int64), codes.n.to_numpy(np.float64))


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row and its end, and where each row begins."""
    body, at = texts.flat(table.column("body"))
    parts, sizes = [], []
    for i, j in texts.slices(at):
        hashes, upto = texts.words(body[at[i] : at[j]], at[i : j + 1] - at[i], texts.NOT_SPACE_BYTE)
        parts.append(np.insert(hashes, upto[1:], END_HASH))
        sizes.append(np.diff(upto) + 1)
    return np.concatenate(parts), np.append(0, np.cumsum(np.concatenate(sizes)))


def _send_words(shards: int):
    def send(table: pa.Table) -> pa.Table:
        hashes, begin = _tokens(table)
        learnt = np.repeat(table.column("learn").to_numpy(), np.diff(begin))
        seen, counts = np.unique(hashes[learnt], return_counts=True)
        different = np.union1d(seen, hashes[~learnt])
        n = np.zeros(len(different), np.uint32)
        n[np.searchsorted(different, seen)] = counts
        rows = [(s, different[i:j].tobytes(), n[i:j].tobytes()) for s, i, j in packs.ranges(different, shards)]
        pack = table.column("pack")[0].as_py()
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int32()), "pack": pa.array([pack] * len(rows), pa.int32()),
                         "hashes": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())})

    return send


def _sum_words(table: pa.Table) -> pa.Table:
    """For each pack the sums of its words, in its own order; the first also gets the sums of the shard."""
    hashes = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()])
    different, place = np.unique(np.concatenate(hashes), return_inverse=True)
    sums = np.bincount(place, counts, len(different)).astype(np.int64)
    cuts = np.cumsum([0, *map(len, hashes)])
    answers = [sums[place[i:j]].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    first = [1] + [0] * (len(hashes) - 1)
    return pa.table({"pack": table.column("pack"), "shard": table.column("shard"), "sums": pa.array(answers, pa.binary()),
                     "tokens": pa.array([int(sums.sum()) * f for f in first], pa.int64()), "words": pa.array([int((sums > 0).sum()) * f for f in first], pa.int64())})


SCORED = "doc_id bigint, learn boolean, n_tokens bigint, n_known bigint, base double, score double, tokens bigint, words bigint"
_tables: dict[bytes, np.ndarray] = {}


def _score(tree: SuffixTree):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """A row per document, and one without a document that carries the sums of shards."""
        key = tree.root.tobytes() + b"".join(x.tobytes() for x, _ in tree.levels)
        if key not in _tables:
            _tables.clear()
            _tables[key] = tree.table()  # once per Python worker
        hashes, begin = _tokens(docs)
        place = np.unique(hashes, return_inverse=True)[1]
        answers = answers.sort_by("shard")
        c = np.concatenate([np.frombuffer(x, np.int64) for x in answers.column("sums").to_pylist()])[place]
        sums, known = np.append(0, np.cumsum(np.log10(c + 1.0))), np.append(0, np.cumsum(c > 0))
        body, at = texts.flat(docs.column("body"))
        scores = [tree.scores(_tables[key], body[at[i] : at[j]], at[i : j + 1] - at[i]) for i, j in texts.slices(at)]
        none = pa.nulls(docs.num_rows, pa.int64())
        own = pa.table({"doc_id": docs.column("doc_id"), "learn": docs.column("learn"), "n_tokens": pa.array(np.diff(begin)), "n_known": pa.array(np.diff(known[begin])),
                        "base": pa.array(np.diff(sums[begin])), "score": pa.array(np.concatenate(scores)), "tokens": none, "words": none})
        total = pa.table({"doc_id": pa.nulls(1, pa.int64()), "learn": pa.nulls(1, pa.bool_()), "n_tokens": pa.nulls(1, pa.int64()), "n_known": pa.nulls(1, pa.int64()),
                          "base": pa.nulls(1, pa.float64()), "score": pa.nulls(1, pa.float64()),
                          "tokens": pa.array([sum(answers.column("tokens").to_pylist())], pa.int64()), "words": pa.array([sum(answers.column("words").to_pylist())], pa.int64())})
        return pa.concat_tables([own, total])

    return score


def lm_scores(docs: DataFrame, pack_bytes: int = packs.PACK_BYTES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    out = held_out(F.col("doc_id"), 7)
    tree = fit(docs.filter(~out).select("text"))
    rows, n = packs.packed(docs.select("doc_id", "text"), pack_bytes, learn=~out)
    sent = rows.groupBy("pack").applyInArrow(_send_words(n), "shard int, pack int, hashes binary, counts binary")
    answers = sent.groupBy("shard").applyInArrow(_sum_words, "pack int, shard int, sums binary, tokens bigint, words bigint")
    scored = materialize(rows.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(_score(tree), SCORED), "lm-scores")
    total = scored.agg(F.sum("tokens"), F.sum("words")).first()
    tokens, words = total[0] or 0, total[1] or 0
    norm = float(np.log10(tokens + 1 * (words + 1)))
    return scored.filter("n_tokens is not null").select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * norm).alias("base_score"), "score")
