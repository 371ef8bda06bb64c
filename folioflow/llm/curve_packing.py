"""Packing of documents into sequences of tokens along a space-filling curve.

A document is the mean of the hashed vectors of its words, projected to DIMENSIONS random
signs each. Each dimension is scaled by its mean and deviation over all documents and cut
to BITS bits; the Hilbert key of the point, with bits of a hash behind it, is the place of
the document. Documents are dealt to ranges of places with about equal numbers of tokens,
sorted, and laid end to end: the tokens before a range are a sum over the ranges before
it, so each task knows the position of its first token and cuts at multiples of the length
of a sequence. Sequences are full, over the bounds of ranges too; what is left behind the
last full one is cut at powers of two, which need no padding.

Tokens: a text falls into pieces, at white space and where the tokenizer begins a new word
in any case, whose ids do not depend on their neighbours. Different pieces of a slice are encoded once; a worker keeps ids of a bounded
number of them. Pieces of more than LONG characters are cut where the tokenizer cuts in
any case. Ids are held in two bytes and written once to the shared folder.

Hot groups: copies share a Hilbert key, but not the hash bits behind it, so they spread
over ranges. Cases: null and empty texts have the end token only. The strings of special
tokens in a text are ordinary text. Rows with a null id are packed like others; rows that
share an id are packed each for itself. An empty table gives no rows. Columns other than
id and text are not looked at.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.texts import NOT_SPACE_BYTE, flat, mix, powers, slices
from folioflow.llm.word_strings import word_runs
from folioflow.session import materialize

SEQUENCE = 4096
END_ID = 2
DIMENSIONS, BITS = 4, 10
HASH_BITS = 22
#: Deviations on both sides of the mean that the cells of a dimension cover.
SPREAD = 3.0
#: Bytes of text worked on at once; tokens in a range, about.
SLICE, RANGE_TOKENS = 2 << 20, 4 << 20
WEIGHED = 1024
#: Pieces of a generation whose ids a worker keeps, their greatest length, and how many are encoded together.
KEPT, KEPT_LENGTH, TOGETHER = 500_000, 64, 20_000
SEPARATOR = "½"
#: How the vocabulary marks the last token of a word, and pieces that are one word: letters up to U+00FF, which no normal form changes but for case.
WORD_END = "</w>"
_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
LONG = 1 << 16
# Where the tokenizer always begins anew, of two ASCII characters: behind a digit, between a
# letter and anything else, and between a sign and a letter or digit; but an apostrophe
# and a letter may be one word.
_DIGIT, _LETTER, _SIGN, _QUOTE = "0-9", "A-Za-z", r"\x21-\x26\x28-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E", "'"
_CUT = re.compile(f"(?<=[{_DIGIT}])(?=[\x21-\x7E])|(?<=[{_LETTER}])(?=[{_DIGIT}{_SIGN}{_QUOTE}])|(?<=[{_SIGN}])(?=[{_DIGIT}{_LETTER}])|(?<={_QUOTE})(?=[{_DIGIT}])")
BREAKS = np.zeros((256, 256), bool)
for _a, _b in itertools.product(range(0x21, 0x7F), repeat=2):
    BREAKS[_a, _b] = len(_CUT.split(chr(_a) + chr(_b))) == 2

TOKENS = "doc_id bigint, body binary, n_tokens int, " + ", ".join(f"x{i} double" for i in range(DIMENSIONS))
PIECE = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


class PieceEncoder:
    """Ids of pieces without white space, as bytes, two for each id.

    Many pieces are encoded as one text. Pieces of letters alone are one word each to the
    tokenizer, whose last id and no other ends a word, so their ids are told apart by these.
    Between other pieces stands SEPARATOR, a number, which the tokenizer takes alone; it has
    an id that nothing else gives. Pieces that hold it, and all pieces of a tokenizer that
    has no such ids, are encoded one by one. Ids of up to KEPT pieces are kept from slice to
    slice; then all of them go.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit into two bytes")
        self.kept: dict[str, bytes] = {}
        own, a, mixed = (self._ids([t])[0] for t in (SEPARATOR, "a,", f"a,{SEPARATOR}a,"))
        self.separator = int(own[0]) if len(own) == 1 and np.array_equal(mixed, [*a, *own, *a]) else None
        self.ends_word = np.zeros(1 << 16, bool)
        self.ends_word[[i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token.endswith(WORD_END)]] = True
        self.words_end = all(self.ends_word[ids[-1]] and not self.ends_word[ids[:-1]].any() for ids in self._ids(["a", "\xe4", "qzxjk\xfcvwq"]))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u2") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, texts: list[str], words: bool) -> list[bytes]:
        ids = self._ids([("\n" if words else SEPARATOR).join(texts)])[0]
        if words:
            ends = 2 * np.flatnonzero(self.ends_word[ids]) + 2
            starts = np.concatenate([[0], ends[:-1]])
        else:
            ends = 2 * np.append(np.flatnonzero(ids == self.separator), len(ids))
            starts = np.concatenate([[0], ends[:-1] + 2])
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    def _long(self, text: str) -> bytes:
        cut, size = [[]], 0
        for part in _CUT.split(text):
            if size + len(part) > LONG and cut[-1]:
                cut, size = [*cut, []], 0
            cut[-1].append(part)
            size += len(part)
        return b"".join(self._ids(["".join(parts)])[0].tobytes() for parts in cut)

    def __call__(self, pieces: list[str]) -> list[bytes]:
        if len(self.kept) > KEPT:
            self.kept.clear()
        out = list(map(self.kept.get, pieces))
        new = [i for i, ids in enumerate(out) if ids is None]
        letters = map(_LETTERS, [pieces[i] for i in new])
        words, others = [], []
        for i, word in zip(new, letters, strict=True):
            piece = pieces[i]
            if len(piece) <= KEPT_LENGTH:
                if word and self.words_end:
                    words.append(i)
                elif self.separator is not None and SEPARATOR not in piece:
                    others.append(i)
        for kind in (words, others):
            for k in range(0, len(kind), TOGETHER):
                some = kind[k : k + TOGETHER]
                texts = [pieces[i] for i in some]
                ids = self._joined(texts, kind is words)
                self.kept.update(zip(texts, ids, strict=True))
                for i, own in zip(some, ids, strict=True):
                    out[i] = own
        for i in new:
            if out[i] is None:
                out[i] = self._long(pieces[i]) if len(pieces[i]) > LONG else self._ids([pieces[i]])[0].tobytes()
        return out


_encoders: dict[str, PieceEncoder] = {}


def _strings(words: pa.BinaryArray) -> list[str]:
    """Values without line breaks, decoded together."""
    if not len(words):
        return []
    body, at = flat(words)
    joined = np.full(len(body) + len(words) - 1, 0x0A, np.uint8)
    of_word = np.ones(len(joined), bool)
    of_word[at[1:-1] + np.arange(len(words) - 1)] = False
    joined[of_word] = body
    return joined.tobytes().decode("utf-8").split("\n")


def _signs(words: pa.Array) -> np.ndarray:
    """The hashed vector of each word: as many signs as there are dimensions."""
    body, at = flat(words)
    power, inverse = powers(len(body) + 1)
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * power[: len(body)], out=sums[1:])
    bits = mix((sums[at[1:]] - sums[at[:-1]]) * inverse[at[:-1]])[:, None] >> np.arange(DIMENSIONS, dtype=np.uint64)
    return 2.0 * (bits & np.uint64(1)).astype(np.float64) - 1.0


def _tokenize(path: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def tokenize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = PieceEncoder(path)
        encode = _encoders[path]
        encode.kept.clear()  # what an earlier task of this worker has left
        for batch in batches:
            whole, bounds = flat(batch.column(1))
            for first, last in slices(bounds, SLICE):
                n = last - first
                words, row, per_row = word_runs(whole[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], NOT_SPACE_BYTE, breaks=BREAKS)
                encoded = words.dictionary_encode()
                which = encoded.indices.to_numpy(zero_copy_only=False)
                ids = encode(_strings(encoded.dictionary))
                own = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
                begin = np.cumsum(own) - own
                flat_ids = np.frombuffer(b"".join([*ids, np.array([END_ID], "<u2").tobytes()]), "<u2")
                # Each row's pieces in their order, and the end token behind them.
                end_at = np.cumsum(per_row)
                from_, size = np.insert(begin[which], end_at, len(flat_ids) - 1), np.insert(own[which], end_at, 1)
                ends = np.cumsum(size)
                tokens = flat_ids[np.arange(ends[-1]) + np.repeat(from_ - (ends - size), size)]
                upto = np.concatenate([[0], ends[np.cumsum(per_row + 1) - 1]])
                sums = np.zeros((n, DIMENSIONS))
                signs = _signs(encoded.dictionary) if len(which) else np.zeros((0, DIMENSIONS))
                for d in range(DIMENSIONS):
                    sums[:, d] = np.bincount(row, weights=signs[which, d], minlength=n) if len(which) else 0
                point = sums / np.maximum(per_row, 1)[:, None]
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((upto * 2).astype(np.int64)), pa.py_buffer(tokens.astype("<u2"))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], data.cast(pa.binary()), pa.array(np.diff(upto), pa.int32()), *(pa.array(point[:, d]) for d in range(DIMENSIONS))],
                    ["doc_id", "body", "n_tokens", *(f"x{d}" for d in range(DIMENSIONS))])
        encode.kept.clear()

    return tokenize


def token_table(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, body (ids of the text and END_ID, two bytes each), n_tokens and the projected vector."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_tokenize(tokenizer), TOKENS)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of each point on the Hilbert curve; `cells` has a row of coordinates below 2 ** bits for each point.

    Coordinates are turned into the transposed index from the highest bit down (each bit
    swaps or inverts the lower bits of the first coordinate), then Gray decoded.
    """
    x = cells.astype(np.int64).T.copy()
    for k in range(bits - 1, 0, -1):
        low = (1 << k) - 1
        for i in range(len(x)):
            set_ = (x[i] >> k & 1).astype(bool)
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for k in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> k & 1, (1 << k) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for k in range(bits - 1, -1, -1):
        for i in range(len(x)):
            key = key << 1 | (x[i] >> k & 1)
    return key


def _places(tokens: DataFrame) -> Callable[[list[int] | None], Column]:
    """The place of a row, and with `bounds` a struct of its range and place.

    The place is the Hilbert key of the scaled point with HASH_BITS of a hash of the row behind it.
    """
    names = [f"x{d}" for d in range(DIMENSIONS)]
    stats = tokens.agg(*(f(n) for n in names for f in (F.mean, F.stddev_pop))).first()
    middle = np.array([s or 0.0 for s in stats[::2]])
    width = np.array([s or 1.0 for s in stats[1::2]]) * SPREAD * 2
    behind = F.pmod(F.xxhash64("row"), F.lit(1 << HASH_BITS))

    def places(columns: tuple[pd.Series, ...]) -> np.ndarray:
        points = (np.column_stack(columns[:-1]) - middle) / width + 0.5
        cells = np.clip((points * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
        return (hilbert_key(cells) << HASH_BITS) + columns[-1].to_numpy()

    def placed(bounds: list[int] | None = None) -> Column:
        if bounds is None:
            @F.pandas_udf("bigint")
            def place(*columns: pd.Series) -> pd.Series:
                return pd.Series(places(columns))

            return place(*names, behind)
        edges = np.array(bounds, np.int64)

        @F.pandas_udf("range int, place bigint")
        def range_and_place(*columns: pd.Series) -> pd.DataFrame:
            at = places(columns)
            return pd.DataFrame({"range": np.searchsorted(edges, at, "right").astype(np.int32), "place": at})

        return range_and_place(*names, behind)

    return placed


def tail_edges(total: int, sequence: int = SEQUENCE) -> list[int]:
    """Where the sequences behind the last full one begin: the rest, as powers of two from the largest down."""
    at, out = total - total % sequence, []
    while at < total:
        out.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    return out


def _cut(before: dict[int, int], total: int, sequence: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    full = total // sequence
    tail = np.array(tail_edges(total, sequence), np.int64)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            for lo, hi in itertools.pairwise([0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]):
                if own[lo] != now:
                    now, at = own[lo], before[int(own[lo])]
                lengths = batch.column(3)[lo:hi].to_numpy().astype(np.int64)
                starts = at + np.cumsum(lengths) - lengths
                end = at + int(lengths.sum())
                inner = np.arange(at // sequence + 1, min(full, (end - 1) // sequence) + 1, dtype=np.int64) * sequence
                edges = np.concatenate([inner, tail[(tail > at) & (tail < end)]])
                pieces = np.union1d(starts, edges[edges < end])
                doc = np.searchsorted(starts, pieces, "right") - 1
                sizes = np.diff(np.append(pieces, end))
                in_tail = pieces >= full * sequence
                nth = np.searchsorted(tail, pieces, "right") - 1
                seq = np.where(in_tail, full + nth, pieces // sequence)
                seq_at = np.where(in_tail, tail[np.maximum(nth, 0)] if len(tail) else 0, pieces // sequence * sequence)
                ids = flat(batch.column(2)[lo:hi])[0].view("<u2").astype("<u4")
                bounds = ((np.append(pieces, end) - at) * 4).astype(np.int64)
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(pieces), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pc.take(batch.column(1)[lo:hi], pa.array(doc)), *(pa.array(v.astype(np.int64)) for v in (pieces - starts[doc], sizes)), data.cast(pa.binary()),
                     *(pa.array(v.astype(np.int64)) for v in (lengths[doc], seq, pieces - seq_at))],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
                at = end

    return cut


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text", range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """Pieces of documents in their sequences: doc_id, start, length, ids (four bytes each, little endian), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    tokens = materialize(token_table(docs, tokenizer, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "tokens")
    total = tokens.agg(F.sum(F.col("n_tokens").cast("bigint"))).first()[0]
    if not total:
        return spark.createDataFrame([], PIECE)
    ranges = max(-(-total // range_tokens), int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    placed = _places(tokens)
    # A place counts once for every WEIGHED tokens, so that ranges are even in tokens and not in documents.
    weighed = tokens.select(F.explode(F.array_repeat(placed(), F.ceil(F.col("n_tokens") / WEIGHED).cast("int"))).alias("place"))
    cuts = weighed.agg(F.percentile_approx("place", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
    dealt = tokens.withColumn("at", placed(sorted(set(cuts))))
    sums = {r.range: r.n for r in dealt.groupBy("at.range").agg(F.sum(F.col("n_tokens").cast("bigint")).alias("n")).collect()}  # one row per range
    before = dict(zip(sorted(sums), itertools.accumulate((sums[r] for r in sorted(sums)), initial=0), strict=False))
    rows = dealt.select("at.range", "doc_id", "body", "n_tokens", "at.place", "row").repartitionById(ranges, "range").sortWithinPartitions("range", "place", "row")
    return rows.select("range", "doc_id", "body", "n_tokens").mapInArrow(_cut(before, total, sequence), PIECE)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, length and ids of each sequence, from `pack`. A sequence has a bounded number of ids, so its pieces meet in one row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("parts.ids"), F.lit(b"").cast("binary"), lambda all_, ids: F.concat(all_, ids))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select("sequence_id", "length", joined.alias("ids"))
