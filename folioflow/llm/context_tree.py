"""Language-model scoring with a suffix tree that grows with the texts.

The tree predicts the next symbol of a text from the longest of its contexts that the tree
has kept. Symbols are all bytes of the words, a space between words and the end. A context
is kept by the tests of `suffix_tree`: it was seen often enough, and rows times divergence
from its own suffix reach `DIVERGENCE`. Contexts of up to three symbols are all tested; below
that a context is tested if its suffix was kept, until none passes. A context whose suffix
has no other predecessor never passes, as rows times divergence stay below `SMOOTHING`, so
the rounds end. What is told only by symbols beyond a context that fails is not looked for.

Contexts of up to `START` symbols are counted densely (256 ** 3 numbers, whatever the
texts). From there on each round tests some symbols more (`step`). A pack sends keys: the
different kept contexts of its texts, below each the codes of these symbols of context
and the next symbol, and how often the key was learnt. A shard has all keys below a context, and what
that context gives its next symbols, from the shard that kept it; it tests the contexts, and
answers each pack which of its contexts stay open, and the probabilities that the others give its
next symbols, once for all keys that end at one context. So no task holds the tree. Places in the
texts whose context was not kept have their final probability and take no part in later
rounds. A pack writes its texts once, in slices, compressed, and each round which places are
open; these look their contexts up in what the shards have answered. So places are never sorted
with where they stand: a pack sorts numbers that hold a whole key, and counts equal ones.
Contexts of one length are told apart by 64 bits of a hash, up to 8 symbols exactly.

Cases: as in `suffix_tree`. A context that goes beyond the begin of a text has ends there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import packs, texts
from folioflow.llm.language import held_out
from folioflow.llm.suffix_tree import DIVERGENCE, LEAST_SEEN, SMOOTHING, _send_words, _sum_words, _tokens
from folioflow.session import remove, scratch_dir

#: Symbols of the contexts that are counted densely.
START = 2
#: Symbols by which contexts become longer in the first round, when most are kept, and in later ones, when a longer key would more often be sent in vain.
FIRST_STEP, STEP = 4, 2
SPACE, END = 0x20, 0x0A  # of the bytes between words only the space occurs, so another one is the end
FOLD = np.where(texts.NOT_SPACE_BYTE, texts.LOWER, SPACE).astype(np.uint8)
POSSIBLE = np.zeros(256, bool)
POSSIBLE[FOLD] = POSSIBLE[END] = True
#: Ends before each text, so that the first symbols have a whole word of context.
PAD = 8
PACK_BYTES = 8 << 20  # of text; a task has the keys of a pack beside it
PACKS_OF_SHARD = 2  # there are so many packs for a shard, as every pack sends a row to every shard
#: Parts of the packs, and of the shards, whose rows are replaced after each other, so that old and new ones of a part only are there.
PARTS = 3
SPREAD, AFTER = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)  # odd; for the symbols of a context, and the next one
BUCKET = np.uint64(0x9E3779B97F4A7C15)  # odd; for the place of a number in a table
BYTE = np.uint64(255)
#: Bytes of text in a slice, so that what is made of it is near the processor; a longer text is alone.
SLICE_BYTES = 1 << 18

SLICE = [("slice", pa.int32()), ("sizes", pa.binary()), ("symbols", pa.binary())]
STATE = [
    ("doc_id", pa.list_(pa.int64())), ("learn", pa.list_(pa.bool_())), ("n_tokens", pa.list_(pa.int64())), ("n_known", pa.list_(pa.int64())),
    ("base", pa.list_(pa.float64())), ("score", pa.list_(pa.float64())), ("active", pa.binary())]
KEYS = [("shard", pa.int32()), ("suffixes", pa.binary()), ("fan", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary())]
ROWS = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("pack", pa.int32()), *SLICE, *STATE, ("tokens", pa.int64()), ("words", pa.int64()), *KEYS])
ROWS_DDL = ("kind string, part int, pack int, slice int, sizes binary, symbols binary, doc_id array<bigint>, learn array<boolean>, n_tokens array<bigint>, n_known array<bigint>, base array<double>, score array<double>, "
            "active binary, tokens bigint, words bigint, shard int, suffixes binary, fan binary, codes binary, counts binary")
JUDGED = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("pack", pa.int32()), ("shard", pa.int32()), ("suffixes", pa.binary()), ("fan", pa.binary()), ("codes", pa.binary()),
                    ("logs", pa.binary()), ("open_fan", pa.binary()), ("open", pa.binary())])
JUDGED_DDL = "kind string, part int, pack int, shard int, suffixes binary, fan binary, codes binary, logs binary, open_fan binary, open binary"


def symbols_of(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of some rows, one space between words and an end after each row, and how many each row has."""
    rows = len(at) - 1
    symbols, own = np.full(len(body) + rows, END, np.uint8), np.ones(len(body) + rows, bool)
    own[at[1:] + np.arange(rows)] = False
    symbols[own] = FOLD[body]
    keep = symbols != SPACE
    keep[:-1] |= keep[1:] & (symbols[1:] != END)  # the last space before a word
    symbols = symbols[keep]
    first = symbols == SPACE
    first[1:] &= symbols[:-1] == END  # but not before the first word
    if first.any():
        symbols = symbols[~first]
    return symbols, np.diff(np.flatnonzero(symbols == END), prepend=-1)


def _count_codes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256 ** (START + 1), np.uint32)
    for batch in batches:
        body, at = texts.flat(batch.column(0))
        for i, j in texts.slices(at, SLICE_BYTES):
            symbols, sizes = symbols_of(body[at[i] : at[j]], at[i : j + 1] - at[i])
            before = np.concatenate([np.full(2, END, np.uint8), symbols, np.full(1, END, np.uint8)])
            codes = np.ndarray(len(symbols), "<u4", before, strides=(1,)) & np.uint32(0xFFFFFF)
            begin = np.cumsum(sizes) - sizes
            codes[begin] = codes[begin] & np.uint32(0xFFFF00) | np.uint32(END)  # not the last symbol of the row before
            codes.sort()
            first = _runs(codes)
            total[codes[first]] += np.diff(np.append(first, len(codes))).astype(np.uint32)
    seen = np.flatnonzero(total)
    for first in range(0, len(seen), 100_000):
        own = seen[first : first + 100_000]  # here the next symbol is in the highest byte
        yield pa.RecordBatch.from_arrays([pa.array((own & 255) << 16 | own & 0xFF00 | own >> 16), pa.array(total[own].astype(np.int64))], ["code", "n"])


class Start:
    """The tree to contexts of `START` symbols: log10 of the next symbols of each last symbol, and of the kept contexts of two."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        root = (np.bincount(codes & 255, n, 256) + 0.5 * POSSIBLE) / (n.sum() + 0.5 * POSSIBLE.sum())
        one = self._smoothed(np.bincount(codes & 65535, n, 65536).reshape(256, 256), np.tile(root, (256, 1)))[0]
        self.context, row = np.unique(codes >> 8, return_inverse=True)
        seen = np.bincount(row * 256 + (codes & 255), n, len(self.context) * 256).reshape(-1, 256)
        two, kept = self._smoothed(seen, one[self.context & 255])
        with np.errstate(divide="ignore"):
            self.one, self.two = np.log10(one).astype(np.float32), np.log10(two[kept]).astype(np.float32)
        self.context = self.context[kept]

    @staticmethod
    def _smoothed(seen: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = seen.sum(axis=1, keepdims=True)
        share = np.divide(seen, total * suffix, out=np.ones(seen.shape), where=seen > 0)
        kept = (total[:, 0] >= LEAST_SEEN) & ((seen * np.log(share)).sum(axis=1) >= DIVERGENCE)
        return np.where(kept[:, None], (seen + SMOOTHING * suffix) / (total + SMOOTHING), suffix), kept

    def table(self) -> np.ndarray:
        out = np.tile(self.one, (256, 1))
        out[self.context] = self.two
        return out.reshape(-1)


def fit_start(train: DataFrame) -> Start:
    """`train`: text. At most 256 ** 3 numbers come to the driver."""
    counted = train.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_count_codes, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    return Start(counted.code.to_numpy(np.int64), counted.n.to_numpy(np.float64))


def step(depth: int) -> int:
    return FIRST_STEP if depth == START else STEP


def _code(step: int) -> tuple[np.uint64, np.uint64]:
    """The bits of a code of so many symbols and the next one, and all of them set."""
    return np.uint64(8 * (step + 1)), np.uint64((1 << 8 * (step + 1)) - 1)


class Places:
    """The symbols of some rows, `PAD` ends before each, and where the own symbols of the rows are (`at`)."""

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray):
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.begin = (np.cumsum(sizes) - sizes + PAD * np.arange(len(sizes))).astype(np.int64)  # of the ends before a row
        self.at = np.arange(PAD, PAD + len(symbols)) + PAD * self.row
        self.symbols = np.full(len(symbols) + PAD * len(sizes), END, np.uint8)
        self.symbols[self.at] = symbols
        self.words = np.ndarray(len(self.symbols) - 7, "<u8", self.symbols, strides=(1,))

    def words_at(self, at: np.ndarray) -> np.ndarray:
        if 8 * len(at) < len(self.symbols):
            return self.words[at]
        return self.words.copy().take(at)  # aligned, which is much faster to take from


class Contexts:
    """The first `depth` symbols of the contexts of some places of `places`, in words of 8; the nearest symbol is in the highest byte of the first word."""

    def __init__(self, places: Places, place: np.ndarray, depth: int):
        at = places.at[place] if len(place) < len(places.at) else places.at
        self.after = places.symbols.take(at).astype(np.uint64)
        self.words = [places.words_at(at - 8)]
        if depth > 8:
            begin = places.begin[places.row[place]]
            self.words += [places.words_at(np.maximum(at - 8 - j, begin)) for j in range(8, depth, 8)]

    def of(self, some: np.ndarray) -> Contexts:
        out = object.__new__(Contexts)
        out.after, out.words = self.after.take(some), [x.take(some) for x in self.words]
        return out

    def hashes(self, depth: int) -> np.ndarray:
        out = (self.words[0] & np.uint64((1 << 64) - (1 << max(0, 64 - 8 * depth)))) * SPREAD
        for j, weight in enumerate(_weights(depth)[8:], 8):
            out += (self.words[j // 8] >> np.uint64(56 - 8 * (j % 8)) & BYTE) * weight
        return out

    def pairs(self, depth: int) -> np.ndarray:
        """Hashes of the contexts of `depth` symbols and the next symbol."""
        return self.hashes(depth) + (self.after + np.uint64(1)) * AFTER

    def codes(self, depth: int, step: int) -> np.ndarray:
        """`step` symbols of context beyond `depth` and the next symbol."""
        if depth // 8 == (depth + step - 1) // 8:  # all in one word
            out = self.words[depth // 8] >> np.uint64(64 - 8 * (depth % 8 + step)) & _code(step - 1)[1]
            return out << np.uint64(8) | self.after
        out = np.zeros(len(self.after), np.uint64)
        for j in range(depth, depth + step):
            out |= self.words[j // 8] >> np.uint64(56 - 8 * (j % 8)) & BYTE
            out <<= np.uint64(8)
        return out | self.after


def _weights(n: int) -> np.ndarray:
    """What a symbol of context counts in the hash, by its distance: the first 8 their place in a word, so that contexts of up to 8 symbols are told apart exactly."""
    out = texts.powers(n)[0] * SPREAD
    out[:8] = SPREAD << np.arange(56, -1, -8, dtype=np.uint64)[:n]
    return out


class Table:
    """Finds numbers among different ones, each in a place by its hash, or in one of the tables behind if that is taken."""

    def __init__(self, numbers: np.ndarray, values: np.ndarray):
        bits = max(12, len(numbers).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        place = self._place(numbers)
        last = np.zeros(1 << bits, np.int32)
        last[place] = np.arange(len(numbers), dtype=np.int32)  # of those with one place one stays
        stays = last[place] == np.arange(len(numbers))
        self.numbers, self.values, self.next = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, values.dtype), None
        self.numbers[0] = 1  # no number that belongs there, as 1 is not placed there
        self.numbers[place[stays]], self.values[place[stays]] = numbers[stays], values[stays]
        if not stays.all():
            self.taken = np.zeros(1 << bits, bool)
            self.taken[place[~stays]] = True
            self.next = Table(numbers[~stays], values[~stays])

    def _place(self, x: np.ndarray) -> np.ndarray:
        return (x * BUCKET >> self.shift).view(np.int64)

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """If each of `x` is there, and its value."""
        place = self._place(x)
        hit = self.numbers.take(place) == x
        here, values = np.flatnonzero(hit), np.empty(len(x), self.values.dtype)  # many times faster than to take by a mask
        values[here] = self.values.take(place.take(here))
        if self.next is not None:
            rest = np.flatnonzero(self.taken.take(place) & ~hit)
            hit[rest], values[rest] = self.next.find(x.take(rest))
        return hit, values


def _merged(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers of some sorted runs, and which one each number is."""
    order = np.argsort(x, kind="stable")  # merges the runs
    x = x.take(order)
    other = np.append(True, x[1:] != x[:-1])[: len(x)]
    of = np.empty(len(x), np.int32)
    of[order] = np.cumsum(other, dtype=np.int32) - np.int32(1)
    return x.take(np.flatnonzero(other)), of


def _runs(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers begin."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])[: len(x)])


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[_runs(x)]


def _squeeze(x: np.ndarray) -> bytes:
    """Numbers from 0, in as many bytes as the largest needs, by bytes of one rank, compressed."""
    width = next(w for w in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * w)
    planes = np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + len(x).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if len(x) else b"")


def _unsqueeze(x: bytes) -> np.ndarray:
    width, n = x[0], int.from_bytes(x[1:9], "little")
    if not n:
        return np.zeros(0, np.uint8)
    planes = np.frombuffer(pa.decompress(memoryview(x)[9:], n * width, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<u{width}").reshape(-1)


def _concat(parts: Iterable[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts]).astype(kind, copy=False)


class Keys:
    """The different keys of a pack, sorted by suffix and code."""

    def __init__(self, suffixes: np.ndarray, step: int):
        """`suffixes`: hashes of contexts, sorted; keys are added by their numbers."""
        self.bits, self.code = _code(step)
        self.most = 1 << 63 - int(self.bits)  # number, code and if it was learnt are 64 bits together
        self.suffixes, self.parts = suffixes, [[] for _ in range(0, len(suffixes), self.most)]

    def add(self, of: np.ndarray, codes: np.ndarray, learnt: np.ndarray) -> None:
        for k, part in enumerate(self.parts):
            if len(self.parts) == 1:
                part.append((of.astype(np.uint64) << self.bits | codes) << np.uint64(1) | learnt)
            else:
                own = np.flatnonzero(of // self.most == k)
                part.append(((of[own] - k * self.most).astype(np.uint64) << self.bits | codes[own]) << np.uint64(1) | learnt[own])

    def rows(self, pack: int, shards: int) -> pa.Table:
        """A row for each shard; all keys of a suffix go to one shard."""
        parts = []
        for k in range(len(self.parts)):
            x, self.parts[k] = _concat(self.parts[k], np.uint64), None
            x.sort()
            runs = _runs(x)
            x, n = x[runs], np.diff(np.append(runs, len(x)))
            n *= (x & np.uint64(1)).astype(np.int64)
            x >>= np.uint64(1)
            runs = _runs(x)
            counts = np.add.reduceat(n, runs) if len(runs) else n
            x = x[runs]
            parts.append((np.bincount((x >> self.bits).astype(np.int64), minlength=len(self.suffixes[k * self.most : (k + 1) * self.most])), x & self.code, counts))
        fan, codes, counts = (_concat((x[i] for x in parts), kind) for i, kind in enumerate((np.int64, np.uint64, np.int64)))
        suffixes, fan = self.suffixes[fan > 0], fan[fan > 0]
        at = np.append(0, np.cumsum(fan))
        cut = list(packs.ranges(suffixes, shards))
        return _table(ROWS, kind=["keys"] * len(cut), part=[s % PARTS for s, _, _ in cut], pack=[pack] * len(cut), shard=[s for s, _, _ in cut],
                      suffixes=[_squeeze(np.diff(suffixes[i:j], prepend=np.uint64(0))) for _, i, j in cut], fan=[_squeeze(fan[i:j]) for _, i, j in cut],
                      codes=[_squeeze(codes[at[i] : at[j]]) for _, i, j in cut], counts=[_squeeze(counts[at[i] : at[j]]) for _, i, j in cut])


def _table(schema: pa.Schema, **columns) -> pa.Table:
    n = len(next(iter(columns.values())))
    return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _begin(shards: int):
    def begin(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """A row per slice of documents, one with the sums of shards, and the keys below contexts of `START` symbols."""
        hashes, begin = _tokens(docs)
        answers = answers.sort_by("shard")
        c = Table(_distinct(hashes), np.concatenate([np.frombuffer(x, np.int64) for x in answers.column("sums").to_pylist()])).find(hashes)[1]
        sums, known = np.append(0, np.cumsum(np.log10(c + 1.0))), np.append(0, np.cumsum(c > 0))
        del hashes, c
        pack, learn, ids = docs.column("pack")[0].as_py(), docs.column("learn").to_numpy(), docs.column("doc_id").to_pylist()
        n_tokens, n_known, base = np.diff(begin), np.diff(known[begin]), np.diff(sums[begin])
        body, at = texts.flat(docs.column("body"))
        rows, (hashes, rank) = [], _first_contexts()
        keys = Keys(hashes, FIRST_STEP)
        for k, (i, j) in enumerate(texts.slices(at, SLICE_BYTES)):
            symbols, sizes = symbols_of(body[at[i] : at[j]], at[i : j + 1] - at[i])
            places = Places(symbols, sizes)
            contexts = Contexts(places, np.arange(len(symbols)), START + FIRST_STEP)
            keys.add(rank.take((contexts.words[0] >> np.uint64(48)).view(np.int64)), contexts.codes(START, FIRST_STEP), np.repeat(learn[i:j], sizes))
            own = {"part": pack % PARTS, "pack": pack, "slice": k}
            rows.append({"kind": "slice", **own, "sizes": _squeeze(sizes), "symbols": _squeeze(symbols)})
            rows.append({"kind": "state", **own, "doc_id": ids[i:j], "learn": learn[i:j].tolist(), "n_tokens": n_tokens[i:j].tolist(), "n_known": n_known[i:j].tolist(), "base": base[i:j].tolist(),
                         "score": [0.0] * (j - i), "active": _squeeze(np.packbits(np.ones(len(symbols), bool)))})
        rows.append({"kind": "total", "part": 0, "pack": pack, "tokens": sum(answers.column("tokens").to_pylist()), "words": sum(answers.column("words").to_pylist())})
        return pa.concat_tables([pa.Table.from_pylist(rows, ROWS), keys.rows(pack, shards)])

    return begin


def _first_contexts() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all contexts of `START` symbols, sorted, and the number of each context, the nearest symbol in the highest byte."""
    code, weights = np.arange(256**START, dtype=np.uint64), _weights(START)
    hashes = sum((code >> np.uint64(8 * (START - 1 - j)) & BYTE) * weights[j] for j in range(START))
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return hashes[order], rank


_tables: dict[bytes, np.ndarray] = {}


def _first_suffixes(start: Start, suffixes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What contexts of `START` symbols give the next symbols, from the dense counts."""
    key = start.one.tobytes() + start.context.tobytes() + start.two.tobytes()
    if key not in _tables:
        _tables.clear()
        _tables[key] = start.table()  # once per Python worker
    hashes, rank = _first_contexts()
    near = np.argsort(rank)  # the contexts in order of their hashes; the dense counts have the nearest symbol in the lowest byte
    context = (near >> 8 | (near & 255) << 8)[np.searchsorted(hashes, suffixes)]
    return 10.0 ** _tables[key][(context << 8) + after].astype(np.float64)


def _judge(start: Start, depth: int, shards: int):
    more, (bits, _) = step(depth), _code(step(depth))

    def judge(table: pa.Table) -> pa.Table:
        """Tests the contexts of up to `step` symbols more than `depth`.

        For each pack: which contexts below its own stay open, as they were kept, and log10 of
        the next symbols of the others. For the shards of the next round: what the kept contexts give.
        """
        sent, given = table.filter(pc.equal(table.column("kind"), "keys")), table.filter(pc.equal(table.column("kind"), "given"))
        if not sent.num_rows:
            return JUDGED.empty_table()
        suffixes = [np.cumsum(_unsqueeze(x), dtype=np.uint64) for x in sent.column("suffixes").to_pylist()]
        begin = np.cumsum([0, *map(len, suffixes)])
        suffix, of = _merged(_concat(suffixes, np.uint64))
        assert len(suffix) < 1 << 64 - int(bits), len(suffix)
        codes = [_unsqueeze(x) for x in sent.column("codes").to_pylist()]
        cuts = np.cumsum([0, *map(len, codes)])
        keys = np.repeat(of.astype(np.uint64) << bits, _concat((_unsqueeze(x) for x in sent.column("fan").to_pylist()), np.int64))
        keys |= _concat(codes, np.uint64)
        del suffixes, codes
        different, place = _merged(keys)
        n = np.bincount(place, _concat((_unsqueeze(x) for x in sent.column("counts").to_pylist()), np.int64), len(different))
        del keys
        # levels[j]: the different keys of `j` symbols more than `depth`, how often each was learnt, and which key of j - 1 symbols each one has.
        levels = [(different, n, None)]
        for _ in range(more):
            longer, n, _ = levels[0]
            shorter, up = np.unique(longer >> np.uint64(16) << np.uint64(8) | longer & BYTE, return_inverse=True)
            up = up.astype(np.int32)
            levels[0] = (longer, n, up)
            levels.insert(0, (shorter, np.bincount(up, n, len(shorter)), None))
        own, after = (levels[0][0] >> np.uint64(8)).astype(np.int64), (levels[0][0] & BYTE).astype(np.int64)
        if depth == START:
            p = _first_suffixes(start, suffix[own], after)
        else:
            fan = _concat((_unsqueeze(x) for x in given.column("fan").to_pylist()), np.int64)
            before = np.repeat(_concat((np.cumsum(_unsqueeze(x), dtype=np.uint64) for x in given.column("suffixes").to_pylist()), np.uint64), fan)
            symbol = _concat((_unsqueeze(x) for x in given.column("codes").to_pylist()), np.int64)
            key = np.searchsorted(suffix, before) << 8 | symbol
            order = np.argsort(key)
            at = order[np.searchsorted(key[order], own << 8 | after)]
            p = 10.0 ** _concat((_unsqueeze(x) for x in given.column("logs").to_pylist()), np.uint32).view(np.float32)[at].astype(np.float64)
            assert np.array_equal(before[at], suffix[own]) and np.array_equal(symbol[at], after)
        kept, reach, logs = np.ones(len(own), bool), np.zeros(len(own), np.int8), []
        for keys, n, up in levels[1:]:
            logs.append(np.log10(p).astype(np.float32).view(np.uint32))
            p, kept = _test(keys, n, p.take(up), kept.take(up))
            reach = reach.take(up) + kept
        # A pair is a key of the length that a key of this round reaches.
        first, numbers, up = np.cumsum([0, *(len(x) for x, _, _ in levels[:-1])]), np.empty(len(different), np.int32), np.arange(len(different), dtype=np.int32)
        for r in range(more - 1, -1, -1):
            up = levels[r + 1][2].take(up)
            here = np.flatnonzero(reach == r)
            numbers[here] = first[r] + up.take(here)
        pairs, pair_logs = np.concatenate([x for x, _, _ in levels[:-1]]), np.concatenate(logs)
        pair_reach = np.repeat(np.arange(more), np.diff(first))
        pair_own = (pairs >> (8 * pair_reach + 8).astype(np.uint64)).astype(np.int32)
        pairs &= (np.uint64(1) << (8 * pair_reach + 8).astype(np.uint64)) - np.uint64(1)
        own, after, logs = (different >> bits).astype(np.int32), (different & BYTE).astype(np.int64), np.log10(p).astype(np.float32).view(np.uint32)
        del levels, up
        contexts = different[kept] >> np.uint64(8)
        other = np.append(True, contexts[1:] != contexts[:-1])[: len(contexts)]
        contexts, numbers[kept] = contexts[other], np.cumsum(other) - 1
        context_own, contexts = (contexts >> bits - np.uint64(8)).astype(np.int32), contexts & _code(more - 1)[1]
        answers = []
        for i, j, first, last in zip(cuts[:-1], cuts[1:], begin[:-1], begin[1:], strict=True):
            open_, number, own_ = kept.take(place[i:j]), numbers.take(place[i:j]), of[first:last]
            mine, opened = _distinct(number.take(np.flatnonzero(~open_))), _distinct(number.take(np.flatnonzero(open_)))
            fan = np.bincount(pair_reach[mine] * len(own_) + np.searchsorted(own_, pair_own[mine]), minlength=more * len(own_))
            open_fan = np.bincount(np.searchsorted(own_, context_own[opened]), minlength=len(own_))
            answers.append((_squeeze(fan), _squeeze(pairs[mine]), _squeeze(pair_logs[mine]), _squeeze(open_fan), _squeeze(contexts[opened])))
        fans, codes, values, open_fans, opens = zip(*answers, strict=True)
        to_packs = _table(JUDGED, kind=["answer"] * len(answers), part=[x % PARTS for x in sent.column("pack").to_pylist()], pack=sent.column("pack").to_pylist(), shard=sent.column("shard").to_pylist(),
                          suffixes=sent.column("suffixes").to_pylist(), fan=fans, codes=codes, logs=values, open_fan=open_fans, open=opens)
        hashes = _longer(suffix[own[kept]], different[kept] >> np.uint64(8), depth, more)
        order = np.argsort(hashes, kind="stable")
        contexts, at = np.unique(hashes, return_counts=True)
        at, after, logs = np.append(0, np.cumsum(at)), after[kept][order], logs[kept][order]
        cut = list(packs.ranges(contexts, shards))
        return pa.concat_tables([to_packs, _table(
            JUDGED, kind=["given"] * len(cut), part=[s % PARTS for s, _, _ in cut], shard=[s for s, _, _ in cut], suffixes=[_squeeze(np.diff(contexts[i:j], prepend=np.uint64(0))) for _, i, j in cut],
            fan=[_squeeze(np.diff(at[i : j + 1])) for _, i, j in cut], codes=[_squeeze(after[at[i] : at[j]]) for _, i, j in cut], logs=[_squeeze(logs[at[i] : at[j]]) for _, i, j in cut])])

    return judge


def _longer(hashes: np.ndarray, symbols: np.ndarray, depth: int, more: int) -> np.ndarray:
    """Hashes of contexts of `depth` symbols made longer by `more` symbols, the last in the lowest byte."""
    weights, out = _weights(depth + more), hashes.copy()
    for j in range(more):
        out += (symbols >> np.uint64(8 * (more - 1 - j)) & BYTE) * weights[depth + j]
    return out


def _test(keys: np.ndarray, n: np.ndarray, before: np.ndarray, tested: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each key has after contexts of one symbol more were tested, and if its context was kept. `before`: what it had."""
    begin = _runs(keys >> np.uint64(8))
    sizes = np.diff(np.append(begin, len(keys)))
    total = np.add.reduceat(n, begin)
    share = np.divide(n, np.repeat(total, sizes) * before, out=np.ones(len(n)), where=n > 0)
    kept = tested & np.repeat((total >= LEAST_SEEN) & (np.add.reduceat(n * np.log(share), begin) >= DIVERGENCE), sizes)
    return np.where(kept, (n + SMOOTHING * before) / (np.repeat(total, sizes) + SMOOTHING), before), kept


def _told(answers: pa.Table, depth: int) -> tuple[np.ndarray, list[Table]]:
    """Hashes of the contexts that stay open, sorted; and by reach the pairs, with log10 of each."""
    more = step(depth)
    open_, pairs, values = [], [[] for _ in range(more)], [[] for _ in range(more)]
    for row in answers.to_pylist():
        suffixes = np.cumsum(_unsqueeze(row["suffixes"]), dtype=np.uint64)
        open_.append(_longer(np.repeat(suffixes, _unsqueeze(row["open_fan"])), _unsqueeze(row["open"]).astype(np.uint64), depth, more))
        fan, codes, logs, first = _unsqueeze(row["fan"]).reshape(more, -1), _unsqueeze(row["codes"]).astype(np.uint64), _unsqueeze(row["logs"]).astype(np.uint32).view(np.float32), 0
        for reach in range(more):
            last = first + int(fan[reach].sum())
            own = codes[first:last]
            pairs[reach].append(_longer(np.repeat(suffixes, fan[reach]), own >> np.uint64(8), depth, reach) + ((own & BYTE) + np.uint64(1)) * AFTER)
            values[reach].append(logs[first:last])
            first = last
    return _distinct(_concat(open_, np.uint64)), [Table(_concat(x, np.uint64), _concat(y, np.float32)) for x, y in zip(pairs, values, strict=True)]


def _deepen(depth: int, shards: int):
    longer = depth + step(depth)

    def deepen(rows: pa.Table, answers: pa.Table) -> pa.Table:
        """The states after the answers on contexts below those of `depth` symbols, and the keys below the kept ones."""
        rows = rows.select(ROWS.names).cast(ROWS)
        of_kind = lambda kind: rows.filter(pc.equal(rows.column("kind"), kind))
        states = of_kind("state")
        if not answers.num_rows:
            return states
        states, slices = states.to_pylist(), {x["slice"]: x for x in of_kind("slice").select(["slice", "sizes", "symbols"]).to_pylist()}
        suffixes, pairs = _told(answers, depth)
        open_, keys = Table(suffixes, np.arange(len(suffixes), dtype=np.int32)), Keys(suffixes, step(longer))
        for row in states:
            if row["active"] is None:
                continue
            places = Places(_unsqueeze(slices[row["slice"]]["symbols"]), _unsqueeze(slices[row["slice"]]["sizes"]))
            place = np.flatnonzero(np.unpackbits(_unsqueeze(row["active"]), count=len(places.row)).view(bool))
            contexts = Contexts(places, place, longer)
            is_open, of = open_.find(contexts.hashes(longer))
            more, rest = np.flatnonzero(is_open), np.flatnonzero(~is_open)
            left, logs = contexts.of(rest), np.zeros(len(place), np.float32)
            for reach in range(len(pairs) - 1, -1, -1):
                hit, values = pairs[reach].find(left.pairs(depth + reach))
                found, hit = np.flatnonzero(hit), np.flatnonzero(~hit)
                logs[rest.take(found)] = values.take(found)
                left, rest = left.of(hit), rest.take(hit)
            assert not len(rest), len(rest)
            row["score"] = (np.array(row["score"]) + np.bincount(places.row[place], logs, len(places.begin))).tolist()
            place = place.take(more)
            if not len(place):
                row["active"] = None
                continue
            keys.add(of.take(more), Contexts(places, place, longer + step(longer)).codes(longer, step(longer)), np.array(row["learn"], bool)[places.row[place]])
            mask = np.zeros(len(places.row), bool)
            mask[place] = True
            row["active"] = _squeeze(np.packbits(mask))
        pack = states[0]["pack"]
        return pa.concat_tables([pa.Table.from_pylist(states, ROWS), keys.rows(pack, shards)])

    return deepen


def _store(df: DataFrame, path: str) -> None:
    """Adds the rows, in a folder for each kind and part, so that these can be deleted when their use is over."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")  # the shuffles go as soon as the rows are written
    try:
        df.write.mode("append").partitionBy("kind", "part").parquet(path)
    finally:
        conf.set(name, before)


def _stored(spark: SparkSession, path: str, ddl: str, kind: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(path).filter(F.col("kind") == kind)


def _first_rows(docs: DataFrame, pack_bytes: int) -> tuple[str, int]:
    """Where the rows before the first round are, and the number of shards."""
    rows, n = packs.packed(docs.select("doc_id", "text"), pack_bytes, learn=~held_out(F.col("doc_id"), 7))
    sent = rows.groupBy("pack").applyInArrow(_send_words(n), "shard int, pack int, hashes binary, counts binary")
    answers = sent.groupBy("shard").applyInArrow(_sum_words, "pack int, shard int, sums binary, tokens bigint, words bigint")
    path, shards = scratch_dir(docs.sparkSession, "lm-contexts"), max(packs.LEAST_PACKS, -(-n // PACKS_OF_SHARD))
    _store(rows.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(_begin(shards), ROWS_DDL), path)
    return path, shards


def _round(spark: SparkSession, first: str, path: str, given: str | None, start: Start, depth: int, shards: int) -> tuple[str, str]:
    """Where the rows and what kept contexts give are after contexts of `depth` symbols were made longer. Deletes those from before.

    `first`: where the texts are; `path`: states and keys.
    """
    keys = _stored(spark, path, ROWS_DDL, "keys").select("kind", "part", "pack", "shard", "suffixes", "fan", "codes", "counts", F.lit(None).cast("binary").alias("logs"))
    if given:
        keys = keys.union(_stored(spark, given, JUDGED_DDL, "given").select("kind", "part", "pack", "shard", "suffixes", "fan", "codes", F.lit(None).cast("binary").alias("counts"), "logs"))
    judged, after = scratch_dir(spark, "lm-judged"), scratch_dir(spark, "lm-contexts")
    for part in range(PARTS):
        _store(keys.filter(F.col("part") == part).groupBy("shard").applyInArrow(_judge(start, depth, shards), JUDGED_DDL), judged)
        remove(spark, f"{path}/kind=keys/part={part}")
    if given:
        remove(spark, given)
    for part in range(PARTS):
        rows = _stored(spark, first, ROWS_DDL, "slice").union(_stored(spark, path, ROWS_DDL, "state")).filter(F.col("part") == part)
        answers = _stored(spark, judged, JUDGED_DDL, "answer").filter(F.col("part") == part).select("pack", "shard", "suffixes", "fan", "codes", "logs", "open_fan", "open")
        _store(rows.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(_deepen(depth, shards), ROWS_DDL), after)
        remove(spark, f"{path}/kind=state/part={part}")
        remove(spark, f"{judged}/kind=answer/part={part}")
    if path != first:
        remove(spark, path)
    return after, judged


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(c).flatten() for c in SCORED], SCORED)


SCORED = ["doc_id", "learn", "n_tokens", "n_known", "base", "score"]


def lm_scores(docs: DataFrame, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    start = fit_start(docs.filter(~held_out(F.col("doc_id"), 7)).select("text"))
    first, shards = _first_rows(docs, pack_bytes)
    total = _stored(spark, first, ROWS_DDL, "total").agg(F.sum("tokens"), F.sum("words")).first()
    path, given, depth = first, None, START
    while not _stored(spark, path, ROWS_DDL, "keys").select("shard").isEmpty():
        path, given = _round(spark, first, path, given, start, depth, shards)
        depth += step(depth)
    if given:
        remove(spark, given)
    remove(spark, f"{first}/kind=slice")
    tokens, words = total[0] or 0, total[1] or 0
    norm = float(np.log10(tokens + 1 * (words + 1)))
    rows = _stored(spark, path, ROWS_DDL, "state").select(*SCORED).mapInArrow(_documents, "doc_id bigint, learn boolean, n_tokens bigint, n_known bigint, base double, score double")
    return rows.select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * norm).alias("base_score"), "score")
