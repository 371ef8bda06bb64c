"""Texts as flat byte arrays: words, shingles and hashes of a whole Arrow batch at once.

Hashes are 64 bits, polynomial over bytes and mixed at the end. They are equal on every
machine and in every run, so a lost task that runs again gives the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words: digits, letters and everything beyond ASCII. Fixed, as the contract of the word operators states it.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 20
SHINGLE_WORDS = 5

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x41:0x5B] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True
NOT_SPACE_BYTE = np.ones(256, bool)
NOT_SPACE_BYTE[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each value (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i below n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(max(n, SLICE_BYTES + 4096), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(ends, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def slices(at: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most so many bytes, or of one row."""
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, last
        first = last


def words(body: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, ASCII letters in lower case, and the number of words before each row's end.

    `kind` says which bytes belong to words. No word crosses rows. The second array has
    one entry more than rows: row i has the words from [i] to [i + 1].
    """
    n = len(at) - 1
    spaced = np.full(len(body) + n, 0x20, np.uint8)
    spaced[np.arange(len(body)) + np.repeat(np.arange(n), np.diff(at))] = LOWER[body]
    inside = np.zeros(len(spaced) + 1, np.int8)
    inside[1:] = kind[spaced]
    edge = np.flatnonzero(np.diff(inside))  # begins and ends take turns: each row ends with a space
    starts, ends = edge[::2], edge[1::2]
    power, inverse = powers(len(spaced) + 1)
    sums = np.zeros(len(spaced) + 1, np.uint64)
    np.cumsum((spaced.astype(np.uint64) + np.uint64(1)) * power[: len(spaced)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, np.searchsorted(starts, at + np.arange(n + 1))


def shingles(hashes: np.ndarray, upto: np.ndarray, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted set of shingles of each row; a row of fewer words has one shingle of all of them."""
    odd = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(hashes)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total[: n - j] += hashes[j:] * odd[j]
    total = mix(total)
    for first, last in zip(upto[:-1], upto[1:], strict=True):
        if last - first >= size:
            yield np.unique(total[first : last - size + 1])
        elif last > first:
            yield mix((hashes[first:last] * odd[: last - first]).sum(keepdims=True))
        else:
            yield np.zeros(0, np.uint64)


def gram_hashes(body: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """The hash of the `size` bytes from each position at which so many are left, or from the positions `at`."""
    power, inverse = powers(len(body) + 1)
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * power[: len(body)], out=sums[1:])
    if at is not None:
        return mix((sums[at + size] - sums[at]) * inverse[at])
    n = max(0, len(body) - size + 1)
    return mix((sums[size : size + n] - sums[:n]) * inverse[:n])
