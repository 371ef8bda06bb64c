"""Words of a slice of texts as Arrow strings, so that equal words are found by their bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from folioflow.llm.texts import LOWER


def _binary(body: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    if len(body) >= 1 << 31:
        raise ValueError("more than 2 GB of pieces in a slice")
    bounds = np.concatenate([[0], ends]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(body)])


def _cut(body: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """The pieces of `body` that begin at `starts`, as binary values."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return _binary(body[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)], ends)


def word_runs(
    body: np.ndarray, at: np.ndarray, kind: np.ndarray, sizes: tuple[int, int] = (1, 1), lower: bool = False, breaks: np.ndarray | None = None,
) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """All runs of sizes[0] to sizes[1] consecutive words, joined by one space; the row of each; words of each row.

    `body` and `at` are those of `texts.flat`; `kind` says which bytes belong to words. No
    run crosses rows. `lower` puts A-Z in lower case. `breaks`, a table by two bytes, says
    where a word ends though the next byte belongs to one too.
    """
    n = len(at) - 1
    spaced = np.full(len(body) + n, 0x20, np.uint8)
    of_text = np.ones(len(spaced), bool)
    of_text[at[1:] + np.arange(n)] = False  # a space behind each row
    spaced[of_text] = LOWER[body] if lower else body
    inside = np.zeros(len(spaced) + 1, bool)
    inside[1:] = kind[spaced]
    if breaks is None:
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, lengths = edge[::2], edge[1::2] - edge[::2]
    else:
        ends_here = np.ones(len(spaced), bool)  # between this byte and the next
        pair = spaced[:-1].astype(np.uint16)
        pair <<= 8
        pair |= spaced[1:]
        ends_here[:-1] = breaks.ravel()[pair]
        ends_here[:-1] |= inside[1:-1] != inside[2:]
        starts = np.flatnonzero(inside[1:] & np.concatenate([np.ones(1, bool), ends_here])[: len(spaced)])
        lengths = np.flatnonzero(inside[1:] & ends_here) + 1 - starts
    upto = np.searchsorted(starts, at + np.arange(n + 1))
    words = np.diff(upto)
    row = np.repeat(np.arange(n), words)
    letters = spaced[inside[1:]]
    if sizes == (1, 1):
        return _binary(letters, np.cumsum(lengths)), row, words
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    joined = np.full(len(letters) + len(lengths), 0x20, np.uint8)  # each word and a space
    of_word = np.ones(len(joined), bool)
    of_word[begin + lengths] = False
    joined[of_word] = letters
    left = upto[row + 1] - np.arange(len(row)) if len(row) else np.zeros(0, np.int64)  # words from here to the end of the row
    runs, rows = [], []
    for size in range(sizes[0], sizes[1] + 1):
        first = np.flatnonzero(left >= size)
        last = first + size - 1
        runs.append(_cut(joined, begin[first], begin[last] + lengths[last] - begin[first]))
        rows.append(row[first])
    return pa.concat_arrays(runs), np.concatenate(rows), words
