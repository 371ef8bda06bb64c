"""Words of a text as an array, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What lies between words: everything that folioflow.llm.texts.WORD_PATTERN leaves out. Fixed.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_words(text: Column) -> Column:
    """Words with A-Z in lower case. Null counts as empty.

    `lower` also changes letters beyond ASCII, always to letters beyond ASCII but for the
    Kelvin sign, which is put out of its way. Words of two texts that differ in the case
    of such letters are taken as the same.
    """
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ"))
    return F.filter(F.split(F.lower(text), BETWEEN), lambda w: w != "")


def ascii_lower_words(text: Column) -> Column:
    """The same words with only A-Z in lower case. Slower, so for the few texts that have to be compared exactly."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), upper, lower), BETWEEN), lambda w: w != "")


def gram_hash(words: Column, at: Column, size: int) -> Column:
    """Hash of the words from `at` (from 0)."""
    return F.xxhash64(*(F.get(words, at + j) for j in range(size)))


def gram_text(words: Column, at: Column, size: int) -> Column:
    return F.concat_ws(" ", F.slice(words, at + 1, size))


def starts(words: Column, size: int) -> Column:
    """Places at which a run of `size` words begins; none if there are fewer."""
    return F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
