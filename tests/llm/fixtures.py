"""Small tables with all the odd cases, and brute-force versions of what the operators compute."""

from __future__ import annotations

import random
import re

from folioflow.llm.texts import SHINGLE_WORDS, WORD_PATTERN

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(WORD_PATTERN)
NAMES = ["digest", "pack", "words", "node", "score", "keep_id", "copy_id", "hash", "n", "slot", "row", "shard", "spans"]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "the", "ör", "ti", "on", "re", "sh", "é"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def documents(spark, extra=(), clash: bool = True):
    """Null and empty texts, null ids, sources and labels, a long text, ties, repeated rows, copies and near copies."""
    long_text = prose(1, 30_000)
    base = prose(2, 120)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "de", "b"), (4, base.replace(" ", "\n"), None, "b"), (4, base.replace(" ", "\n"), None, "b"),
        (5, None, "en", None), (6, "", "fr", "a"), (7, " \t\n", None, "c"), (8, long_text, "en", "a"), (9, "prefix " + long_text, "en", "a"),
        (10, "one two three", "en", "a"), (11, "One, two; three!", "en", "a"), (12, "!!! 12 ???", None, "c"), (None, base, "en", "a"), (13, "ÀÉ ßö 中文 Kelvin \U0001f600 x", "de", "a"),
    ] + [(100 + i, prose(50 + i, 40), "en" if i % 2 else "de", "a") for i in range(40)] + list(extra)
    names = NAMES if clash else []
    return spark.createDataFrame([(*r, *(["odd"] * len(names))) for r in rows], "doc_id bigint, text string, lang string, source string" + "".join(f", `{n}` string" for n in names)).repartition(5)


def empty(spark):
    return documents(spark).filter("false")


def lower_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(text: str | None) -> frozenset:
    w = lower_words(text)
    return frozenset(tuple(w[i : i + SHINGLE_WORDS]) for i in range(max(1, len(w) - SHINGLE_WORDS + 1))) if w else frozenset()


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def table(spark, name):
    import oracle

    return spark.read.parquet(f"{oracle.SF_DIR}/{name}.parquet")
