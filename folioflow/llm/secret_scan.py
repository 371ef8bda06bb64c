"""Secret scan: an Aho-Corasick pass finds keywords, regular expressions are tried at their places only.

The three base kinds need no checksum. The kinds that the method adds are reported only
if what is built into them holds: the CRC-32 at the end of GitHub and npm tokens, or the
JSON header of a web token.

Cases: a null text counts as empty and has no spans. Positions are code points, ends are
exclusive. Texts of any length are scanned whole. Repeated rows give repeated rows.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds, and the least length of what has to be long.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16
# Fixed formats of tokens with a checksum: prefix, 30 characters, six characters of CRC-32 in base 62.
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]++)\.(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]+")

KINDS = ["assign", "access", "hex", "checked", "jwt"]
# Keyword in lower case, and the kind whose pattern starts with it.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access",
    "ghp_": "checked", "gho_": "checked", "ghu_": "checked", "ghs_": "checked", "ghr_": "checked", "npm_": "checked",
    "eyj": "jwt",
}
# Where a pattern fails, it fails at every later place of such a run: what follows the run decides.
FAILS_IN = {"jwt": re.compile(r"eyJ[A-Za-z0-9_-]*+")}
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "checked": CHECKED, "jwt": JWT}


def base62_crc(body: str) -> str:
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out


def json_header(part: str) -> bool:
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, TypeError):
        return False


VALID = {
    "assign": lambda m: len(m[2]) >= ASSIGN_CHARS,
    "access": lambda m: len(m[0]) >= ACCESS_CHARS,
    "checked": lambda m: base62_crc(m[1]) == m[2],
    "jwt": lambda m: json_header(m[1]),
}


def keyword_automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def ascii_lower(text: str) -> str:
    """Only A-Z change, so every code point keeps its place."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted. Per kind leftmost and without overlap: a match that fails its test is used up too."""
    spans, free = [], dict.fromkeys(KINDS, 0)
    for last, (kind, length) in automaton.iter(ascii_lower(text)):
        start = last + 1 - length
        if start < free[kind]:
            continue
        if m := PATTERNS[kind].match(text, start):
            free[kind] = m.end()
            if VALID[kind](m):
                spans.append((start, KINDS.index(kind), m.end()))
        elif kind in FAILS_IN and (run := FAILS_IN[kind].match(text, start)):
            free[kind] = run.end()
    spans += [(m.start(), KINDS.index("hex"), m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = keyword_automaton()
    for batch in batches:
        rows = []
        for text in batch.column(1):
            spans = find_spans(text.as_py() or "", automaton)
            rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and spans (kind, start, end) by start, then by kind as listed."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_scan, f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def secret_digest(spans: DataFrame) -> DataFrame:
    """Counts and joined spans of `secret_spans`."""
    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return spans.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
