"""Text functions. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The separators that the embedding side strips as well.
INFORMATION_SEPARATORS = "\x1c\x1d\x1e\x1f"

MAX_TEXT_BYTES = 10_000
MAX_TEXT_CHARS = 8_192


def unicode_trim(text: Column) -> Column:
    """Strip White_Space characters from both ends (plain `trim` strips U+0020 only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def strip_for_encoder(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE + INFORMATION_SEPARATORS))


def last_path_segment(url: Column) -> Column:
    """Text after the last `/`; the version suffix stays, a trailing `/` gives ''."""
    return F.substring_index(url, "/", -1)


def combine_title_abstract(title: Column, abstract: Column) -> Column:
    """`title. abstract`; a part counts as present by its text before trimming."""
    return F.concat_ws(
        ". ",
        F.when(title != "", unicode_trim(title)),
        F.when(abstract != "", unicode_trim(abstract)),
    )


def truncate_bytes(text: Column, max_bytes: int = MAX_TEXT_BYTES) -> Column:
    """First `max_bytes` bytes; a character cut at the end becomes one U+FFFD."""
    cut = F.make_valid_utf8(F.substring(F.encode(text, "utf-8"), 1, max_bytes).cast("string"))
    return F.when(F.octet_length(text) > max_bytes, cut).otherwise(text)


def encoder_input(text: Column, max_bytes: int = MAX_TEXT_BYTES, max_chars: int = MAX_TEXT_CHARS) -> Column:
    """Bytes, then strip, then characters. The token limit is the encoder's own."""
    return F.substring(strip_for_encoder(truncate_bytes(text, max_bytes)), 1, max_chars)


def stage_error(stage: Column, message: Column, cause: Column) -> Column:
    """`stage: message`, and the cause in brackets when there is one."""
    tail = F.when(cause.isNull(), F.lit("")).otherwise(F.concat(F.lit(" (caused by: "), cause, F.lit(")")))
    return F.concat(stage, F.lit(": "), message, tail)
