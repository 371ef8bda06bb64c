"""Time functions; the session time zone has to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of feed dates and of rendered times.
FEED_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]'Z'"
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DAY_FOLDER = "yyyy-MM-dd"
FILE_STAMP = "yyyyMMdd-HHmmss"


def feed_timestamp(text: Column) -> Column:
    """Strict UTC timestamp, null when the text has any other form."""
    return F.try_to_timestamp(text, F.lit(FEED_TIMESTAMP))


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, RFC3339)


def day_folder(ts: Column) -> Column:
    return F.date_format(ts, DAY_FOLDER)


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, FILE_STAMP)


def landing_key(prefix: str, source: Column, ts: Column) -> Column:
    """`prefix/day/source-papers-stamp.gz`, the name of a landing file."""
    return F.concat(
        F.lit(f"{prefix}/"), day_folder(ts), F.lit("/"), source, F.lit("-papers-"), file_stamp(ts), F.lit(".gz")
    )


def lenient_day(text: Column) -> Column:
    """A `YYYY-MM-DD` day, or null for a bound that is to be ignored."""
    day = F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), day)


def rfc3339_exact(ts: Column) -> Column:
    """UTC with the digits of the fraction that are there, none for a whole second."""
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.regexp_replace(F.date_format(ts, ".SSSSSS"), r"\.?0+$", ""), F.lit("Z"))
