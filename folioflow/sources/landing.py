"""Landing files: gzip or plain JSON, as an array, as lines, or as envelopes."""

from __future__ import annotations

import gzip
import io
import json
import math
import re
from collections.abc import Callable, Iterator
from functools import partial
from itertools import islice
from typing import BinaryIO, TextIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow import session
from folioflow.functions.timestamps import day_folder, rfc3339_exact
from folioflow.schemas import LANDED_RECORD
from folioflow.sources.stored_files import binary_files, contents, open_stored

# Kinds of failures and the landing filter.
BAD_JSON = "json_parsing"
BAD_RECORD = "data_conversion"
NO_VALID_PAPERS = "no valid papers found in data"
GZIP_SUFFIXES = (".gz", ".gzip")
LANDING_GLOB = "*.gz"
DAY_PREFIX = "collect_date="

RECORDS_PER_BATCH = 2_000
RECORDS_PER_FILE = 100_000
_SURROGATE = re.compile("[\ud800-\udfff]")
_FILE_COLUMNS = ("path", "modificationTime", "content")


def _reject(token: str):
    raise ValueError(f"not JSON: {token}")


def _number(text: str) -> float:
    value = float(text)
    if math.isinf(value):
        raise ValueError(f"number out of range: {text}")
    return value


def _integer(text: str):
    return int(text) if len(text) < 300 else _number(text)


def parse_strict(text: str):
    """One JSON value and nothing else; NaN and numbers out of range are errors."""
    return json.loads(text, parse_constant=_reject, parse_float=_number, parse_int=_integer)


def _dump(record: dict) -> str:
    text = json.dumps(record, ensure_ascii=False)
    if _SURROGATE.search(text):
        text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text


def _key(record: dict) -> str | None:
    """`paper_id`, else `id`; only a non-empty string is a key."""
    return next((v for v in (record.get("paper_id"), record.get("id")) if isinstance(v, str) and v), None)


def _checked(record) -> tuple[str | None, str | None, str | None]:
    """(key, record text, error) of one decoded element; null elements have no key either."""
    if not isinstance(record, dict):
        return None, None, BAD_RECORD
    try:
        key, text = _key(record), _dump(record)
    except RecursionError:
        return None, None, BAD_JSON
    return key, text, None if key is not None else BAD_RECORD


Found = Iterator[tuple[str | None, str | None, str | None]]


def _records_of_value(value) -> Found:
    """Records of one line's value: a paper, or the papers of an envelope."""
    if value is not None and not isinstance(value, dict):
        yield None, None, BAD_JSON
    elif value is not None and isinstance(value.get("papers"), list) and _key(value) is None:
        yield from map(_checked, value["papers"])
    else:
        yield _checked(value)


def records_of_line(line: str) -> Found:
    try:
        value = parse_strict(line)
    except (ValueError, RecursionError):
        return iter([(None, None, BAD_JSON)])
    return _records_of_value(value)


Opener = Callable[[], TextIO]
_SPACE = " \t\r\n"
_AFTER = tuple(_SPACE + ",]")


def _array_elements(text: TextIO, piece: int = 1 << 16) -> Iterator:
    """The elements of a JSON array that is all of `text`, one by one; anything else is a ValueError."""
    decoder = json.JSONDecoder(parse_constant=_reject, parse_float=_number, parse_int=_integer)
    buffer, at, ended = "", 0, False

    def more() -> None:
        nonlocal buffer, at, ended
        new = text.read(max(piece, len(buffer) - at))  # twice as much for an element that does not fit
        ended, buffer, at = not new, buffer[at:] + new, 0

    def blank() -> str:
        """The next character that is no space, or '' at the end."""
        nonlocal at
        while True:
            while at < len(buffer) and buffer[at] in _SPACE:
                at += 1
            if at < len(buffer) or ended:
                return buffer[at:at + 1]
            more()

    def expect(allowed: str) -> str:
        nonlocal at
        mark = blank()
        if not mark or mark not in allowed:
            raise ValueError(f"{mark!r} in an array")
        at += 1
        return mark

    expect("[")
    if blank() == "]":
        at += 1
    else:
        mark = ","
        while mark == ",":
            blank()
            while True:
                try:
                    value, end = decoder.raw_decode(buffer, at)
                    if ended or buffer[end:end + 1] in _AFTER:  # a number may go on in the next piece
                        break
                except ValueError:
                    if ended:
                        raise
                more()
            at = end
            yield value
            mark = expect(",]")
    if blank():
        raise ValueError("text after an array")


def _array_of_objects(open_text: Opener) -> bool:
    """True if the text is an array of objects (or nulls)."""
    try:
        return all(v is None or isinstance(v, dict) for v in _array_elements(open_text()))
    except (ValueError, RecursionError):
        return False


def _first_mark(open_text: Opener) -> str:
    """The first five characters that matter, enough to tell an array and `null`."""
    text, mark = open_text(), ""
    while len(mark) < 5 and (new := text.read(4096)):
        mark = (mark + new).lstrip(_SPACE)
    return mark[:5]


def records_of_file(open_text: Opener) -> Iterator[tuple[str | None, str | None, str | None, str | None]]:
    """(key, record, record error, file error) of a whole file, read as a stream.

    The shape decides, not the size. An array of objects (or nulls), or `null`, is taken as
    a whole and may be empty; it is read once to see that it is one, and again for its
    elements. Any other text is read line by line and has to give a paper, or an envelope
    without any.
    """
    mark = _first_mark(open_text)
    if mark.strip(_SPACE) == "null" and not open_text().read().strip(_SPACE)[4:]:
        return
    if mark.startswith("[") and _array_of_objects(open_text):
        for element in _array_elements(open_text()):
            yield *_checked(element), None
        return
    any_valid = False
    for line in open_text():
        line = line.rstrip("\n")
        if not line:
            continue
        count = 0
        for key, record, error in records_of_line(line):
            count += 1
            any_valid = any_valid or error is None
            yield key, record, error, None
        any_valid = any_valid or not count
    if not any_valid:
        yield None, None, None, NO_VALID_PAPERS


def records_of_text(text: str) -> Iterator[tuple[str | None, str | None, str | None, str | None]]:
    return records_of_file(lambda: io.StringIO(text, newline=None))


def _opener(path: str, stored: Callable[[], BinaryIO]) -> Opener:
    """A reader of the inflated text, made anew for each pass. A file that does not inflate raises here."""
    zipped = path.endswith(GZIP_SUFFIXES)

    def binary() -> BinaryIO:
        return gzip.GzipFile(fileobj=stored()) if zipped else stored()

    if zipped:
        body = binary()
        while body.read(1 << 20):
            pass
    return lambda: io.TextIOWrapper(binary(), "utf-8", "replace", newline=None)


def _batch(schema: T.StructType, constants: list, columns: list) -> pa.RecordBatch:
    """A batch of `schema` from leading one-value columns and lists for the others."""
    size = len(columns[0])
    leading = [pa.repeat(value, size) for value in constants]
    types = [pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in schema.fields[len(leading):]]
    arrays = leading + [pa.array(values, kind) for values, kind in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())


def _decode_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, changed, content in zip(*batch.columns):
            stored = partial(io.BytesIO, content.as_py()) if content.is_valid else partial(open_stored, path.as_py())
            try:
                found = records_of_file(_opener(path.as_py(), stored))
            except Exception as problem:  # one unreadable file must not stop the others
                found = iter([(None, None, None, f"{type(problem).__name__}: {problem}")])
            numbered = enumerate(found)
            while rows := [(0, number, 0, *row) for number, row in islice(numbered, RECORDS_PER_BATCH)]:
                yield _batch(LANDED_RECORD, [path, changed], list(zip(*rows)))


def decode_files(files: DataFrame) -> DataFrame:
    """Rows of `stored_files.contents` (batch or stream) to landed records; a file without content is read by its path."""
    return files.select(*_FILE_COLUMNS).mapInArrow(_decode_files, LANDED_RECORD)


def day_folders(spark: SparkSession, path: str, date_from: str | None = None, date_to: str | None = None) -> list[str]:
    """The folders of `write_landing` for a closed range of collection days, by their names; either side may be open."""
    days = (n.removeprefix(DAY_PREFIX) for n in session.list_names(spark, path) if n.startswith(DAY_PREFIX))
    return [f"{path}/{DAY_PREFIX}{d}" for d in sorted(days) if (date_from or "") <= d <= (date_to or "9999")]


def read_landing(
    spark: SparkSession, path: str | list[str], glob: str = LANDING_GLOB, date_from: str | None = None, date_to: str | None = None,
) -> DataFrame:
    """Records of all landing files under `path`, or of those of a range of collection days.

    Every element gives one row; a file that fails gives one row with its error. A task
    holds the file as it is stored, or a block of it if it is large, and of what is in it a
    line or an element at a time. With a range of days no other folder is listed.
    """
    if date_from is not None or date_to is not None:
        path = [f for p in ([path] if isinstance(path, str) else path) for f in day_folders(spark, p, date_from, date_to)]
        if not path:
            return spark.createDataFrame([], LANDED_RECORD)
    return decode_files(contents(binary_files(spark, path, glob)))


# Order of arrival: files by time and name, then the place within the file.
ARRIVAL = ("file_time", "file_path", "block_start", "record_no", "element_no")


def arrival_order():
    return F.struct(*ARRIVAL)


def file_message():
    """Error of a file as the batch result reports it."""
    problem = F.when(F.col("file_error") == NO_VALID_PAPERS, "failed to parse batch data from ").otherwise(
        "failed to download/decompress ")
    return F.concat(problem, F.col("file_path"), F.lit(": "), F.col("file_error"))


def write_landing(
    papers: DataFrame, path: str, collected_at: str = "collected_at", source: str = "source",
    max_records: int = RECORDS_PER_FILE,
) -> None:
    """Gzip JSON lines in one folder per collection day and source, in files of bounded size."""
    times = {f.name: rfc3339_exact(F.col(f.name)) for f in papers.schema if isinstance(f.dataType, T.TimestampType) and f.name != collected_at}
    (
        papers.withColumns({**times, "collect_date": day_folder(F.col(collected_at)), "collect_source": F.col(source)})
        .drop(collected_at)
        .write.partitionBy("collect_date", "collect_source").option("compression", "gzip")
        .option("maxRecordsPerFile", max_records).json(path)
    )


def upload_stats(papers: DataFrame, landed_path: str, by: str = "source") -> DataFrame:
    """Papers, original bytes, bytes of the landed files and their ratio, per source."""
    original = papers.groupBy(by).agg(
        F.count(F.lit(1)).alias("papers"),
        F.sum(F.octet_length(F.to_json(F.struct(*papers.columns))) + 1).alias("original_bytes"),
    )
    files = (
        papers.sparkSession.read.format("binaryFile").option("pathGlobFilter", LANDING_GLOB)
        .option("recursiveFileLookup", "true").load(landed_path)
        .select(F.regexp_extract("path", "collect_source=([^/]*)/", 1).alias(by), "length")
    )
    compressed = files.groupBy(by).agg(
        F.sum("length").alias("compressed_bytes"), F.count(F.lit(1)).alias("files")
    )
    return original.join(compressed, by, "left").withColumn(
        "compression_ratio", F.try_divide(F.col("compressed_bytes").cast("double"), F.col("original_bytes"))
    )


def write_if_absent(df: DataFrame, path: str) -> None:
    """Write unless the target exists already."""
    df.write.mode("ignore").parquet(path)
