"""Atom feed scan."""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from typing import BinaryIO
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.schemas import FEED_ENTRY
from folioflow.sources.stored_files import binary_files, contents, open_stored


def _problem(stored: BinaryIO) -> str | None:
    """What is wrong with a file, read as a stream."""
    try:
        expat.ParserCreate().ParseFile(stored)
    except (expat.ExpatError, OSError) as problem:
        return f"failed to parse XML response: {problem}"
    return None


def _errors(problems: Iterable[tuple[str, str | None]]) -> pa.RecordBatch:
    bad = [(path, problem) for path, problem in problems if problem]
    return pa.RecordBatch.from_arrays([pa.array([b[i] for b in bad], pa.string()) for i in (0, 1)], ["file_path", "file_error"])


def _check_files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        problems = [(name.as_py(), _problem(io.BytesIO(content.as_py()) if content.is_valid else open_stored(path.as_py())))
                    for name, path, content in zip(*batch.columns, strict=True)]
        yield _errors(problems)


def feed_errors(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file_path, file_error: the files that are not well-formed. Such a feed is refused as a whole. Each is parsed as a stream."""
    files = contents(binary_files(spark, path).withColumn("file_path", F.col("_metadata.file_path")))
    return files.select("file_path", "path", "content").mapInArrow(_check_files, "file_path string, file_error string")


def read_feed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Entries of landed feed files; large files are split at entries by the XML source.

    Files that are not well-formed give no entries here; `feed_errors` names them.
    """
    entries = (
        spark.read.schema(FEED_ENTRY).option("rowTag", "entry").option("ignoreSurroundingSpaces", "false").xml(path)
        .withColumn("_file", F.col("_metadata.file_path"))
    )
    refused = feed_errors(spark, path).select(F.col("file_path").alias("_file"))
    return entries.join(refused, "_file", "left_anti").select(*FEED_ENTRY.fieldNames())
