"""Stored files whose bytes an operator reads itself: as a value up to a limit, as a stream beyond it."""

from __future__ import annotations

from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Greatest length of a file that the binary file source gives as a value; it raises for longer ones.
LIMIT_SETTING = "spark.sql.sources.binaryFile.maxLength"
READ_BYTES = 4 << 20


def binary_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(LIMIT_SETTING))


def binary_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """path, modificationTime, length and content of files; content is read where it is used, and only of the rows that are left."""
    reader = spark.read.format("binaryFile")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.load(path)


def contents(files: DataFrame) -> DataFrame:
    """The files of a scan (batch or stream) with their content, which is null where a file is above the limit of a value.

    The filters are on the length, which the scan knows before it reads a file, so large
    ones are not loaded; `open_stored` reads them. A large file is a task of its own.
    """
    limit = binary_limit(files.sparkSession)
    large = files.where(F.col("length") > limit).withColumn("content", F.lit(None).cast("binary"))
    return files.where(F.col("length") <= limit).unionByName(large)


def open_stored(path: str) -> BinaryIO:
    """A stream over a stored file, in a Python worker: local and shared folders, HDFS, and the object stores that Arrow knows."""
    if path.startswith("file:"):
        system, name = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        system, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return pa.BufferedInputStream(system.open_input_stream(name, compression=None), READ_BYTES)
