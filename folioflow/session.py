"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

import folioflow

# Timestamps of the data are UTC, so the session has to be UTC as well.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A worker holds a batch, what it makes of it, and one of its files or texts beyond that.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(folioflow.__file__)
    archive = os.path.join(tempfile.mkdtemp(prefix="folioflow-"), "folioflow.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("folioflow", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on, and ship the package.

    On a cluster the first number of shuffle partitions follows the cores, unless it is
    set: adaptive execution joins small partitions, but it never cuts large ones that
    are not skewed.
    """
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not context.master.startswith("local") and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * context.defaultParallelism)
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    ship_package(spark)
    return spark


def build_session(app_name: str = "folioflow", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; `conf` keys use `__` for `.` (spark__driver__memory="8g")."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_base(spark: SparkSession) -> str:
    """The shared folder for scratch tables.

    The cluster names it in `spark.checkpoint.dir`. Only a local session may do without it;
    there the driver and the executors share one file system.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="folioflow-")
    return base.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder that every executor can reach."""
    path = f"{scratch_base(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end all scratch folders that were named in the block.

    For work whose result has been written elsewhere by then: operators leave the tables
    that their lazy result still has to be read from.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def _place(spark: SparkSession, path: str):
    """A path and its file system, the one that Spark reads and writes it with."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, through the file system that Spark wrote it with."""
    system, target = _place(spark, path)
    system.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _place(spark, path)
    return system.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    system, target = _place(spark, path)
    return [f.getPath().getName() for f in system.listStatus(target)] if system.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    system, target = _place(spark, path)
    stream = system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must not be there yet. It is written beside its place and put there in one step."""
    system, target = _place(spark, path)
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.new")
    stream = system.create(beside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if system.exists(target) or not system.rename(beside, target):
        system.delete(beside, False)
        raise FileExistsError(path)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`df` as written to the shared folder, which is deleted again at the end of the block."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove(df.sparkSession, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where a costly Python stage feeds several branches. Unlike a cache the files
    survive the loss of executors, and lineage before them is cut.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
