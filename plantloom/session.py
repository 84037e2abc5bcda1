"""Where jobs may put intermediate tables, and small files of shared storage."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Spark's switch to delete a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# By session: how many blocks of ``shuffles_dropped`` are open, and the switch before the first.
_open: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()
_opening = threading.Lock()


def shared_root(checkpoint: str | None, warehouse: str, master: str) -> str:
    """Storage that the driver and all executors share.

    That is ``spark.checkpoint.dir`` where the session names one, else the
    session's warehouse; a warehouse on a machine's own disk is shared by nobody
    unless everything runs there.
    """
    if checkpoint:
        return checkpoint.rstrip("/")
    if urlparse(warehouse).scheme in ("", "file") and not master.startswith("local"):
        raise RuntimeError(f"{warehouse} is a folder of this machine: set spark.checkpoint.dir "
                           "to storage that all executors share")
    return warehouse.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in shared storage, gone when the application's JVM ends.

    All of an application's scratch folders lie in one, which Hadoop's file
    system removes when it is closed. ``scratch`` and ``remove`` are for what can
    go earlier.
    """
    root = shared_root(spark.conf.get("spark.checkpoint.dir", None),
                       spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)
    own = f"{root}/plantloom-{spark.sparkContext.applicationId}"
    files, path = storage(spark, own)
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{own}/{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder for the length of a block."""
    folder = scratch_folder(spark)
    try:
        yield folder
    finally:
        remove(spark, folder)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries begun in the block delete their shuffle files when they end.

    Else these stay until the driver happens to collect its garbage, which in a
    run of several large queries adds up. Blocks may overlap, in threads too.
    """
    with _opening:
        blocks, before = _open.get(spark, (0, None))
        if not blocks:
            before = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _open[spark] = blocks + 1, before
    try:
        yield
    finally:
        with _opening:
            blocks, before = _open[spark]
            _open[spark] = blocks - 1, before
            if blocks == 1:
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once to shared storage and read back.

    Cuts the lineage: a lost executor costs its running tasks, not the plan
    above, and every later use reads the same rows.
    """
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# ---- files -------------------------------------------------------------------------------------

def storage(spark: SparkSession, path: str):
    """The file system a path lies in, and the path as it wants it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def remove(spark: SparkSession, path: str) -> None:
    files, found = storage(spark, path)
    files.delete(found, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it does not exist."""
    files, found = storage(spark, path)
    if not files.exists(found):
        return []
    return [s.getPath().getName() for s in files.listStatus(found)]


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    files, found = storage(spark, path)
    if not files.exists(found):
        return None
    stream = files.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_small(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place of an older one, whole or not at all."""
    files, found = storage(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
    stream = files.create(fresh)
    stream.write(bytearray(text.encode()))
    stream.close()
    kinds = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(fresh), context.makeQualified(found), how)


def stamps(spark: SparkSession, paths: Iterator[str]) -> list[str]:
    """Name, size and time of change of every file that the paths (files, folders, globs) name."""
    out = []
    for path in paths:
        files, found = storage(spark, path)
        for status in files.globStatus(found) or []:
            inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
            out += [f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in inside]
    return sorted(out)
