"""Where written tables and checkpoints of a job live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only where none is named.

    A local folder is good for ``local[*]`` alone, so without a named folder any
    other master is refused.
    """
    global _local_root
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="run-accesslens-")
    return _local_root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody used before."""
    return f"{shared_root(spark)}/accesslens/{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write a table to a fresh path and return the path.

    Partitioned tables are rebalanced first: few large files per value.
    """
    path = fresh_path(df.sparkSession, name)
    if partition_by:
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return path


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and holds anything, in whatever store the path names."""
    store, folder = _store(spark, path)
    return store.exists(folder) and any(not s.getPath().getName().startswith("_") for s in store.listStatus(folder))


def _store(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def file_marks(spark: SparkSession, files: list[str]) -> list[tuple[str, int, int]]:
    """(file, length, time of its last change), in order; one listing for each folder."""
    wanted, marks = set(files), []
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        store, path = _store(spark, folder)
        for s in store.listStatus(path):
            name = s.getPath().toUri().toString()
            if name in wanted or f"{folder}/{s.getPath().getName()}" in wanted:
                marks.append((name, s.getLen(), s.getModificationTime()))
    return sorted(marks)


def folder_marks(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, length, time of its last change) of a file, or of the files of a folder."""
    store, at = _store(spark, path)
    return sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in store.listStatus(at))


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _store(spark, path)
    return store.exists(at)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file; None where there is none."""
    store, file = _store(spark, path)
    if not store.exists(file):
        return None
    stream = store.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it there: readers see the old one or the new one, whole."""
    store, file = _store(spark, path)
    _, part = _store(spark, f"{path}.{uuid.uuid4().hex}")
    stream = store.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not store.rename(part, file):  # stores that do not replace on a rename
        store.delete(file, False)
        store.rename(part, file)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder of this package's own; nothing happens where there is none."""
    store, at = _store(spark, path)
    store.delete(at, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it is missing."""
    store, at = _store(spark, path)
    if not store.exists(at):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(at) if s.isDirectory())
