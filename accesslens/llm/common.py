"""What the operators of this package share: tables, staging, text as byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.sources.staging import fresh_path

#: Text bytes a task function works on at a time.
CHUNK_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: lineage ends here and lost executors cost nothing.

    Zstandard takes no buffers outside the heap, which many small files would pile up.
    """
    path = fresh_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads; other columns cannot clash with its own."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def binary_values(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, limit: int = 4 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut to few rows and bytes, so that a task holds the Python copies of few texts at a time; a longer row comes alone."""
    for b in batches:
        lo = 0
        while lo < b.num_rows:
            n = min(rows, b.num_rows - lo)
            while n > 1 and b.slice(lo, n).nbytes > limit:
                n //= 2
            yield b.slice(lo, n)
            lo += n


def chunks(sizes: list[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row is a range of its own."""
    lo, held = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and held + n > limit:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def long_array(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64))
