"""What the vector operators share: rows with usable vectors, scaled to whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(v: Column) -> Column:
    """A vector that is not null and holds neither nulls nor NaN nor infinities."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True))


def whole(
    vectors: DataFrame, scale: int, offset: int, limit: int, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, x): floor(scale * component) + offset of every finite vector, as longs.

    A product beyond ``limit`` would not be exact later on and fails the job instead.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(finite(F.col("v")))
    said = F.raise_error(F.lit(f"a component beyond {limit} / {scale} cannot be held exactly"))
    number = lambda x: F.when(F.abs(x * scale) > limit, said.cast("long")).otherwise(F.floor(x * scale) + F.lit(offset).cast("long"))
    return rows.select("vec_id", F.transform("v", number).alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an array<long> column, all of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
