"""Exact discrete median of large groups without gathering a group.

One node may hold a third of all rows, so a group is never sorted or collected
as a whole.  Equal values are counted first (map-side combined, spread by key
and value).  Then the bucket holding the middle row is found from bucket
counts, twice: by a coarse logarithmic bucket and by a fine one inside it.
Only the few distinct values of that last bucket are ordered per key.  Every
step is exact; no row is sampled or approximated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

COARSE = 64  # buckets per doubling
FINE = 4096  # parts of a coarse bucket


def _scaled(value: Column) -> Column:
    """Monotone position of a positive value; zero sorts below everything."""
    return F.when(value > 0, F.log2(value) * COARSE).otherwise(F.lit(-1e6))


def _running(keys: list[str], order: str) -> Column:
    w = (
        Window.partitionBy(*keys)
        .orderBy(F.col(order).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.sum("_n").over(w)


def _pick(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of ``counts`` that holds rank ``_rank`` (0-based, descending).

    ``_rank`` becomes the rank inside the picked row.
    """
    before = F.col("_run") - F.col("_n")
    return (
        counts.withColumn("_run", _running(keys, order))
        .filter((before <= F.col("_rank")) & (F.col("_rank") < F.col("_run")))
        .withColumn("_rank", F.col("_rank") - before)
        .drop("_run", "_n")
    )


def counted(df: DataFrame, keys: list[str], value: str, sums: list[str] | None = None) -> DataFrame:
    """Rows per (keys, value), plus optional sums carried along.

    The frame is used several times.  Its filters name all keys and sums, so each
    use asks for the same rows and columns and Spark reuses the shuffle behind it.
    """
    sums = sums or []
    pos = _scaled(F.col(value))
    for name in [*keys, value]:
        df = df.filter(F.col(name).isNotNull())
    rows = df.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(n).alias(n) for n in sums]
    )
    for name in sums:
        rows = rows.filter(F.col(name).isNotNull())
    # never null, so that no join adds a null test below the shuffle
    coarse = F.coalesce(F.floor(pos), F.lit(0).cast("bigint"))
    fine = F.coalesce(F.floor((pos - F.floor(pos)) * FINE), F.lit(0).cast("bigint"))
    return rows.withColumns({"_coarse": coarse, "_fine": fine})


def _middle(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Descending element ``n // 2`` per key, from ``counted`` rows."""
    coarse = values.groupBy(*keys, "_coarse").agg(F.sum("_n").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    in_coarse = _pick(coarse.withColumn("_rank", F.floor(total / 2)), keys, "_coarse")

    fine = values.join(in_coarse, [*keys, "_coarse"]).groupBy(*keys, "_rank", "_coarse", "_fine")
    in_fine = _pick(fine.agg(F.sum("_n").alias("_n")), keys, "_fine")

    last = values.select(*keys, "_coarse", "_fine", value, "_n").join(in_fine, [*keys, "_coarse", "_fine"])
    return _pick(last, keys, value).select(*keys, value)


def discrete_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Lower median of ``value`` per key (descending order, element n // 2)."""
    return _middle(counted(df, keys, value), keys, value)


def sums_and_median(
    df: DataFrame, keys: list[str], value: str, sums: list[str]
) -> DataFrame:
    """Sums and median of the same groups from one scan and one big shuffle.

    The columns in ``sums`` are added up per distinct value first and per key
    afterwards.
    """
    values = counted(df, keys, value, sums)
    totals = values.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in sums], F.sum("_n").alias("count")
    )
    return totals.join(_middle(values, keys, value), keys)


def median_by_rank(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Same median by rank in one step less: the coarse bucket that holds the rank, then its values in order.

    For groups whose values spread over many doublings; no window sees more than a bucket's values.
    """
    values = counted(df, keys, value)
    coarse = values.groupBy(*keys, "_coarse").agg(F.sum("_n").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    at = _pick(coarse.withColumn("_rank", F.floor(total / 2)), keys, "_coarse")
    inside = values.select(*keys, "_coarse", value, "_n").join(at, [*keys, "_coarse"])
    return _pick(inside, keys, value).select(*keys, value)
