"""Clusters of vectors around integer centroids, found by the threshold algorithm.

Each dimension holds the centroids in the order of their values.  A vector walks every
list outward from its own value, the nearer side first.  A centroid met on the way is
measured exactly.  One that no list has met yet is at least as far in each dimension as that list's
frontier, so the walk stops when the squared frontiers add up to strictly more than the best
distance: equal distances are still met, and go to the smaller number.

Vectors never move: a task assigns its rows and hands on sums and counts per centroid and
dimension.  The driver holds the centroids alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import long_array, stage, table
from accesslens.llm.vectors import matrix, whole

CENTROIDS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64
SEED = "1"
#: Rows walked at a time.
BLOCK = 1024
#: Largest whole number of a component: squared differences of 64 of them add up within a long.
LIMIT = 1 << 27

_FAR = np.iinfo(np.int64).max


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each row; ties go to the smaller number."""
    k, dims = centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    values = np.take_along_axis(centroids, order, axis=0)
    at = np.arange(dims)
    distance = np.full((len(x), k), _FAR)
    best = np.full(len(x), _FAR)
    right = np.stack([np.searchsorted(values[:, d], x[:, d]) for d in at], axis=1)
    left = right - 1
    rows = np.arange(len(x))  # rows whose walk goes on
    while len(rows):
        here = x[rows]
        below = np.where(left >= 0, here - values[np.maximum(left, 0), at], _FAR)
        above = np.where(right < k, values[np.minimum(right, k - 1), at] - here, _FAR)
        down = below <= above
        frontier = np.where(down, below, above)
        met = order[np.where(down, left, right), at]
        new = np.zeros((len(rows), k), dtype=bool)
        np.put_along_axis(new, met, True, axis=1)
        new &= distance[rows] == _FAR
        r, c = np.nonzero(new)
        gap = here[r] - centroids[c]
        distance[rows[r], c] = (gap * gap).sum(axis=1)
        best[rows] = distance[rows].min(axis=1)
        left, right = left - down, right + ~down
        on = ((frontier * frontier).sum(axis=1) <= best[rows]) & (distance[rows] == _FAR).any(axis=1)
        rows, left, right = rows[on], left[on], right[on]
    return distance.argmin(axis=1), best


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors whose id has the smallest hash; null ids come last, ties are settled by value."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    picked = rows.orderBy(key.asc_nulls_last(), "x").limit(k).select("x").collect()
    return np.array([r["x"] for r in picked], dtype=np.int64)


def _sums(centroids: np.ndarray):
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), dtype=np.int64)  # counts in the last column
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                x = matrix(b.column(0).slice(lo, BLOCK), dims)
                number, _ = nearest(x, centroids)
                np.add.at(total, number, np.column_stack([x, np.ones(len(x), dtype=np.int64)]))
        c, d = np.nonzero(np.broadcast_to(total[:, -1:] > 0, total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(d, pa.int32()), long_array(total[c, d])], names=["cluster", "dim", "total"])

    return run


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: floors of the exact means of their vectors; those without any stay."""
    k, dims = centroids.shape
    parts = rows.select("x").mapInArrow(_sums(centroids), "cluster int, dim int, total long")
    totals = np.zeros((k, dims + 1), dtype=np.int64)
    for r in parts.groupBy("cluster", "dim").agg(F.sum("total").alias("total")).collect():  # k x (dims + 1) numbers
        totals[r["cluster"], r["dim"]] = r["total"]
    count = totals[:, -1:]
    return np.where(count > 0, totals[:, :-1] // np.maximum(count, 1), centroids)


def fit(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> np.ndarray:
    """Centroids of (vec_id, x) rows of one length; fewer than k if there are fewer rows."""
    centroids = first_centroids(rows, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids)
    return centroids


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                some = b.slice(lo, BLOCK)
                number, distance = nearest(matrix(some.column(1), centroids.shape[1]), centroids)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(number, pa.int32()), long_array(distance)], names=["vec_id", "cluster", "distance"])

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: str = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Kept are vectors of ``dims`` components, none null or non-finite, as floor(scale * component).  Repeated rows
    and ids count each time; a row with a null id is a vector like any other, but a first centroid only
    when ids run out.  Fewer vectors than k make fewer centroids.  A component beyond LIMIT / scale fails
    the job, as distances would not fit a long.  An empty table gives no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = stage(whole(vectors, scale, 0, LIMIT, id_col, vector_col).where(F.size("x") == dims), "cluster-rows")
    centroids = fit(rows, k, rounds, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    found = stage(assign(rows, centroids), "cluster-assigned")
    held = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    totals = [(c, d, sum(held.values()), digests[c]) for c, d in held.items()]
    totals = spark.createDataFrame(totals, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(totals), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    """Every vector of 64 components, after three rounds from 16 hashed starts."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    far = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    steps = [
        f"""kept AS (SELECT vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::double)::bigint) AS x,
  row_number() OVER () AS row FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x AS c FROM (
  SELECT sha256('{SEED}:' || vec_id) AS h, x FROM kept ORDER BY 1 NULLS LAST, 2 LIMIT {CENTROIDS}))""",
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS (SELECT row, vec_id, x, cluster, d FROM (SELECT row, vec_id, x, cluster, {far} AS d FROM kept, c{i})
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, cluster) = 1)""")
        if i < ROUNDS:
            steps.append(f"""m{i} AS (SELECT cluster, list(m ORDER BY i) AS m FROM (
  SELECT cluster, i, floor(sum(x[i])::double / count(*))::bigint AS m FROM a{i}, (SELECT unnest(range(1, {DIMS + 1})) AS i) GROUP BY 1, 2) GROUP BY 1),
c{i + 1} AS (SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, cluster::int AS cluster, d AS distance, sum(d) OVER (PARTITION BY cluster)::bigint AS cluster_inertia,
  sum(d) OVER ()::bigint AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{ROUNDS} JOIN c{ROUNDS} USING (cluster)"""


QUERIES = {"op12_centroid_clusters": op12_centroid_clusters}
ORACLE = {"op12_centroid_clusters": _oracle()}
