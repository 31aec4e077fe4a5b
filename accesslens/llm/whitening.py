"""Whitened embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Rows are whole numbers x; the centred row is (n x - S) / n with the exact sums S.  Each step is one pass: tasks
multiply their centred rows with the right vector (Xv), take out the left vectors found so far, and multiply
back (X'u).  A left vector has one entry per row, always X times a short vector w, so the driver keeps w, and a
lost executor loses nothing.  Left vectors are reorthogonalised against all earlier ones by their
products, summed over all tasks; right vectors directly, twice.  Where the recurrence ends early it goes on with
a new vector orthogonal to all before, so equal deviations are found as often as they occur.

The singular vectors of the small bidiagonal matrix turn the right vectors into components,
its singular values into deviations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import long_array, stage, table
from accesslens.llm.vectors import matrix, whole

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Whole numbers up to here are exact as doubles.
LIMIT = 1 << 52
#: Bytes of rows in a block.
BLOCK_BYTES = 1 << 20
#: A deviation below this part of the largest one counts as none.
LEAST = 1e-10
SEED = 13

_BLOCKS = "ids array<long>, x binary"
_RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass
class Centre:
    """What centring needs: rows, exact sums by dimension, and whether longs hold all products."""

    n: int
    sums: np.ndarray  # of Python integers
    fits: bool
    squares_fit: bool

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n x - S as integers."""
        if self.fits:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum of the squares of n x - S of each row, exact."""
        d = self.exact(x)
        if self.squares_fit:
            return long_array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
        return pa.array([Decimal(int(sum(v * v for v in row.tolist()))) for row in d], pa.decimal128(38, 0))


@dataclass
class Fit:
    centre: Centre
    components: np.ndarray  # dimensions x components
    eigenvalues: np.ndarray
    trace: float


def blocks(rows: DataFrame, dims: int) -> DataFrame:
    """Rows of one length as blocks of bytes: later passes read only those."""
    size = max(1, BLOCK_BYTES // (8 * dims))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, size):
                some = b.slice(lo, size)
                x = np.ascontiguousarray(matrix(some.column(1), dims), dtype="<i8")
                yield pa.RecordBatch.from_arrays([pa.array([some.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()])], names=["ids", "x"])

    return rows.select("vec_id", "x").mapInArrow(run, _BLOCKS)


def _of(block: pa.Scalar, dims: int) -> np.ndarray:
    return np.frombuffer(block.as_py(), dtype="<i8").reshape(-1, dims)


def summed(table_: DataFrame, dims: int, size: int, add, kind: str = "double") -> np.ndarray:
    """``add(total, x)`` over all blocks of a task, added up over the tasks: ``size`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            for block in b.column(0):
                add(total, _of(block, dims))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["at", "total"])

    parts = table_.select("x").mapInArrow(run, f"at int, total {kind}")
    out = np.zeros(size)
    for r in parts.groupBy("at").agg(F.sum("total").alias("total")).collect():
        out[r["at"]] = r["total"]
    return out


def centre(rows: DataFrame, dims: int) -> Centre:
    """Exact sums by dimension, as decimals, from the rows of one length."""
    each = rows.select(F.posexplode("x").alias("at", "x"))
    found = each.groupBy("at").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n"), F.max(F.abs("x")).alias("most"), (F.max("x") - F.min("x")).alias("range"))
    found = sorted(found.collect(), key=lambda r: r["at"])  # one row a dimension
    n = found[0]["n"]
    sums = np.array([int(r["s"]) for r in found], dtype=object)
    most, spread = max(r["most"] for r in found), max(r["range"] for r in found)
    return Centre(n, sums, n * most < 1 << 62, n * most < 1 << 62 and dims * (n * spread) ** 2 < 1 << 63)


def _step(c: Centre, y: np.ndarray, w: np.ndarray):
    """Adds X'u, U'u and u'u for u = X y, where U = X w."""
    dims = len(y)

    def add(total: np.ndarray, x: np.ndarray) -> None:
        a = c.rows(x)
        u = a @ y
        total[:dims] += u @ a
        total[dims : dims + w.shape[1]] += u @ (a @ w)
        total[-1] += u @ u

    return add


def _orthogonal(r: np.ndarray, v: list[np.ndarray]) -> np.ndarray:
    for _ in range(2 if v else 0):
        basis = np.array(v)
        r = r - (basis @ r) @ basis
    return r


def bidiagonal(table_: DataFrame, c: Centre, dims: int, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """(V, B) with X V = U B, U and V orthonormal, B upper bidiagonal; as many steps as dimensions."""
    rng = np.random.default_rng(SEED)
    small = np.finfo(float).eps * norm * 8
    fresh = lambda: (lambda r: r / np.linalg.norm(r))(_orthogonal(rng.normal(size=dims), v))
    v: list[np.ndarray] = []
    v.append(fresh())
    w = np.zeros((dims, 0))
    back = np.zeros((dims, 0))  # X'u of every left vector
    b = np.zeros((dims, dims))
    beta = 0.0
    for k in range(dims):
        y = v[k] - beta * w[:, -1] if k else v[k]
        total = summed(table_, dims, 2 * dims + 1, _step(c, y, w))
        g, h, uu = total[:dims], total[dims : dims + k], total[-1]
        y, g = y - w @ h, g - back @ h  # the left vector without what earlier ones hold of it
        alpha = float(np.sqrt(max(uu - h @ h, 0.0)))
        if alpha <= small:
            alpha, y, g = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            y, g = y / alpha, g / alpha
        w, back = np.column_stack([w, y]), np.column_stack([back, g])
        b[k, k] = alpha
        if k + 1 == dims:
            break
        r = _orthogonal(g - alpha * v[k], v)
        beta = float(np.linalg.norm(r))
        if beta <= small:
            beta, r = 0.0, fresh()
        else:
            r = _orthogonal(r / beta, v)
            r = r / np.linalg.norm(r)
        b[k, k + 1] = beta
        v.append(r)
    return np.array(v).T, b


def fit(table_: DataFrame, c: Centre, dims: int, components: int = COMPONENTS) -> Fit:
    """Components by falling eigenvalue of the covariance, with divisor n; none for directions without spread."""

    def squares(total: np.ndarray, x: np.ndarray) -> None:
        a = c.rows(x)
        total[0] += (a * a).sum()

    square = float(summed(table_, dims, 1, squares)[0])
    if square <= 0:
        return Fit(c, np.zeros((dims, 0)), np.zeros(0), 0.0)
    v, b = bidiagonal(table_, c, dims, float(np.sqrt(square)))
    _, sigma, q = np.linalg.svd(b)
    keep = min(components, int((sigma > LEAST * sigma[0]).sum()))
    return Fit(c, v @ q.T[:, :keep], sigma[:keep] ** 2 / c.n, square / c.n)


def identity_error(table_: DataFrame, f: Fit, dims: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    k = len(f.eigenvalues)
    if not k:
        return 0.0
    turn = f.components / np.sqrt(f.eigenvalues)

    def add(total: np.ndarray, x: np.ndarray) -> None:
        z = f.centre.rows(x) @ turn
        total[: k * k] += (z.T @ z).reshape(-1)
        total[k * k :] += z.sum(axis=0)

    total = summed(table_, dims, k * k + k, add) / f.centre.n
    mean = total[k * k :]
    return float(np.abs(total[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def _projected(f: Fit, error: float, dims: int):
    k = len(f.eigenvalues)
    turn = f.components / np.sqrt(f.eigenvalues)
    explained = f.eigenvalues / f.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, block in zip(b.column(0), b.column(1)):
                x = _of(block, dims)
                m = len(x)
                rows = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(rows),
                        pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        long_array(np.full(m * k, f.centre.n)),
                        f.centre.deviations(x).take(rows),
                        pa.array((f.centre.rows(x) @ turn).reshape(-1)),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component.

    Vectors that are null or hold null or non-finite entries are dropped; the others become floor(scale * entry) +
    offset.  Vectors of different lengths have no common covariance: each length is a fit of its own.  Directions
    without spread make no component, so one vector, or equal ones, give no rows, and neither do an empty table and
    vectors without entries.  Repeated rows and ids count each time; a null id stays null.  An entry beyond
    LIMIT / scale fails the job.  Other columns are not read.
    """
    rows = stage(whole(vectors, scale, offset, LIMIT, id_col, vector_col), "whiten-rows")
    lengths = sorted(r["n"] for r in rows.groupBy(F.size("x").alias("n")).count().collect() if r["n"] > 0)
    out = []
    for dims in lengths:
        some = rows.where(F.size("x") == dims)
        packed = stage(blocks(some, dims), "whiten-blocks")
        f = fit(packed, centre(some, dims), dims, components)
        if len(f.eigenvalues):
            out.append(packed.mapInArrow(_projected(f, identity_error(packed, f, dims), dims), _RESULT))
    return reduce(DataFrame.unionByName, out) if out else vectors.sparkSession.createDataFrame([], _RESULT)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """Every vector on 32 components; the deviation as a long, beyond which the cast fails."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {"op13_whitening": op13_whitening}
#: Eigenvectors have no form in SQL.
ORACLE: dict[str, str] = {}
