import math

import numpy as np
import pytest

from accesslens.llm import whitening
from accesslens.llm.whitening import op13_whitening, whiten

SMALL = "/root/testdata/sf0.001"


def compare(got, rows, components=32):
    """Against eigenvectors of the covariance itself."""
    ids = [i for i, _ in rows]
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    exact = [[n * c - s for c, s in zip(r, sums)] for r in x]
    a = np.array(exact, dtype=np.float64) / n
    e, q = np.linalg.eigh(a.T @ a / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    z = a @ q[:, :k] / np.sqrt(e[:k])
    assert len(got) == n * k
    at = {i: r for r, i in enumerate(ids)}
    w = np.zeros((n, k))
    for r in got:
        assert r["n"] == n and r["deviation"] == sum(c * c for c in exact[at[r["vec_id"]]])
        assert math.isclose(r["explained"], e[r["component"] - 1] / e.sum(), rel_tol=1e-7)
        w[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    assert len({r["identity_error"] for r in got}) == 1
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-6 and got[0]["identity_error"] < 1e-6
    return w, z, e


def test_query_equals_eigenvectors_of_the_covariance(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    w, z, _ = compare(op13_whitening(spark, SMALL).collect(), rows)
    sign = np.sign((w * z).sum(axis=0))
    assert np.abs(w * sign - z).max() < 1e-8


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "vec_id long, embedding array<double>").repartition(3)


def test_unlike_scales_and_missing_directions(spark):
    rng = np.random.default_rng(3)
    base = np.floor(rng.normal(size=(120, 5)) * [1e4, 100, 10, 3, 1] * 64) / 64
    v = np.column_stack([base, base[:, 0] + base[:, 1], np.ones(120)])
    rows = list(enumerate(v))
    w, z, _ = compare(whiten(frame(spark, rows)).collect(), rows)
    assert w.shape[1] == 5
    sign = np.sign((w * z).sum(axis=0))
    assert np.abs(w * sign - z).max() < 1e-5


def test_equal_deviations_are_all_found(spark):
    """Corners of a cross: the covariance is a multiple of the identity."""
    rows = [(2 * i + s, [(1 - 2 * s) * float(i == j) for j in range(6)]) for i in range(6) for s in (0, 1)]
    w, _, e = compare(whiten(frame(spark, rows)).collect(), rows)
    assert w.shape[1] == 6 and np.allclose(e, e[0])


def test_fewer_components(spark):
    rng = np.random.default_rng(4)
    rows = list(enumerate(rng.normal(size=(50, 8))))
    assert compare(whiten(frame(spark, rows), components=3).collect(), rows, 3)[0].shape[1] == 3


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (2, [0.5, 0.25]), (3, None), (4, []), (5, [1.0, None]), (6, [float("nan"), 1.0]),
        (7, [float("-inf"), 1.0]), (8, [1.0, 2.0, 3.0]), (9, [2.0, 2.0, 3.0]),
    ]
    kind = "vec_id long, embedding array<double>, n int, x int, ids int, whitened int, component int"
    df = spark.createDataFrame([r + (1, 2, 3, 4, 5) for r in rows], kind)
    got = whiten(df).collect()
    two = [r for r in got if r["n"] == 4]
    assert len(two) == 4 * 2 and sum(r["vec_id"] is None for r in two) == 2
    three = [r for r in got if r["n"] == 2]  # two points have one direction
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 9)) for r in three) == [(8, 1, 1.0), (9, 1, 1.0)]
    assert whiten(df.where("false")).count() == 0
    assert whiten(df.where("vec_id = 1")).count() == 0
    with pytest.raises(Exception, match="cannot be held exactly"):
        whiten(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")).collect()


def test_products_beyond_a_long_stay_exact():
    c = whitening.Centre(1 << 40, np.array([5, 7], dtype=object), False, False)
    x = np.array([[3_000_000, 1]])
    want = sum(((1 << 40) * a - s) ** 2 for a, s in zip([3_000_000, 1], [5, 7]))
    assert c.deviations(x).to_pylist() == [want]
    narrow = whitening.Centre(4, np.array([5, 7], dtype=object), True, True)
    assert narrow.deviations(np.array([[3, 1]])).to_pylist() == [7 * 7 + 3 * 3]
