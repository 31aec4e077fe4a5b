import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from accesslens.llm import centroids
from accesslens.llm.centroids import assign, cluster, nearest, op12_centroid_clusters

SMALL = "/root/testdata/sf0.001"


def brute(rows, k, rounds, dims, scale=64, seed="1"):
    """Everything in plain integers."""
    kept = [(i, [math.floor(scale * float(c)) for c in v]) for i, v in rows if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    hashed = sorted((i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "", x) for i, x in kept)
    c = [x for *_, x in hashed[:k]]

    def best(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c))

    for _ in range(rounds):
        of = [best(x)[1] for _, x in kept]
        for j in range(len(c)):
            own = [x for (_, x), o in zip(kept, of) if o == j]
            if own:
                c[j] = [sum(col) // len(own) for col in zip(*own)]
    found = [(i, *best(x)[::-1]) for i, x in kept]
    total = {j: sum(d for _, o, d in found if o == j) for j in range(len(c))}
    digest = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted(((i, j, d, total[j], sum(total.values()), digest[j]) for i, j, d in found), key=str)


def test_query_equals_brute_force_and_sql(spark):
    got = sorted(map(tuple, op12_centroid_clusters(spark, SMALL).collect()))
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert got == sorted(brute(rows, 16, 3, 64))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    assert got == sorted(con.execute(centroids.ORACLE["op12_centroid_clusters"]).fetchall())


ODD = [
    (1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (None, [-1.0, 3.0]), (3, None), (4, []), (5, [1.0]), (6, [1.0, None]),
    (7, [float("nan"), 0.0]), (8, [float("inf"), 0.0]), (9, [-0.001, 0.0]), (10, [0.0, 0.0]), (11, [100.0, -100.0]), (12, [100.0, -100.0]),
]


@pytest.mark.parametrize("k", [1, 3, 16])
def test_odd_rows(spark, k):
    clashing = "vec_id long, embedding array<double>, cluster int, x int, distance long, total int"
    df = spark.createDataFrame([r + (7, 8, 9, 10) for r in ODD], clashing)
    got = sorted(map(tuple, cluster(df, k, 3, 2).collect()), key=str)
    assert got == brute(ODD, k, 3, 2)
    assert len(got) == 8
    assert cluster(df.where("false"), k, 3, 2).count() == 0


def test_a_component_too_large_for_exact_distances_fails(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="cannot be held exactly"):
        cluster(df, 1, 1, 2).collect()


@given(st.integers(1, 12), st.integers(1, 6), st.integers(0, 2**32 - 1), st.integers(1, 30))
@settings(max_examples=150, deadline=None)
def test_walks_find_the_nearest_and_the_smallest_number(k, dims, seed, reach):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-reach, reach + 1, (40, dims)), rng.integers(-reach, reach + 1, (k, dims))
    far = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    number, distance = nearest(x, c)
    assert (number == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_walks_stop_early_on_spread_centroids(monkeypatch):
    """Of 500 centroids far apart only a few are measured."""
    rng = np.random.default_rng(1)
    c = rng.integers(-(10**6), 10**6, (500, 2))
    measured = []
    real = np.nonzero
    monkeypatch.setattr(centroids.np, "nonzero", lambda m: measured.append(int(m.sum())) or real(m))
    nearest(c[:50] + 1, c)
    assert sum(measured) < 50 * 25


def test_assign_alone(spark):
    rows = spark.createDataFrame([(1, [0, 0]), (2, [9, 9])], "vec_id long, x array<long>")
    assert sorted(map(tuple, assign(rows, np.array([[9, 8], [0, 1]])).collect())) == [(1, 1, 1), (2, 0, 1)]
