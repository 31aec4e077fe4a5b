import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from accesslens.llm import multi_index_ann as op


def brute(rows, every, k=op.NEIGHBOURS):
    rows = sorted(set(rows))
    x = np.array([v for _, v in rows])
    out = {}
    for i, v in rows:
        if i % every == 0:
            p = x @ np.array(v)
            out[i] = sorted((-s, j) for s, (j, _) in zip(p.tolist(), rows) if j != i)[:k]
    return out


def check(found, want, recall):
    """Whole lists with exact scores, and the share of the true neighbours found."""
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append(r)
    assert got.keys() == {q for q, x in want.items() if x}
    hits = all_ = 0
    for q, rows in got.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(want[q]) + 1))
        assert len({r["vec_id"] for r in rows}) == len(rows) and q not in {r["vec_id"] for r in rows}
        pairs = [(-r["score"], r["vec_id"]) for r in rows]
        assert all(a[0] <= b[0] + 1e-12 for a, b in zip(pairs, pairs[1:]))
        hits += len({r["vec_id"] for r in rows} & {j for _, j in want[q]})
        all_ += len(want[q])
    assert hits >= recall * all_
    return hits / max(all_, 1)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall(spark, sf):
    rows = [(r["vec_id"], tuple(r["embedding"])) for r in pq.read_table(f"/root/testdata/{sf}/embeddings.parquet").to_pylist()]
    found = op.op8_multi_index_ann(spark, f"/root/testdata/{sf}").collect()
    want = brute(rows, 20)
    print(sf, check(found, want, 0.9))
    vector = dict(rows)
    assert all(abs(r["score"] - math.sumprod(vector[r["query_id"]], vector[r["vec_id"]])) < 1e-12 for r in found)


def test_every_code_within_the_radius_is_probed():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)) * rng.uniform(0.5, 2, (400, 1))
    model = op.learn(x, float(np.linalg.norm(x, axis=1).max()), 400)
    shard = op.Shard(model, x, [np.array([i]) for i in range(400)])
    codes = model.query_codes(x[:40])
    for radius in (10, 40, 90, 120):
        model.radius = radius
        assert not ((op.distances(codes, shard.codes) <= radius) & ~shard.probed(codes)).any()


def test_copies_ties_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, (1.0, 0.0)) for i in range(60)] + [(100 + i, (float(i), 1.0)) for i in range(10)]
    odd = [(200, None), (220, (0.0, 0.0)), (240, (nan, 1.0)), (260, (inf, 1.0)), (280, (None, 1.0)), (None, (1.0, 1.0)), (300, (1.0,)), (0, (1.0, 0.0))]
    table = [(i, list(v) if v else None, 1, "x") for i, v in rows + odd]
    docs = spark.createDataFrame(table, "vec_id long, embedding array<float>, rank int, entry string")
    want = brute(rows, 20)
    got = op.nearest(docs, 20).collect()
    check(got, want, 1.0)
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in got} == {(q, k + 1, j) for q, x in want.items() for k, (_, j) in enumerate(x)}
    few = op.nearest(docs.where("vec_id in (0, 100, 105)"), 20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in few) == [(0, 1, 105), (0, 2, 100), (100, 1, 105), (100, 2, 0)]
    assert op.nearest(docs.where("false"), 20).collect() == []
    assert op.nearest(docs.where("vec_id = 0"), 20).collect() == []
