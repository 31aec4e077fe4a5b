import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import ODD, brute_components

from accesslens.llm import simhash_dedup as op


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    n = min(3, len(words))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_result(rows):
    fps = [(d, plain_fingerprint(t)) for d, t in rows]
    linked = [(a, b) for a, f in fps for b, g in fps if a is not None and b is not None and a < b and (f ^ g).bit_count() <= 2]
    comp = brute_components([d for d, _ in fps if d is not None], linked)
    return sorted((d, f"{f:016x}", comp[d]) for d, f in fps if d is not None)


def test_equals_brute_force(spark, small):
    got = op.op5_simhash_dedup(spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r) for r in got) == plain_result([(r["doc_id"], r["text"]) for r in small])


def test_odd_rows(spark, odd, empty):
    got = op.near_duplicates(odd).select("doc_id", op.hex16(op.F.col("fp")), "component_id").collect()
    assert sorted(tuple(r) for r in got if r[0] is not None) == plain_result([r[:2] for r in ODD])
    assert [r[2] for r in got if r[0] is None] == [5]
    assert op.near_duplicates(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=150), st.integers(0, 5), st.data())
def test_bit_sliced_distance(values, radius, data):
    q = data.draw(st.sampled_from(values)) ^ data.draw(st.integers(0, 15))
    planes = op.planes_of(np.array(values, dtype=np.uint64))
    got = op.lanes_of(op.within(planes, q, radius, op.all_lanes(len(values))))
    assert got.tolist() == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= radius]


def _ball(n, flips, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 3)
    out = set()
    while len(out) < n:
        v = int(centres[rng.integers(3)])
        for b in rng.integers(0, 64, flips):
            v ^= 1 << int(b)
        out.add(v & (2**63 - 1))
    return sorted(out)


def test_groups_of_any_size_and_hot_keys(spark, monkeypatch):
    """Dense balls: large groups, and keys made longer, give the components of all pairs."""
    values = _ball(600, 3, 1)
    pairs = [(i, j) for j in range(len(values)) for i in range(j) if (values[i] ^ values[j]).bit_count() <= 2]
    want = brute_components(range(len(values)), pairs)
    table = spark.createDataFrame(list(enumerate(values)), "node long, fp long")
    for hot in (4096, 40):
        monkeypatch.setattr(op, "HOT_KEY", hot)
        edges = op.links(table)
        assert all((values[u] ^ values[v]).bit_count() <= 64 for u, v in edges.collect())
        found = {r["node"]: r["component"] for r in op.components(edges).collect()}
        assert {i: found.get(i, i) for i in range(len(values))} == want
