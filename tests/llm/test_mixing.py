import random
import re
from collections import Counter, defaultdict

import pytest
from plain import ODD

from accesslens.llm import mixing as op


def by_hand(weights, room, budget):
    """Pour the budget in small drops."""
    got = [0.0] * len(weights)
    drop = budget / 20000
    for _ in range(20000):
        open_ = [i for i in range(len(weights)) if weights[i] > 0 and got[i] < room[i]]
        if not open_:
            break
        i = min(open_, key=lambda i: got[i] / weights[i])
        got[i] += drop
    return got


def test_share_is_water_filling():
    rng = random.Random(3)
    for _ in range(30):
        n = rng.randint(1, 6)
        weights = [rng.choice([0, 0.5, 1, 2, 3]) for _ in range(n)]
        room = [rng.choice([0, 5, 50, 500]) for _ in range(n)]
        budget = rng.choice([1, 60, 400])
        assert op.share(budget, weights, room) == pytest.approx(by_hand(weights, room, budget), abs=budget / 400)


def test_shortage_goes_to_siblings_first():
    levels = [op.Level("d", {"a": 1, "b": 1}), op.Level("l", {"x": 1, "y": 1})]
    tokens = {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 1000, ("b", "y"): 1000}
    assert op.leaf_budgets(levels, tokens, 400, 1) == {("a", "x"): 10, ("a", "y"): 190, ("b", "x"): 100, ("b", "y"): 100}
    tokens[("a", "y")] = 50  # a is short as a whole: b takes the rest
    assert op.leaf_budgets(levels, tokens, 400, 1) == {("a", "x"): 10, ("a", "y"): 50, ("b", "x"): 170, ("b", "y"): 170}
    assert sum(op.leaf_budgets(levels, tokens, 10**9, 2).values()) == 2 * (60 + 2000)
    assert sum(op.leaf_budgets(levels, tokens, 401, 1).values()) == 401


def held(rows):
    taken, times = Counter(), defaultdict(list)
    for r in rows:
        taken[r["domain"], r["lang"], r["source"]] += r["tokens"]
        times[r["doc_id"]].append(r["epoch"])
    return taken, times


def brute(docs, levels, part, epochs, seed):
    """The same choice with one sorted list per leaf."""
    import xxhash

    leaves = defaultdict(list)
    for d, text, path in docs:
        leaves[path].append((d, len(re.findall(r"\S+", text or ""))))
    tokens = {p: sum(t for _, t in x) for p, x in leaves.items() if sum(t for _, t in x)}
    budgets = op.leaf_budgets(levels, tokens, int(sum(tokens.values()) * part), epochs)

    def order(d, full):
        h = 0x2A
        for v, size in ((seed, 4), (full, 8), (d, 8)):
            h = xxhash.xxh64_intdigest(v.to_bytes(size, "little", signed=True), h)
        return h >> 1

    out = []
    for p, total in tokens.items():
        full, rest = divmod(budgets.get(p, 0), total)
        before = 0
        for d, t in sorted(leaves[p], key=lambda x: (order(x[0], full), x)):
            out += [(d, e) for e in range(full)]
            if before < rest:
                out.append((d, full))
            before += t
    return sorted(out)


def test_whole_table_equals_brute_force(spark, small):
    rows = op.op3_mixing(spark, "/root/testdata/sf0.001").collect()
    docs = []
    for r in small:
        path = (op.DOMAINS[int(r["source"][3:]) % 3], r["lang"] if r["lang"] in op.LEVELS[1].weights else "*", r["source"])
        docs.append((r["doc_id"], r["text"], path))
    assert sorted((r["doc_id"], r["epoch"]) for r in rows) == brute(docs, op.LEVELS, op.BUDGET_PART, op.MAX_EPOCHS, op.SEED)
    taken, times = held(rows)
    assert all(sorted(e) == list(range(len(e))) for e in times.values())
    assert max(len(e) for e in times.values()) <= op.MAX_EPOCHS


def test_odd_rows(spark, odd, empty):
    for part, epochs in ((0.5, 1), (1.0, 1), (5.0, 3)):
        rows = op.mix(op.with_domain(odd), op.LEVELS, part, epochs).collect()
        assert all(r["epoch"] < epochs for r in rows)
    assert op.mix(op.with_domain(empty), op.LEVELS, 1.0, 2).collect() == []
    assert op.mix_stage(spark, empty, "").columns == empty.columns
    assert op.mix_stage(spark, odd, "").count() <= len(ODD)


def test_more_slices_for_more_rows_and_the_same_result(spark, monkeypatch):
    assert [op.slice_bits(n) for n in (0, 10**6, 1 << 30, 10**11)] == [12, 12, 16, 19]
    few = sorted(map(tuple, op.op3_mixing(spark, "/root/testdata/sf0.001").collect()), key=str)
    monkeypatch.setattr(op, "slice_bits", lambda rows: 17)
    assert sorted(map(tuple, op.op3_mixing(spark, "/root/testdata/sf0.001").collect()), key=str) == few
