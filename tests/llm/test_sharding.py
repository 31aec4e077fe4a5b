import zlib
from collections import defaultdict

from plain import ODD

from accesslens.llm import sharding as op


def check(rows, texts, n=op.SHARDS):
    """The law of shards, from the rows alone."""
    sizes = sorted((d, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for d, t in texts if d is not None)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows if r["doc_id"] is not None) == sizes
    assert len(rows) == len(texts)
    assert {(r["law"], r["grown_shard"]) for r in rows} <= {("bytes", None)}
    slots, held, groups = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in rows:
        assert 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
        held[r["shard"]] += r["size"]
        groups[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g) == 1 for g in groups.values())
    return held


def test_whole_table(spark, small):
    rows = op.op4_sharding(spark, "/root/testdata/sf0.001").collect()
    held = check(rows, [(r["doc_id"], r["text"]) for r in small])
    assert max(held.values()) - min(held.values()) <= 2 * max(r["size"] for r in rows)


def test_copies_stay_together_and_balance_holds(spark):
    texts = [(i, "copy " * 40) for i in range(150)] + [(1000 + i, f"text {i} " * (1 + i % 17)) for i in range(2000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    held = check(op.shard(docs, 5).collect(), texts, 5)
    total = sum(held.values())
    assert len(held) == 5 and max(held.values()) - min(held.values()) < 0.03 * total / 5


def test_odd_rows(spark, odd, empty):
    check(op.shard(odd).collect(), [r[:2] for r in ODD])
    check(op.shard(odd, 1).collect(), [r[:2] for r in ODD], 1)
    assert op.shard(empty).collect() == []
