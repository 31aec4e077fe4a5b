import random
import re
from collections import Counter

from plain import ODD

from accesslens.llm import decontamination as op


def words_of(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())


def bag(words, width):
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(docs, items):
    out = []
    for d, text in docs:
        words = words_of(text)
        for item, passage in items:
            p = words_of(passage)
            if not p:
                continue
            width = min(5, len(p))
            b = bag(p, width)
            n = min(len(p), len(words))
            if not b.keys() & bag(words, width).keys():
                continue
            best, first, windows = 0.0, 0, 0
            for i in range(len(words) - n + 1):
                a = bag(words[i : i + n], width)
                least = sum((a & b).values())
                s = least / sum((a | b).values())
                if s >= 0.8:
                    windows += 1
                    if s > best:
                        best, first = s, i
            if windows:
                out.append((d, item, best, first, windows))
    return sorted(out, key=repr)


def mine(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_changed_passages_equal_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "漢字", "42"]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([3, 4, 5, 9, 15, 20, 20, 33, 40, 60, 60])]
    items += [(100, None), (101, " . "), (9, items[9][1]), (102, "a b " * 20)]
    docs = [(1000, items[8][1][:-10]), (1001, "x " + items[0][1].upper()), (None, items[5][1]), (1002, "a b " * 30)]
    for d in range(80):
        words = words_of(rng.choice(items)[1]) or ["x"]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            i = rng.randrange(len(words))
            words[i : i + rng.choice([0, 1])] = rng.choices(vocabulary, k=rng.choice([0, 1]))
            words = words or ["x"]
        text = rng.choices(vocabulary, k=rng.randint(0, 90)) + words + rng.choices(vocabulary, k=rng.randint(0, 90))
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(text)))
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert mine(op.leaks(a, b)) == want and len(want) > 30
    monkeypatch.setattr(op, "ITEM_BYTES", 300)  # several passes
    monkeypatch.setattr(op, "WINDOWS", 7)
    assert mine(op.leaks(a, b)) == want


def test_whole_table(spark, small):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    got = op.op1_decontamination(spark, "/root/testdata/sf0.001")
    assert mine(got) == brute([(r["doc_id"], r["text"]) for r in small], items)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = op.decontamination_stage(spark, docs, "/root/testdata/sf0.001")
    assert kept.schema == docs.schema
    leaked = {r["doc_id"] for r in got.collect()}
    assert leaked and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in small} - leaked


def test_index_returns_all_within_radius():
    rng = random.Random(1)
    items = op.Items.of([(i, f"a{i} b c d e f") for i in range(50)])
    centre = rng.getrandbits(64)
    items.prints = op.np.array([centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 40))) for _ in range(50)], dtype=op.np.uint64)
    asked = op.np.array([centre, rng.getrandbits(64)], dtype=op.np.uint64)
    got = sorted(items.candidates(asked, 6))
    assert got == [(w, i) for w in range(2) for i in range(50) if (int(asked[w]) ^ int(items.prints[i])).bit_count() <= op.RADIUS]


def test_odd_rows(spark, odd, empty, monkeypatch):
    bench = spark.createDataFrame([(1, "one two three four five six seven"), (2, None), (3, ""), (None, "漢字")], "item_id long, text string")
    want = brute([r[:2] for r in ODD], [(1, "one two three four five six seven"), (None, "漢字")])
    assert mine(op.leaks(odd, bench)) == want and len(want) == 4
    assert mine(op.leaks(empty, bench)) == [] and mine(op.leaks(odd, bench.where("false"))) == []
    long_word = "y" * 3000
    assert len(op.word_hashes(long_word + " z")) == 2
    monkeypatch.setattr(op, "_PIECE", 50)
    text = " ".join(f"w{i}" for i in range(400)) + " " + long_word
    pieces = op.word_hashes(text)
    monkeypatch.undo()
    assert (pieces == op.word_hashes(text)).all()
