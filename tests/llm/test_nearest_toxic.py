import random
import zlib
from collections import Counter

import numpy as np
from plain import ODD

from accesslens.llm import nearest_toxic as op


def _index(n, seed):
    rng = random.Random(seed)
    terms = {f"t{i}": (i, 0.5 + rng.random()) for i in range(30)}
    examples = []
    for d in range(n):
        found = [(t, rng.randint(1, 4)) for t in rng.sample(sorted(terms), rng.choice([0, 1, 2, 5]))]
        examples.append((d * 3, rng.randint(0, 1), rng.randint(5, 300), sorted(found)))
    return op.build(terms, examples), examples


def test_blocks_are_skipped_without_loss():
    index, examples = _index(700, 1)
    rng = random.Random(2)
    dense = np.zeros((len(index.ids), len(index.terms)))
    cell = np.repeat(np.arange(len(index.start) - 1), np.diff(index.start))
    dense[index.row, cell // index.blocks] = index.weight
    for _ in range(80):
        t, w, rest = index.vector(Counter({f"t{rng.randint(0, 29)}": rng.randint(1, 5) for _ in range(3)}), rng.randint(3, 400))
        cosines = dense[:, t] @ w + rest * index.rest
        rows, got = index.nearest((t, w, rest))
        assert np.allclose(got, np.sort(cosines)[::-1][: op.NEIGHBOURS])
        assert np.allclose(cosines[rows], got)
        assert (np.linalg.norm(dense, axis=1) ** 2 + index.rest**2).round(9).tolist() == [1.0] * len(index.ids)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = op.score(docs, op.fit(docs, labels)).collect()
    assert len(rows) == docs.count()
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    held = [(r["predicted"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert sum(a == b for a, b in held) / len(held) > 0.9
    clean = [p for p, y in held if not y]
    assert sum(clean) <= 0.02 * len(clean)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", op.F.when(op.crc_mod("doc_id", 5) == 0, 1 - op.F.col("toxic")).otherwise(op.F.col("toxic")))
    a, b = (op.score(docs, op.fit(docs, y)).orderBy("doc_id").collect() for y in (labels, turned))
    assert a == b


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(2, 1), (2, 0), (7, None), (None, 1), (99, 1), (3, 0), (8, 0)], "doc_id long, toxic int")
    for docs in (odd, empty):
        index = op.fit(docs, labels)
        assert len(op.score(odd, index).collect()) == len(ODD)
        assert op.score(empty, index).collect() == []
    assert op.fit(odd, labels.where("false")).prior == 0.05
    assert op.score(odd, op.fit(odd, labels.where("false"))).where("predicted = 1").count() == 0


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = " ".join(f"Word{i % 977} x" for i in range(5000))
    whole = op.words_of(text)
    monkeypatch.setattr(op, "_PIECE", 100)
    assert op.words_of(text) == whole
    assert op.words_of("a" * 1000) == ["a" * 1000]


def test_stage_keeps_columns(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("predicted", op.F.lit("mine"))
    kept = op.toxicity_stage(spark, docs, "/root/testdata/sf0.001")
    assert kept.schema == docs.schema
    scored = op.op10_nearest_toxic(spark, "/root/testdata/sf0.001")
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in scored.where("predicted = 0").select("doc_id").collect())
