"""All labelled examples and all their words count, whatever the share of toxic ones."""

import random
import zlib
from collections import Counter

import numpy as np

from accesslens.llm import nearest_toxic as op


def _rare(spark, n=600):
    """Documents of which 2 % are toxic; each toxic one, and more clean ones, hold one word."""
    rng = random.Random(5)
    rows = []
    for d in range(n):
        toxic = d % 50 == 7
        words = [f"w{rng.randint(0, 300)}" for _ in range(20)] + ["zorgle"] * (toxic or d % 33 == 8)
        rows.append((d, " ".join(words), int(toxic)))
    whole = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return whole.select("doc_id", "text"), whole.select("doc_id", "toxic")


def test_a_word_of_rare_labels_counts(spark):
    index = op.fit(*_rare(spark))
    assert index.toxic.sum() > 0 and "zorgle" in index.terms
    with_word, without = (index.score(f"w1 w2 w3 {w}") for w in ("zorgle", "w4"))
    assert with_word[1] and "zorgle" in with_word[2]
    assert with_word[0] > without[0]


def test_rare_words_and_blocks_without_loss(monkeypatch):
    monkeypatch.setattr(op, "DENSE", 4)
    monkeypatch.setattr(op, "BLOCK", 16)
    rng = random.Random(3)
    terms = {f"t{i}": (i, 0.3 + 3 * rng.random()) for i in range(60)}
    examples = []
    for d in range(500):
        found = sorted((t, rng.randint(1, 3)) for t in rng.sample(sorted(terms), rng.randint(1, 8)))
        examples.append((d, d % 2, sum(c for _, c in found), found))
    index = op.build(terms, examples)
    whole = np.zeros((500, 60))
    for i in range(500):
        own = slice(index.begin[i], index.begin[i + 1])
        whole[i, index.held[own]] = index.held_weight[own]
    assert len(index.ids) == 500 and (index.slot < 0).sum() == 56 and not index.rest.any()
    read = []
    plain = op.Index._rare
    monkeypatch.setattr(op.Index, "_rare", lambda self, t, w, blocks: read.extend(blocks) or plain(self, t, w, blocks))
    vectors = [index.vector(Counter({f"t{rng.randint(0, 59)}": 1 for _ in range(3)}), 9) for _ in range(60)]
    for (t, w, _), (rows, cosines) in zip(vectors, index.nearest_of(vectors)):
        expected = whole[:, t] @ w
        assert np.allclose(cosines, np.sort(expected)[::-1][: op.NEIGHBOURS])
        assert np.allclose(expected[rows], cosines)
    assert len(read) < 60 * index.blocks  # some blocks are skipped


def test_every_example_is_indexed_and_copies_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    index = op.fit(docs, labels)
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    learned = {d for d in toxic if d in texts and zlib.crc32(str(d).encode()) % 5}
    worded = {d for d in learned if op.words_of(texts[d])}
    assert set(index.ids.tolist()) == worded
    assert set(index.names) == {w for d in worded for w in op.words_of(texts[d])}
    ids = sorted(worded)[:300]
    for d, (p, near, _) in zip(ids, index.score_of([texts[d] for d in ids])):
        assert sorted(op.words_of(texts[near[0]])) == sorted(op.words_of(texts[d]))
        alike = {toxic[e] for e in worded if op.words_of(texts[e]) == op.words_of(texts[d])}
        assert len(alike) > 1 or (p >= 0.5) == toxic[d]
    found = op.score(docs, index).collect()
    assert all(r["neighbours"] for r in found if set(op.words_of(texts[r["doc_id"]])) & set(index.names))


def test_recall_of_held_out_toxic_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = docs.join(labels.where("toxic = 1").select("doc_id"), "doc_id").where(op.crc_mod("doc_id", 5) == 0)
    found = op.score(held, op.fit(docs, labels)).collect()
    assert len(found) > 90 and sum(r["predicted"] for r in found) >= 0.9 * len(found)
