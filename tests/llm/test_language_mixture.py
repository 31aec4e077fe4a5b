import random
import zlib

import numpy as np
from plain import ODD

from accesslens.llm import language_mixture as op


def _one_document(logs, steps=op.STEPS):
    """EM for one document, word by word."""
    share = np.full(logs.shape[1], 1 / logs.shape[1])
    for _ in range(steps):
        total = np.zeros_like(share)
        for w in logs:
            r = np.exp(w - w.max()) * share
            total += r / r.sum()
        share = total / len(logs)
    return share


def test_em_of_a_batch_equals_one_by_one():
    rng = np.random.default_rng(3)
    n = np.array([1, 7, 40, 3])
    logs = rng.normal(0, 4, (n.sum(), 5)).astype(np.float32)
    first = np.cumsum(n) - n
    e = np.exp(logs - logs.max(axis=1, keepdims=True)).astype(float)
    got = op._em(e, first, n, np.full((4, 5), 0.2))
    want = [_one_document(x.astype(float)) for x in np.split(logs, first[1:])]
    assert np.allclose(got, want, atol=1e-6)


def test_mixtures_and_sets():
    """Words of two languages, 70 to 30: both are found, a third is not."""
    rng = np.random.default_rng(1)
    true = np.r_[np.zeros(70, int), np.ones(30, int)]
    logs = rng.normal(-20, 1, (100, 3))
    logs[np.arange(100), true] += 8
    share = op.proportions(logs.astype(np.float32), np.array([100]))[0]
    assert np.allclose(share, [0.7, 0.3, 0], atol=0.02) and share[2] == 0
    logs[:, 0] += 20
    assert op.proportions(logs.astype(np.float32), np.array([60, 40])).tolist() == [[1, 0, 0], [1, 0, 0]]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = op.op7_language_mixture(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.98


def test_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = op.crc_mod("doc_id", 3) == 1
    turned = docs.withColumn("lang", op.F.when(held, "xx").otherwise(op.F.col("lang")))
    a, b = op.fit(docs), op.fit(turned)
    assert a.languages == b.languages and (a.logs == b.logs).all()


def test_odd_rows(spark, odd, empty):
    model = op.fit(odd)
    got = {(r["doc_id"], r["lang_pred"], r["score"]) for r in op.identify(odd, model).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)} <= got
    assert op.identify(odd, model).count() == len(ODD)
    assert op.identify(empty, model).count() == 0
    none = op.fit(empty)
    assert {r["lang_pred"] for r in op.identify(odd, none).collect()} == {"und"}
    digits = spark.createDataFrame([(1, "123 ... 456"), (2, "¿¡ 12"), (3, "é")], "doc_id long, text string")
    assert [r["lang_pred"] == "und" for r in op.identify(digits, model).orderBy("doc_id").collect()] == [True, True, False]


def test_long_texts_are_cut_at_blanks(monkeypatch):
    rng = random.Random(5)
    data = op._blanked(" ".join("".join(rng.choices("abcé", k=rng.randint(1, 300))) for _ in range(200)))
    model = op.Model(["a", "b"], np.random.default_rng(0).normal(0, 1, (op.CELLS, 2)).astype(np.float32))
    whole = model.words(data)
    monkeypatch.setattr(op, "CHUNK_BYTES", 64)
    assert np.allclose(model.words(data), whole) and len(whole) == 200


def test_300_languages_and_a_text_of_six(spark):
    """No language is left out for being rare, and a mixture may have more than four."""
    import random

    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{i:03d}": ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(12)] for i in range(300)}
    rows = [(i * 40 + j, " ".join(rng.choices(w, k=30)), lang) for i, (lang, w) in enumerate(words.items()) for j in range(4)]
    model = op.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) > 290
    six = [lang for lang in model.languages if lang in words][::40][:6]
    text = " ".join(w for lang in six for w in words[lang] * 6)
    (best, score, mixture) = op._predict(model, [text])[0]
    named = {x.split(":")[0] for x in mixture.split(",") if float(x.split(":")[1]) > 0.05}
    assert named == set(six) and best in six and 0 < score <= 1
    alone = [model.languages[0], model.languages[150], model.languages[-1]]
    assert [x[0] for x in op._predict(model, [" ".join(words[lang]) for lang in alone])] == alone
