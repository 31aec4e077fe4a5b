"""Rows without a listed language or source have a share of the budget too."""

from collections import Counter

from accesslens.llm import mixing as op


def _named(spark):
    """A third of the rows each: listed, language unlisted or null, source without a number or null."""
    langs = ["en", "it", None]
    sources = ["src1", "crawl", None]
    rows = [(d, "a b c d e", langs[d % 3], sources[d // 3 % 3]) for d in range(900)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_unlisted_and_null_values_are_taken(spark):
    docs = _named(spark)
    named = {r["doc_id"]: (r["lang"], r["source"]) for r in docs.collect()}
    rows = op.mix(op.with_domain(docs), op.LEVELS, 0.5, 1).collect()
    taken = Counter(named[r["doc_id"]] for r in rows)
    assert set(taken) == set(named.values())
    assert abs(sum(r["tokens"] for r in rows) - 0.5 * 4500) <= 5 * len(taken)
    assert {r["domain"] for r in rows} == {"books", op.UNNUMBERED}
    assert all(level.weights[op.OTHER] > 0 for level in op.LEVELS)


def test_whole_budget_takes_every_document(spark):
    docs = _named(spark)
    assert {r["doc_id"] for r in op.mix(op.with_domain(docs), op.LEVELS, 1.0, 1).collect()} == set(range(900))
    kept = Counter((r["lang"], r["source"]) for r in op.mix_stage(spark, docs, "").collect())
    assert len(kept) == 9
