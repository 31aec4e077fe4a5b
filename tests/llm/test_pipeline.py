import corpus_pipeline
from test_decontamination import brute as leaked
from test_mixing import brute as mixed
from test_sharding import check as check_shards
from test_simhash_dedup import plain_result

from accesslens.llm import mixing, nearest_toxic
from accesslens.llm.common import table

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_run_equals_brute_force_stage_by_stage(spark):
    docs = {r["doc_id"]: r for r in table(spark, MIDDLE, "documents").collect()}
    scored = nearest_toxic.op10_nearest_toxic(spark, MIDDLE).collect()
    left = [docs[r["doc_id"]] for r in scored if r["score"] < 0.5]
    assert len(left) < len(docs)
    left = [docs[d] for d, _, c in plain_result([(r["doc_id"], r["text"]) for r in left]) if d == c]
    items = [(r["item_id"], r["text"]) for r in table(spark, MIDDLE, "benchmark").collect()]
    dirty = {r[0] for r in leaked([(r["doc_id"], r["text"]) for r in left], items)}
    left = [r for r in left if r["doc_id"] not in dirty]
    assert dirty
    paths = [(r["doc_id"], r["text"], (mixing.DOMAINS[int(r["source"][3:]) % 3], r["lang"], r["source"])) for r in left]
    taken = {d for d, _ in mixed(paths, mixing.LEVELS, 0.9, 1, mixing.SEED)}
    left = [(r["doc_id"], r["text"]) for r in left if r["doc_id"] in taken]
    check_shards(corpus_pipeline.run(spark, MIDDLE).collect(), left)


def test_stages_keep_the_columns_and_take_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        for _, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, docs, SMALL)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_dedup_keeps_one_of_each(spark, odd):
    kept = [r["doc_id"] for r in corpus_pipeline.STAGES[1][1](spark, odd, SMALL).collect()]
    assert sorted(kept) == [1, 5, 7, 8, 9]


def test_columns_of_any_name_pass(spark):
    docs = table(spark, SMALL, "documents")
    for c in ("_kept", "_taken", "counts", "fp", "domain", "level_0", "hash"):
        docs = docs.withColumn(c, mixing.F.lit("mine"))
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SMALL)
        assert out.columns == docs.columns and out.where("_kept = 'mine' and counts = 'mine' and _taken = 'mine'").count() == out.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()
