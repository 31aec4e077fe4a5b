import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from accesslens.llm import sequences
from accesslens.llm.sequences import SEQUENCE, encoder, first_fit, op11_packing, pack_sequences, placed, powers

PATH = public_tokenizers.path("byte_bpe_50k.json")
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def padding(filled, room=SEQUENCE):
    return sum(0 if n & (n - 1) == 0 else room - n for n in filled)


def check(rows, tokens, room=SEQUENCE):
    """Every token once and in place, no gaps, no sequence too long; returns tokens by sequence."""
    pieces = defaultdict(list)
    filled = defaultdict(int)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert sorted(pieces) == sorted(tokens)
    for d, ps in pieces.items():
        ps.sort(key=lambda p: p["start"])
        assert [p["start"] for p in ps] == [0, *np.cumsum([p["length"] for p in ps])[:-1].tolist()]
        assert sum(p["length"] for p in ps) == len(tokens[d]) == ps[0]["doc_tokens"]
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert filled[r["sequence_id"]] == r["offset"]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values(), default=0) <= room
    return filled


def test_query_equals_plain_tokens_and_hardly_pads(spark, library):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{MIDDLE}/documents.parquet").to_pylist()}
    tokens = {d: library(t or "") + [1] for d, t in texts.items()}
    rows = op11_packing(spark, MIDDLE).collect()
    filled = check(rows, tokens)
    for r in rows:
        some = tokens[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(some, dtype="<u4").tobytes())
    assert padding(filled.values()) < 0.005 * sum(filled.values())


def test_odd_rows_are_documents_like_any_other(spark, odd, empty, library):
    rows = pack_sequences(odd, PATH, room=512, group_pieces=4).collect()
    whole = defaultdict(bytes)
    for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"], r["sequence_id"])):
        assert len(r["ids"]) == 4 * r["length"]
    docs = odd.collect()
    single = [r for r in docs if r["doc_id"] not in (None, 2)]
    for r in sorted((r for r in rows if r["doc_id"] not in (None, 2)), key=lambda r: r["start"]):
        whole[r["doc_id"]] += r["ids"]
    for r in single:
        assert np.frombuffer(whole[r["doc_id"]], "<u4").tolist() == library(r["text"] or "") + [1]
    assert sum(r["length"] for r in rows) == sum(len(library(r["text"] or "")) + 1 for r in docs)
    assert [r["length"] for r in rows if r["doc_id"] == 2] == [1, 1]
    assert pack_sequences(empty, PATH).count() == 0


def test_a_third_of_all_rows_alike_is_spread_over_groups(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "if(id % 3 = 0, 'the same text', concat('text ', id)) as text")
    rows = pack_sequences(docs, PATH, group_pieces=100).collect()
    groups = {r["sequence_id"] >> 33 for r in rows if r["doc_id"] == 7}
    assert len(groups) == 30
    assert sum(r["doc_tokens"] for r in rows if r["start"] == 0) == sum(r["length"] for r in rows)


def test_many_long_texts_together(spark, library):
    text = "long words and more of them, 1234. " * 30_000
    docs = spark.range(12).selectExpr("id as doc_id").crossJoin(spark.createDataFrame([(text,)], "text string"))
    rows = pack_sequences(docs, PATH).drop("ids").collect()
    check(rows, {d: range(len(library(text)) + 1) for d in range(12)})


@given(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_fast_ids_are_the_librarys(library, text):
    assert encode(text).tolist() == library(text)


encode = encoder(PATH)


@pytest.mark.parametrize("text", ["<|endoftext|>a <|endoftext|> b", "x  \n\n y\t\t", "it's I'LL don''s", " " * 50 + "a", "x" * 5000, "\u0085  a　", "\x00\x01", "漢字 🙂"])
def test_special_cases_of_the_pattern(library, text):
    assert encode(text).tolist() == library(text)


def test_other_tokenizers_go_through_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    assert encoder(path)("Some Words, here").tolist() == plain.encode("Some Words, here", add_special_tokens=False).ids


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=200, deadline=None)
def test_first_fit_equals_a_scan_over_all_sequences(lengths):
    lengths = sorted(lengths, reverse=True)
    rooms, homes = [], []
    for n in lengths:
        at = next((i for i, r in enumerate(rooms) if r >= n), len(rooms))
        if at == len(rooms):
            rooms.append(64)
        rooms[at] -= n
        homes.append(at)
    assert first_fit(np.array(lengths, dtype=np.int64), 64).tolist() == homes


@given(st.lists(st.integers(1, 64), max_size=60), st.integers(0, 63))
@settings(max_examples=200, deadline=None)
def test_cuts_keep_every_token(lengths, most_room):
    got = list(placed(np.array(lengths, dtype=np.int64), 64, most_room))
    rows = [{"doc_id": p, "start": s, "length": n, "doc_tokens": lengths[p], "sequence_id": q, "offset": o} for p, s, n, q, o in got]
    filled = check(rows, {i: range(n) for i, n in enumerate(lengths)}, 64)
    assert all(64 - n <= most_room or n & (n - 1) == 0 for n in filled.values())


def test_powers():
    assert [powers(n) for n in (1, 6, 2048, 2047)] == [[1], [4, 2], [2048], [1 << b for b in range(10, -1, -1)]]
    assert sequences.MOST_ROOM < SEQUENCE
