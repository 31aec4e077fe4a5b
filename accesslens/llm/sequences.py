"""Documents packed into token sequences: first-fit decreasing in randomised groups.

A document's tokens are cut at every full sequence; those pieces fill sequences of their own.  What is left of each
document is dealt to a random group of some thousand, and each group packs its pieces by itself: the longest
first, each into the first sequence with room, which a tournament tree over the rooms finds from its root.  A
sequence that stays far from full is cut at powers of two, which need no padding.

The groups' sizes follow from the number of pieces, so a group is a bounded piece of work whatever the table holds.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from accesslens.llm.common import binary_values, chunks, long_array, slices, stage, table, texts
from accesslens.llm.packing import pack, unpack

SEQUENCE = 2048
#: Ends every document.
END_ID = 1
#: Pieces in a group, on average.
GROUP_PIECES = 4096
#: A sequence with more room than this is cut at powers of two.
MOST_ROOM = SEQUENCE // 32
SEED = 11

_IDS = np.dtype("<u4")
_STAGED = "doc_id long, start long, length long, doc_tokens long, ids binary, piece long"
_PLACED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_PLACED_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def _byte_of() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Token ids of a text by a tokenizer file, no special tokens added.

    A plain byte-level BPE whose ids follow its merges gives the same ids through ranked merges, several times
    faster; any other file goes through its own library.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and spec.get("normalizer") is None
        and spec.get("truncation") is None
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"])
    )
    if plain:
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = _byte_of()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        follows = all(model["vocab"][a + b] == 256 + i for i, (a, b) in enumerate(merges))
        words = {w: i for w, i in model["vocab"].items() if w not in added}
        if follows and len(words) == 256 + len(merges):
            ranks = {bytes(byte[c] for c in w): i for w, i in words.items()}
            fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
            return lambda text: fast.encode_to_numpy(text, allowed_special="all")
    slow = Tokenizer.from_file(path)
    slow.no_truncation()
    slow.no_padding()
    return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


class Rooms:
    """A tournament tree: each node holds the largest room below it, so the first place with room is one walk down."""

    def __init__(self, places: int, room: int):
        self.base = 1 << max(places - 1, 0).bit_length()
        self.most = [room] * (2 * self.base)

    def take(self, need: int) -> int:
        """The first place with that much room, made smaller; there is one as long as pieces do not outnumber places."""
        most, node = self.most, 1
        while node < self.base:
            node *= 2
            if most[node] < need:
                node += 1
        place = node - self.base
        most[node] -= need
        while node > 1:
            node //= 2
            left, right = most[2 * node], most[2 * node + 1]
            most[node] = left if left > right else right
        return place


def first_fit(lengths: np.ndarray, room: int = SEQUENCE) -> np.ndarray:
    """The sequence of each piece; ``lengths`` fall."""
    rooms = Rooms(len(lengths), room)
    return np.array([rooms.take(n) for n in lengths.tolist()], dtype=np.int64)


def powers(filled: int) -> list[int]:
    """A length as falling powers of two."""
    return [1 << b for b in range(filled.bit_length() - 1, -1, -1) if filled >> b & 1]


def placed(lengths: np.ndarray, room: int = SEQUENCE, most_room: int = MOST_ROOM) -> Iterator[tuple[int, int, int, int, int]]:
    """(piece, start in it, length, sequence, offset): first-fit decreasing, then cuts of sequences far from full."""
    order = np.argsort(-lengths, kind="stable")
    home = first_fit(lengths[order], room)
    by_home = np.argsort(home, kind="stable")
    sequence = 0
    for held in np.split(by_home, np.flatnonzero(np.diff(home[by_home])) + 1) if len(home) else []:
        pieces = order[held].tolist()
        filled = int(lengths[pieces].sum())
        ends = np.cumsum(powers(filled) if room - filled > most_room else [filled]).tolist()
        at, low = 0, 0  # place in the content, begin of the sequence at hand
        for p in pieces:
            start, left = 0, int(lengths[p])
            while left:
                while at >= ends[0]:
                    low = ends.pop(0)
                    sequence += 1
                n = min(left, ends[0] - at)
                yield p, start, n, sequence, at - low
                start, left, at = start + n, left - n, at + n
        sequence += 1


def _tokenised(path: str, room: int, end_id: int):
    """Pieces of every document: full ones, and what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        piece = TaskContext.get().partitionId() << 40
        for b in slices(batches):
            ids, column = b.column(0), b.column(1)
            sizes = [len(x) for x in binary_values(column)]
            for lo, hi in chunks(sizes):
                rows: list[list] = [[] for _ in range(6)]
                for i in range(lo, hi):
                    tokens = np.append(encode(column[i].as_py() or "").astype(_IDS, copy=False), np.array([end_id], _IDS))
                    for start in range(0, len(tokens), room):
                        some = tokens[start : start + room]
                        for c, v in zip(rows, (ids[i].as_py(), start, len(some), len(tokens), pack(some), piece)):
                            c.append(v)
                        piece += 1
                kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], names=["doc_id", "start", "length", "doc_tokens", "ids", "piece"])

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full pieces are sequences; theirs have even numbers."""
    for b in slices(batches):
        c = {n: b.column(i) for i, n in enumerate(b.schema.names)}
        ids = pa.array([unpack(x, _IDS).tobytes() for x in c["ids"].to_pylist()], pa.binary())
        number = long_array(c["piece"].to_numpy(zero_copy_only=False) * 2)
        yield pa.RecordBatch.from_arrays([c["doc_id"], c["start"], c["length"], ids, c["doc_tokens"], number, long_array(np.zeros(b.num_rows))], names=_PLACED_NAMES)


def _grouped(room: int, most_room: int):
    """Packs the pieces of one group; their sequences have odd numbers."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("piece")
        lengths = t.column("length").to_numpy()
        at = list(placed(lengths, room, most_room))
        piece, inner, length, sequence, offset = (np.array(x, dtype=np.int64) for x in zip(*at))
        packed = t.column("ids").to_pylist()
        ids = [unpack(packed[p], _IDS)[s : s + n].tobytes() for p, s, n, _, _ in at]
        return pa.Table.from_arrays(
            [
                t.column("doc_id").take(pa.array(piece)),
                long_array(t.column("start").to_numpy()[piece] + inner),
                long_array(length),
                pa.array(ids, pa.binary()),
                t.column("doc_tokens").take(pa.array(piece)),
                long_array(((key[0].as_py() << 32) + sequence) * 2 + 1),
                long_array(offset),
            ],
            names=_PLACED_NAMES,
        )

    return run


def pack_sequences(
    docs: DataFrame,
    tokenizer: str,
    room: int = SEQUENCE,
    end_id: int = END_ID,
    group_pieces: int = GROUP_PIECES,
    most_room: int = MOST_ROOM,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): a row for each piece of each document.

    ``ids`` holds the piece's tokens as little-endian unsigned 32-bit numbers.  Each token of each row is in exactly one piece;
    offsets of a sequence have no gaps, and none holds more than ``room`` tokens.  A null or empty text is its end token
    alone.  A very long text fills sequences as it is read and adds at most one piece to a group.  Repeated rows and
    ids, and rows with a null id, are documents like any other.  An empty table gives no rows; other columns are not read.
    """
    staged = stage(texts(docs, id_col, text_col).mapInArrow(_tokenised(tokenizer, room, end_id), _STAGED), "sequence-pieces")
    short = staged.where(F.col("length") < room)
    groups = max(1, -(-short.count() // group_pieces))
    short = short.withColumn("grp", F.pmod(F.xxhash64("piece", F.lit(SEED)), F.lit(groups)))
    packed = short.groupBy("grp").applyInArrow(_grouped(room, most_room), _PLACED)
    return staged.where(F.col("length") == room).mapInArrow(_whole, _PLACED).unionByName(packed)


def op11_packing(spark, sf_dir: str) -> DataFrame:
    """All documents, with the byte-level vocabulary of 50,257 ids."""
    found = pack_sequences(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op11_packing": op11_packing}
#: Tokenizers have no form in SQL.
ORACLE: dict[str, str] = {}
