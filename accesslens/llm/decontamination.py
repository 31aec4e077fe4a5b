"""Benchmark decontamination with SimHash over windows the size of an item.

Words are lower-case runs of letters and digits, shingles five words.  A window of a document
has as many words as the item it is held against.  Its SimHash is looked up in a multi-index:
fingerprints are cut into 8 blocks, and as radius < 8 x (block radius + 1) some block of any fingerprint
within the radius differs in at most the block radius.  What the index returns is measured in
whole fingerprints and then verified by the exact weighted similarity of the shingles, the sum
of smaller over the sum of larger counts.

Windows that share no shingle with any item have similarity 0 and are not fingerprinted.
Items are used in blocks of bounded size; each block is broadcast for a pass of its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import CHUNK_BYTES, slices, table, texts
from accesslens.llm.packing import mixed

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 8
BLOCK_RADIUS = 2
#: Largest radius the blocks guarantee.  Windows at similarity 0.8 differ in about 10 bits of 64.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Text bytes of the items broadcast at a time.
ITEM_BYTES = 1 << 23
#: Windows fingerprinted and items looked up at a time.
WINDOWS, ITEMS = 2048, 4096

_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 19


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, base, dtype=np.uint64)])


def word_hashes(text: str | None) -> np.ndarray:
    """A hash for each word of a text."""
    data = (text or "").lower().encode().translate(_WORD_BYTES)
    out = [np.empty(0, dtype=np.uint64)]
    lo = 0
    while lo < len(data):
        hi = len(data)
        if hi - lo > _PIECE:
            cut = data.find(b" ", lo + _PIECE)
            hi = len(data) if cut < 0 else cut
        out.append(_piece_hashes(np.frombuffer(data[lo:hi], np.uint8)))
        lo = hi
    return np.concatenate(out)


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    letter = np.r_[False, data != 0x20, False]
    edge = np.flatnonzero(letter[1:] != letter[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _table(len(data))
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)]
        return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, kept for the task."""
    if not _tables or len(_tables[0][0]) < n:
        size = max(n, CHUNK_BYTES // 2)
        _tables[:] = [(_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size))]
    up, down = _tables[0]
    return up[:n], down[:n]


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of ``size`` words at each place; fewer words give none."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            h = h * np.uint64(_BASE) + words[k : k + n]
    return mixed(h)


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.astype(">u8").view(np.uint8).reshape(len(h), 8), axis=1)


def simhash(h: np.ndarray) -> int:
    """Bits set in over half the shingles, repeats counted."""
    return int.from_bytes(np.packbits(_bits(h).sum(axis=0, dtype=np.int64) * 2 > len(h)).tobytes(), "big")


def similarity(a: Counter, b: Counter) -> float:
    """Weighted similarity of two bags of shingles."""
    least = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return least / (a.total() + b.total() - least)


def _near_bytes() -> np.ndarray:
    """256 x 256: byte values that differ in at most BLOCK_RADIUS bits."""
    values = np.arange(256, dtype=np.uint8)
    return np.bitwise_count(values[:, None] ^ values) <= BLOCK_RADIUS


@dataclass
class Items:
    """Items by size: shingles of all, and per item its bag and fingerprint."""

    ids: list[int | None]
    sizes: np.ndarray  # words
    widths: np.ndarray  # shingle words, SHINGLE or all of a shorter item
    bags: list[Counter]
    prints: np.ndarray
    by_shingle: dict[int, tuple[np.ndarray, np.ndarray]]  # width -> sorted hashes, and (hash position, size) pairs

    @staticmethod
    def of(rows: list[tuple[int | None, str | None]]) -> Items:
        ids, sizes, widths, bags, prints = [], [], [], [], []
        sized: dict[int, set] = {}
        for item, text in rows:
            words = word_hashes(text)
            if not len(words):
                continue
            width = min(SHINGLE, len(words))
            h = shingles(words, width)
            ids.append(item)
            sizes.append(len(words))
            widths.append(width)
            bags.append(Counter(h.tolist()))
            prints.append(simhash(h))
            sized.setdefault(width, set()).update((x, len(words)) for x in h.tolist())
        by_shingle = {}
        for width, pairs in sized.items():
            pairs = sorted(pairs)
            h = np.array([x for x, _ in pairs], dtype=np.uint64)
            by_shingle[width] = h, np.array([n for _, n in pairs], dtype=np.int64)
        return Items(ids, np.array(sizes, dtype=np.int64), np.array(widths, dtype=np.int64), bags, np.array(prints, dtype=np.uint64), by_shingle)

    def candidates(self, prints: np.ndarray, size: int, radius: int = RADIUS) -> Iterator[tuple[int, int]]:
        """(window, item) for all items of a size within the radius of a window's fingerprint, by the multi-index."""
        near = _near_bytes()
        mine = np.flatnonzero(self.sizes == size)
        for lo in range(0, len(mine), ITEMS):
            some = mine[lo : lo + ITEMS]
            blocks = self.prints[some].astype(">u8").view(np.uint8).reshape(-1, BLOCKS)
            asked = prints.astype(">u8").view(np.uint8).reshape(-1, BLOCKS)
            hit = np.zeros((len(prints), len(some)), dtype=bool)
            for k in range(BLOCKS):
                hit |= near[:, blocks[:, k]][asked[:, k]]
            w, i = np.nonzero(hit)
            close = np.bitwise_count(prints[w] ^ self.prints[some[i]]) <= radius
            yield from zip(w[close].tolist(), some[i[close]].tolist())

    def matches(self, words: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Item -> (best similarity, its first word, windows) over the windows of a document at SIMILARITY or more."""
        found: dict[int, tuple[float, int, int]] = {}
        for width, (hashes, sizes) in self.by_shingle.items():
            h = shingles(words, width)
            lo = np.searchsorted(hashes, h, "left")
            at = np.flatnonzero(hashes[np.minimum(lo, len(hashes) - 1)] == h)
            if not len(at):
                continue
            hi = np.searchsorted(hashes, h[at], "right")
            count = hi - lo[at]
            place = np.repeat(at, count)
            size = sizes[np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo[at], count)]
            for n in np.unique(size).tolist():
                self._of_size(h, place[size == n], n, width, found)
        return found

    def _of_size(self, h: np.ndarray, shared: np.ndarray, size: int, width: int, found: dict) -> None:
        """Windows of ``size`` words that hold a shared shingle; a shorter document is one window."""
        span = min(size - width + 1, len(h))  # shingles of a window
        mark = np.zeros(len(h) + 1, dtype=np.int32)
        np.add.at(mark, np.maximum(shared - span + 1, 0), 1)
        np.add.at(mark, shared + 1, -1)
        starts = np.flatnonzero(np.cumsum(mark[:-1])[: len(h) - span + 1] > 0)
        for lo in range(0, len(starts), WINDOWS):
            some = starts[lo : lo + WINDOWS]
            places = np.unique((some[:, None] + np.arange(span)).reshape(-1))
            sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_bits(h[places]), axis=0, dtype=np.int32)])
            first = np.searchsorted(places, some)
            ones = sums[first + span] - sums[first]
            prints = np.packbits(ones * 2 > span, axis=1).view(">u8").reshape(-1).astype(np.uint64)
            bags: dict[int, Counter] = {}
            for w, item in self.candidates(prints, size):
                if w not in bags:
                    bags[w] = Counter(h[some[w] : some[w] + span].tolist())
                s = similarity(bags[w], self.bags[item])
                if s >= SIMILARITY:
                    best, at, n = found.get(item, (0.0, 0, 0))
                    found[item] = (s, int(some[w]), n + 1) if s > best else (best, at, n + 1)


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """Items in blocks of about ITEM_BYTES, by the hash of their text; only one block is held at a time."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // ITEM_BYTES + 1
    for k in range(blocks):
        some = rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).collect()
        items = Items.of(sorted(((r["item_id"], r["text"]) for r in some), key=repr))
        if items.ids:
            yield items


FOUND = "doc_id long, item_id long, similarity double, first_word long, windows long"


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, first_word, windows): a row per input row and item found in it.

    similarity and first_word are of the best window (ties: the first), windows counts those at
    0.8 or more.  Items of under five words have one shingle and match as a whole; a document shorter than an
    item is one window.  Null, empty and wordless texts, of documents or items, match nothing.
    Repeated documents or items and null ids have rows of their own.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], FOUND)
    for items in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                rows = []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for item, (s, at, n) in sorted(shared.value.matches(word_hashes(text)).items()):
                        rows.append((doc, shared.value.ids[item], s, at, n))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=[x.split()[0] for x in FOUND.split(", ")])

        out = out.unionByName(texts(docs, id_col, text_col).mapInArrow(run, FOUND))
    return out


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in which no benchmark item is found stay, with all their columns; no shuffle."""
    at = docs.columns.index("text")
    for items in item_blocks(table(spark, sf_dir, "benchmark")):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                yield b.filter(pa.array([not shared.value.matches(word_hashes(t)) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_decontamination": op1_decontamination}
_SQL_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '(?:[a-z0-9]|[^\x00-\x7F])+')"

#: All windows that share a shingle, without fingerprints.
ORACLE = {
    "op1_decontamination": f"""
WITH items AS (SELECT item_id, w, len(w) AS n, least({SHINGLE}, len(w)) AS width FROM (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
docs AS (SELECT doc_id, width, w, len(w) - width + 1 AS n FROM (SELECT doc_id, {_SQL_WORDS} AS w FROM documents), (SELECT DISTINCT width FROM items) WHERE len(w) >= width),
d AS (SELECT doc_id, width, n, i, array_to_string(w[i + 1 : i + width], ' ') AS s FROM (SELECT *, unnest(range(n)) AS i FROM docs)),
bags AS (SELECT item_id, n, width, s, count(*) AS c FROM (
  SELECT item_id, n, width, array_to_string(w[i + 1 : i + width], ' ') AS s FROM (SELECT *, unnest(range(n - width + 1)) AS i FROM items)) GROUP BY ALL),
hits AS (SELECT d.doc_id, d.width, b.item_id, d.i, least(b.n - b.width + 1, d.n) AS span, b.n - b.width + 1 AS total, d.n AS held
  FROM d JOIN bags b ON d.width = b.width AND d.s = b.s),
starts AS (SELECT DISTINCT doc_id, width, item_id, span, total,
  unnest(range(greatest(i - span + 1, 0), least(i, held - span) + 1)) AS start FROM hits),
shared AS (SELECT doc_id, width, item_id, span, total, start, s, count(*) AS c FROM starts JOIN d USING (doc_id, width)
  WHERE i BETWEEN start AND start + span - 1 GROUP BY ALL),
scored AS (SELECT doc_id, item_id, start, least / (span + total - least) AS similarity FROM (
  SELECT doc_id, item_id, start, span, total, sum(least(a.c, b.c))::bigint AS least
  FROM shared a JOIN bags b USING (item_id, width, s) GROUP BY ALL))
SELECT doc_id, item_id, max(similarity) AS similarity, arg_min(start, (-similarity, start))::bigint AS first_word, count(*) AS windows
FROM scored WHERE similarity >= {SIMILARITY} GROUP BY doc_id, item_id"""
}
