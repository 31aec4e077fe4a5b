"""SimHash near-duplicates: blocked candidates, bit-sliced distances, connected components.

A fingerprint bit is 1 if it is set in more than half of the XXH64 values (seed 42)
of a text's word shingles, repeats counted.  Two texts are linked if their
fingerprints differ in at most ``radius`` bits.

Candidates: 64 bits are cut into radius + 2 blocks, of which any linked pair agrees
on at least two, so every pair of blocks is a key.  Fingerprints that share a key
lie in one sorted partition and are compared there with their bits stored as
planes: one XOR per plane updates the distances of a whole block of lanes, held in
carry-save counters, and a block is left as soon as every lane exceeds the radius.
Each key group passes on a spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import binary_values, free_name, long_array, slices, stage, texts
from accesslens.llm.components import components

SEED = 42
SHINGLE_WORDS = 3
RADIUS = 2
#: Distinct fingerprints under one key above which the key is made longer.
HOT_KEY = 4096
#: Lanes whose distances are counted together.
LANES = 8192
#: Groups up to this size are compared by shifting the sorted table.
SHIFTS = 32
_SLAB = 1 << 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text; no words give 0."""
    tokens = text.lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    width = min(words, len(tokens))
    starts = (ends - sizes)[: len(tokens) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(starts), _SLAB):
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[lo : lo + _SLAB], ends[lo : lo + _SLAB])])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fingerprints as signed longs, one row per input row, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.array([fingerprint(x, words) for x in binary_values(b.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), long_array(fps.view(np.int64))], names=["doc_id", "fp"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes, 64 x ceil(n / 64) words; lane i is bit i of a row."""
    n = len(fps)
    bits = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)
    padded = np.zeros((64, -(-n // 64) * 64), dtype=np.uint8)
    padded[:, :n] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def lanes_of(mask: np.ndarray) -> np.ndarray:
    """Lanes set in a row of words."""
    return np.flatnonzero(np.unpackbits(mask.view(np.uint8), bitorder="little"))


def all_lanes(n: int) -> np.ndarray:
    bits = np.zeros(-(-n // 64) * 64, dtype=np.uint8)
    bits[:n] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def within(planes: np.ndarray, query: int, radius: int, alive: np.ndarray) -> np.ndarray:
    """Lanes of ``alive`` whose planes differ from the query in at most ``radius`` bits.

    ``more[k]`` holds the lanes with over k differing bits so far; each plane is carried
    into it.  Once every lane alive has over ``radius``, the other planes are left out.
    """
    more = np.zeros((radius + 1, planes.shape[1]), dtype=np.uint64)
    for k in range(64):
        carry = ~planes[k] if query >> (63 - k) & 1 else planes[k]
        for i in range(radius):
            carry, more[i] = carry & more[i], more[i] | carry
        more[radius] |= carry
        if k & 1 and k > radius and not (alive & ~more[radius]).any():
            return np.zeros_like(alive)
    return alive & ~more[radius]


def _pairs_within(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Positions i with a[i] and b[i] linked; a lane is a pair, compared with the query 0."""
    out = [np.empty(0, dtype=np.int64)]
    for lo in range(0, len(a), LANES):
        x = a[lo : lo + LANES] ^ b[lo : lo + LANES]
        out.append(lo + lanes_of(within(planes_of(x), 0, radius, all_lanes(len(x)))))
    return np.concatenate(out)


def _least_labels(n: int, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row."""
    label = np.arange(n)
    while len(hi):
        before = label.copy()
        np.minimum.at(label, hi, label[lo])
        np.minimum.at(label, lo, label[hi])
        label = label[label]
        if (label == before).all():
            break
    return label


def _forest_of_large(fps: np.ndarray, radius: int) -> np.ndarray:
    """Local labels of one large group: breadth first, against the lanes not yet reached."""
    n = len(fps)
    label = np.full(n, -1)
    blocks = [(lo, planes_of(fps[lo : lo + LANES]), all_lanes(min(LANES, n - lo))) for lo in range(0, n, LANES)]
    for root in range(n):
        if label[root] >= 0:
            continue
        front, label[root] = [root], root
        blocks[root // LANES][2][root % LANES // 64] &= ~np.uint64(1 << root % 64)
        while front:
            q = int(fps[front.pop()])
            for lo, planes, alive in blocks:
                if alive.any():
                    near = within(planes, q, radius, alive)
                    alive &= ~near
                    found = lo + lanes_of(near)
                    label[found] = root
                    front.extend(found.tolist())
    return label


def forest(keys: np.ndarray, fps: np.ndarray, nodes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) of the key groups of a sorted table; nodes ascend within a key."""
    n = len(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[first, n])
    group = np.repeat(np.arange(len(first)), size)
    small = size[group] <= SHIFTS
    his, los = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for d in range(1, min(SHIFTS, int(size.max()))):
        i = np.flatnonzero(small[d:] & (group[d:] == group[:-d]))
        if len(i):
            i = i[_pairs_within(fps[i + d], fps[i], radius)]
            his.append(i + d)
            los.append(i)
    label = _least_labels(n, np.concatenate(his), np.concatenate(los))
    for g in np.flatnonzero(size > SHIFTS):
        lo, hi = first[g], first[g] + size[g]
        label[lo:hi] = lo + _forest_of_large(fps[lo:hi], radius)
    linked = label != np.arange(n)
    return nodes[linked], nodes[label[linked]]


def _block(i: int, blocks: int) -> tuple[int, int]:
    """First bit and width of a block."""
    at = [64 * k // blocks for k in range(blocks + 1)]
    return at[i], at[i + 1] - at[i]


def _bits(fp: Column, lo: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, lo).bitwiseAND((1 << width) - 1)


def _keys(fp: Column, radius: int) -> Column:
    """Keys of a fingerprint, one for every two of radius + 2 blocks; equal hashes only add comparisons."""
    blocks = [_bits(fp, *_block(i, radius + 2)) for i in range(radius + 2)]
    return F.array(*[F.xxhash64(F.lit(i), F.lit(j), blocks[i], blocks[j]) for i, j in combinations(range(radius + 2), 2)])


def _longer(key: Column, fp: Column, radius: int, level: int) -> Column:
    """Longer keys for a hot one: radius + 1 parts of a rotated fingerprint, one of which must agree."""
    shift = 7 * level
    rotated = F.shiftleft(fp, shift).bitwiseOR(F.shiftrightunsigned(fp, 64 - shift)) if shift else fp
    parts = [_bits(rotated, *_block(p, radius + 1)) for p in range(radius + 1)]
    return F.array(*[F.xxhash64(key, F.lit(p), part) for p, part in enumerate(parts)])


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) that connect all nodes whose fingerprints differ in at most ``radius`` bits.

    ``distinct``: (node, fp), one row per fingerprint.  Keys with over HOT_KEY
    fingerprints are made longer in up to two steps: of radius + 1 parts of the 64
    bits one must agree, so no link is lost; each step cuts a group that is spread out.
    """
    keyed = distinct.select("node", "fp", F.explode(_keys(F.col("fp"), radius)).alias("key"))
    for level in (0, 1):
        hot = keyed.groupBy("key").count().where(F.col("count") > HOT_KEY).select("key", F.lit(True).alias("hot"))
        if hot.isEmpty():  # as it mostly is; only where not, the counts are made again
            break
        marked = keyed.join(hot, "key", "left")
        key = F.when(F.col("hot"), _longer(F.col("key"), F.col("fp"), radius, level)).otherwise(F.array("key"))
        keyed = marked.select("node", "fp", F.explode(key).alias("key"))
    rows = keyed.select("key", "node", "fp").repartition("key").sortWithinPartitions("key", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        names = ["u", "v"]

        def edges(part):
            u, v = forest(part[0], part[2].view(np.uint64), part[1], radius)
            return pa.RecordBatch.from_arrays([long_array(u), long_array(v)], names=names)

        for b in batches:
            now = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            if not now.shape[1]:
                continue
            held.append(now)
            if held[0][0, 0] == now[0, -1]:
                continue  # one key so far
            whole = np.concatenate(held, axis=1)
            cut = np.searchsorted(whole[0], whole[0, -1])  # the last key may go on
            held = [whole[:, cut:]]
            yield edges(whole[:, :cut])
        if held:
            yield edges(np.concatenate(held, axis=1))

    return rows.mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) per input row; the component is the smallest doc_id reachable.

    Null and empty texts have fingerprint 0 and link like any other.  Repeated rows and
    equal texts share a fingerprint, are compared once, and each keep a row.  A null
    doc_id gets the component of its fingerprint but can name none (null if there is no other).
    Empty tables give empty results; other columns are not read.
    """
    prints = stage(fingerprints(docs, words, id_col, text_col), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("node"))
    classes = stage(classes.where("node is not null"), "fingerprint-classes")
    found = components(links(classes, radius))
    named = classes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op5_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def _repeats(docs: DataFrame) -> bool:
    """Whether a doc_id occurs on several rows."""
    return not docs.groupBy("doc_id").count().where("count > 1").isEmpty()


def dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one whose doc_id names it, once.

    Rows with a null doc_id stay if no document has their fingerprint.  Null and empty texts, and others without
    words, are one component; very long texts are read whole; of repeated rows one stays.  Other columns pass as they
    are, whatever their names.  An empty table stays empty.
    """
    mark = free_name(docs, "_kept")
    found = near_duplicates(docs).where("doc_id = component_id or component_id is null")
    keep = found.select(F.col("doc_id").alias(mark)).distinct()
    kept = docs.join(keep, F.col("doc_id").eqNullSafe(F.col(mark)), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]) if _repeats(docs) else kept


QUERIES = {"op5_simhash_dedup": op5_simhash_dedup}
ORACLE: dict[str, str] = {}
