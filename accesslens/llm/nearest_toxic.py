"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

All labelled examples and all their words are in the index.  A word weighs its count times
its inverse document frequency over all documents, times how strongly the labels of the examples tie it
to either label (a likelihood ratio; a word without any tie keeps the factor 1, none has 0).  Words
that no example holds count in a text's length only.  Every text is cut into words once; term numbers and counts
are kept packed for frequencies and scores alike.  The most frequent words lie in a
dense matrix, multiplied for many texts at once in 32 bits and again in 64 for what comes close; the others in postings by block of examples, whose
largest weights bound the cosine there: blocks whose bound is under the k-th best are skipped.
Votes weigh by 1 / distance and a logistic curve, fitted on the examples with each left out of
its own vote, turns them into probabilities.
"""

from __future__ import annotations

import math
import pickle
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from accesslens.llm.common import crc_mod, slices, stage, table, texts

#: Bound of the sample of labelled rows: those with the smallest hashes.
EXAMPLES = 8000
#: Likelihood ratio that a word without a tie to the labels stays under in 95 of 100 cases.
CHANCE = 3.84
NEIGHBOURS = 15
BLOCK = 512
#: Most frequent words, kept as dense rows.
DENSE = 512
#: Texts that are multiplied together, that go through the blocks together, and examples that vote together.
TOGETHER, BATCH, VOTE_ROWS = 256, 32, 256
#: What 32-bit products and bounds may be off by; what lies within is measured in 64 bits.
SLACK = 2e-5
#: Neighbours and terms named as evidence.
EVIDENCE = 3
_PIECE = 1 << 20
_WORD = re.compile(r"\w+")
_CUT = re.compile(r"\W")


def words_of(text: str | None) -> list[str]:
    """Lower-case words; long texts are read in pieces cut between words."""
    text = text or ""
    if len(text) <= _PIECE:
        return _WORD.findall(text.lower())
    words: list[str] = []
    lo = 0
    while lo < len(text):
        m = _CUT.search(text, lo + _PIECE)
        hi = m.start() if m else len(text)
        words += map(sys.intern, _WORD.findall(text[lo:hi].lower()))
        lo = hi
    return words


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, examples, toxic) of the examples (toxic, text) of a task: how many hold a term, and how many of those are toxic."""
    held: dict[str, list[int]] = {}
    for b in slices(batches, 64):
        for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for t in set(words_of(text)):
                at = held.setdefault(t, [0, 0])
                at[0] += 1
                at[1] += toxic
    arrays = [pa.array(list(held), pa.string()), *[pa.array([x[i] for x in held.values()], pa.int64()) for i in (0, 1)]]
    yield pa.RecordBatch.from_arrays(arrays, names=["term", "examples", "toxic"])


def numbered(counts: Counter, number: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the terms a text holds, rising, and how often it does."""
    t = np.fromiter(map(number.get, counts, repeat(-1)), np.int32, len(counts))
    c = np.fromiter(counts.values(), np.int32, len(counts))
    some = t >= 0
    t, c = t[some], c[some]
    by = np.argsort(t)
    return t[by], c[by]


def _pack_counts(words: int, t: np.ndarray, c: np.ndarray) -> bytes:
    x = np.empty(1 + 2 * len(t), dtype=np.int32)
    x[0], x[1 : len(t) + 1], x[len(t) + 1 :] = words, t, c
    x[2 : len(t) + 1] -= t[:-1]
    return x.view(np.uint8).reshape(-1, 4).T.tobytes()  # bytes of equal weight together: the table is compressed as a whole


def unpack_counts(packed: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, terms and counts of a text."""
    x = np.ascontiguousarray(np.frombuffer(packed, dtype=np.uint8).reshape(4, -1).T).view(np.int32).reshape(-1)
    n = len(x) // 2
    return int(x[0]), np.cumsum(x[1 : n + 1]), x[n + 1 :]


def counted(docs: DataFrame, names: list[str], out: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all if not given) and ``out``: the words of each text, counted by term number and packed."""
    shared = docs.sparkSession.sparkContext.broadcast({x: i for i, x in enumerate(names)})
    keep = docs.columns if keep is None else keep
    at, text_at = [docs.columns.index(c) for c in keep], docs.columns.index(text_col)
    schema = StructType([StructField(c, docs.schema[i].dataType) for c, i in zip(keep, at)] + [StructField(out, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for b in slices(batches):
            packed = []
            for text in b.column(text_at).to_pylist():
                counts = Counter(words_of(text))
                packed.append(_pack_counts(counts.total(), *numbered(counts, number)))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in at], pa.array(packed, pa.binary())], names=[*keep, out])

    return docs.mapInArrow(run, schema)


def _ratio(a: np.ndarray, b: np.ndarray, n: int, positive: int) -> np.ndarray:
    """Log-likelihood ratio of terms in b of n examples, a of them toxic; 0 if the examples have one label only."""
    if positive in (0, n):
        return np.zeros(len(b))

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-300)), 0.0)

    p, q = positive / n, 1 - positive / n
    return np.maximum(2 * (part(a, b * p) + part(b - a, b * q) + part(positive - a, (n - b) * p) + part(n - positive - b + a, (n - b) * q)), 0)


@dataclass
class Index:
    """Unit vectors of the examples, by example and as postings by (term, block), and what scoring needs besides."""

    idf: np.ndarray  # weight of one occurrence
    other: float  # weight of an occurrence of any word that is no term
    ids: np.ndarray
    toxic: np.ndarray
    rest: np.ndarray  # weight of such words in each example
    begin: np.ndarray  # terms and weights of an example: held[begin[example]], held_weight
    held: np.ndarray
    held_weight: np.ndarray
    start: np.ndarray  # postings of (term, block): start[term * blocks + block]
    row: np.ndarray
    weight: np.ndarray
    bound: np.ndarray  # largest weight by (term, block); the last term is the other words
    dense: np.ndarray  # weights of frequent terms by (example, slot)
    slot: np.ndarray  # slot of a term, -1 if it is not dense
    prior: float  # toxic share of examples without any word
    names: list[str]
    packed: bytes  # what all of this is made from
    slope: float = 1.0
    shift: float = 0.0

    def __reduce__(self):
        """Tasks are sent the counts, a tenth of the size, and make the rest from them."""
        return _unpacked, (self.packed, self.slope, self.shift)

    @property
    def blocks(self) -> int:
        return -(-len(self.ids) // BLOCK)

    @cached_property
    def dense32(self) -> np.ndarray:
        """``dense`` by (slot, example), with room for whole blocks of examples."""
        out = np.zeros((self.dense.shape[1], self.blocks * BLOCK), dtype=np.float32)
        out[:, : len(self.ids)] = self.dense.T
        return out

    @cached_property
    def terms(self) -> dict[str, int]:
        return {x: i for i, x in enumerate(self.names)}

    def vector(self, terms: Counter, words: int) -> tuple[np.ndarray, np.ndarray, float] | None:
        """Terms, unit weights and the weight of the other words; None without a term of the index."""
        return self.weighed(words, *numbered(terms, self.terms))

    def weighed(self, words: int, t: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, float] | None:
        """``vector`` from term numbers and counts."""
        if not len(t):
            return None
        w = c * self.idf[t]
        rest = max(words - int(c.sum()), 0) * self.other**2
        norm = math.sqrt(float(w @ w) + rest)
        return t, w / norm, math.sqrt(rest) / norm

    def nearest(self, vector, k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k nearest examples, ties to the smaller row; exact."""
        return next(self.nearest_of([vector], k, [without]))

    def nearest_of(self, vectors: list, k: int = NEIGHBOURS, without: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` for each vector; a batch of them goes through the blocks at once."""
        for lo in range(0, len(vectors), TOGETHER):
            some = vectors[lo : lo + TOGETHER]
            part = np.zeros((len(some), self.dense.shape[1]))
            for row, (t, w, _) in zip(part, some):
                slots = self.slot[t]
                row[slots[slots >= 0]] = w[slots >= 0]
            got = part.astype(np.float32) @ self.dense32  # in 32 bits, to choose by
            for i in range(0, len(some), BATCH):
                own = slice(i, i + BATCH)
                yield from self._nearest(some[own], part[own], got[own], k, without[lo + i : lo + i + BATCH] if without else None)

    def _nearest(self, vectors: list, part: np.ndarray, got: np.ndarray, k: int, without: list[int] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``part``: weights of the dense terms; ``got``: their products with all examples, which is changed."""
        m, n, blocks = len(vectors), len(self.ids), self.blocks
        left = np.array([n - (without is not None and without[i] >= 0) for i in range(m)])
        want = min(k, int(left.max(initial=0)))
        if want < 1:
            yield from ((np.empty(0, dtype=np.int64), np.empty(0)) for _ in range(m))
            return
        count = np.array([len(v[0]) for v in vectors])
        doc, t, w = np.repeat(np.arange(m), count), np.concatenate([v[0] for v in vectors]), np.concatenate([v[1] for v in vectors])
        rest = np.array([v[2] for v in vectors])
        slot = self.slot[t]
        got[:, n:] = -np.inf
        got[:, :n] += rest.astype(np.float32)[:, None] * self.rest.astype(np.float32)
        if without is not None:
            out = np.array(without)
            got[np.flatnonzero(out >= 0), out[out >= 0]] = -np.inf
        rare = slot < 0
        doc, t, w = doc[rare], t[rare], w[rare]
        by_block = got.reshape(m, blocks, BLOCK)
        bounds = by_block.max(axis=2)
        firsts = np.flatnonzero(np.diff(doc, prepend=-1))
        if len(firsts):
            bounds[doc[firsts]] += np.add.reduceat(w[:, None] * self.bound[t], firsts, axis=0)
        order = np.argsort(-bounds, axis=1, kind="stable")
        exact = np.zeros((m, n))  # products of the terms that are not dense, in 64 bits
        seen = np.zeros((m, blocks), dtype=bool)
        top = np.full((m, want), -np.inf, dtype=np.float32)
        floor = np.full(m, -np.inf)  # under the k-th best
        at, size = 0, -(-want // BLOCK) + 1  # blocks that hold as many rows as are wanted, though one may be short
        while at < blocks:
            some = order[:, at : at + size]
            taken = np.take_along_axis(bounds, some, axis=1) >= floor[:, None]
            who, which = np.nonzero(taken)
            if not len(who):
                break
            held = some[who, which]
            more = self._rare((doc, t, m), w, who * blocks + held)
            exact += more
            got[:, :n] += more
            seen[who, held] = True
            new = np.take_along_axis(by_block, some[:, :, None], axis=1)
            new[~taken] = -np.inf
            top = np.concatenate([top, new.reshape(m, -1)], axis=1)
            top = np.partition(top, top.shape[1] - want, axis=1)[:, -want:]
            floor = top.min(axis=1).astype(float) - SLACK
            at, size = at + size, 3 * size
        by_block[~seen] = -np.inf
        who, rows = np.nonzero((got >= floor[:, None]) & (got > -np.inf))
        cosines = exact[who, rows] + rest[who] * self.rest[rows] + np.einsum("ij,ij->i", self.dense[rows], part[who])
        ends = np.searchsorted(who, np.arange(m + 1))
        for lo, hi in zip(ends, ends[1:]):
            best, near = rows[lo:hi], cosines[lo:hi]
            first = np.lexsort((best, -np.round(near, 12)))[:k]
            yield best[first], near[first]

    def _rare(self, terms: tuple, w: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Products of texts with the examples of some blocks, from the postings there: terms that are not dense, each with its text.

        ``blocks`` are texts and blocks as text * number of blocks + block.
        """
        doc, t, m = terms
        n = len(self.ids)
        count = np.bincount(doc, minlength=m)
        begin = np.cumsum(count) - count
        who = blocks // self.blocks
        size = count[who]
        i = np.arange(size.sum()) + np.repeat(begin[who] - np.cumsum(size) + size, size)
        cells = t[i].astype(np.int64) * self.blocks + np.repeat(blocks % self.blocks, size)
        first = self.start[cells]
        held = self.start[cells + 1] - first
        some = held > 0
        i, first, held, to = i[some], first[some], held[some], np.repeat(who * n, size)[some]
        j = np.arange(held.sum()) + np.repeat(first - np.cumsum(held) + held, held)
        return np.bincount(np.repeat(to, held) + self.row[j], self.weight[j] * np.repeat(w[i], held), m * n).reshape(m, n)

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        if not len(rows):
            return self.prior
        w = 1 / (1.0001 - np.minimum(cosines, 1))
        return float((w * self.toxic[rows]).sum() / w.sum())

    def score_of(self, texts: list[str | None]) -> list[tuple[float, list[int], list[str]]]:
        """For each text: probability, doc_ids of the nearest examples, and its strongest terms."""
        counts = [Counter(words_of(t)) for t in texts]
        return self.score_counts([(c.total(), *numbered(c, self.terms)) for c in counts])

    def score_counts(self, counts: list[tuple[int, np.ndarray, np.ndarray]]) -> list[tuple[float, list[int], list[str]]]:
        """``score_of`` from (words, term numbers, counts)."""
        vectors = [self.weighed(*c) for c in counts]
        found = self.nearest_of([v for v in vectors if v])
        out = []
        for v in vectors:
            if v is None:
                out.append((self.prior, [], []))
                continue
            rows, cosines = next(found)
            p = 1 / (1 + math.exp(-(self.slope * _logit(self.vote(rows, cosines)) + self.shift)))
            strongest = np.lexsort((-v[0], -v[1]))[:EVIDENCE]
            out.append((p, self.ids[rows[:EVIDENCE]].tolist(), [self.names[i] for i in v[0][strongest]]))
        return out

    def score(self, text: str | None) -> tuple[float, list[int], list[str]]:
        return self.score_of([text])[0]

    def left_out_votes(self, lo: int, hi: int) -> list[float]:
        """Votes on the examples lo to hi, each without its own."""
        own = [slice(self.begin[i], self.begin[i + 1]) for i in range(lo, hi)]
        vectors = [(self.held[x].astype(np.int64), self.held_weight[x], float(self.rest[i])) for i, x in zip(range(lo, hi), own)]
        return [self.vote(*found) for found in self.nearest_of(vectors, without=list(range(lo, hi)))]


def _logit(p: float) -> float:
    p = min(max(p, 0.005), 0.995)
    return math.log(p / (1 - p))


def _calibrate(votes: list[float], toxic: list[int]) -> tuple[float, float]:
    """Slope and shift of a logistic curve through (logit of vote, label), by Newton steps with a weak prior at (1, 0)."""
    x, y = np.array([_logit(v) for v in votes]), np.array(toxic, dtype=float)
    design = np.stack([x, np.ones_like(x)], axis=1)
    centre = np.array([1.0, 0.0])

    def loss(theta: np.ndarray) -> float:
        z = design @ theta
        return float((np.logaddexp(0, z) - y * z).sum() + ((theta - centre) ** 2).sum() / 2)

    theta, now = centre, loss(centre)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -500, 500)))
        grad = design.T @ (p - y) + (theta - centre)
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2)
        step = np.linalg.solve(hess, grad)
        while loss(theta - step) > now and np.abs(step).max() > 1e-12:
            step = step / 2
        if np.abs(step).max() <= 1e-12:
            break
        theta = theta - step
        now = loss(theta)
    return max(float(theta[0]), 0.05), float(theta[1])


def build(terms: dict[str, tuple[int, float]], examples: list[tuple[int, int, int, list[tuple[str, int]]]], other: float = 1.0) -> Index:
    """Index of (doc_id, toxic, words, [(term, count)]); ``terms``: term -> (number, weight)."""
    names = sorted(terms, key=lambda t: terms[t][0])
    head = [np.array([e[i] for e in examples], dtype=np.int64) for i in range(3)]
    sizes = [len(e[3]) for e in examples]
    t = np.array([terms[x][0] for e in examples for x, _ in e[3]], dtype=np.int64)
    c = np.array([x for e in examples for _, x in e[3]], dtype=float)
    packed, toxic = _ordered(names, np.array([terms[x][1] for x in names]), other, *head, np.repeat(np.arange(len(examples)), sizes), t, c)
    index = _unpacked(packed)
    if len(toxic):
        index.slope, index.shift = _calibrate(index.left_out_votes(0, len(toxic)), toxic)
    return index


def _unpacked(packed: bytes, slope: float = 1.0, shift: float = 0.0) -> Index:
    """Index from its pickled and deflated parts; the terms of the examples follow one another."""
    names, idf, other, ids, toxic, words, size, t, c, prior = pickle.loads(zlib.decompress(packed))
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    begin = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    row = np.repeat(np.arange(n, dtype=np.int32), size)
    others = np.maximum(words - np.bincount(row, c, n), 0) * other**2
    weight = c * idf[t]
    norm = np.sqrt(np.bincount(row, weight * weight, n) + others)
    rest = np.sqrt(others) / norm
    weight /= norm[row]
    held, held_weight = t, weight
    by = np.argsort(t, kind="stable")
    t, row, weight = t[by], row[by], weight[by]
    cell = t.astype(np.int64) * blocks + row // BLOCK
    start = np.concatenate([[0], np.cumsum(np.bincount(cell, minlength=len(names) * blocks))]).astype(np.int32)
    bound = np.zeros((len(names) + 1, blocks), dtype=np.float32)
    np.maximum.at(bound.reshape(-1), cell, weight.astype(np.float32))
    np.maximum.at(bound[-1], np.arange(n) // BLOCK, rest.astype(np.float32))
    frequent = np.argsort(-np.bincount(t, minlength=len(names)), kind="stable")[:DENSE]
    slot = np.full(len(names), -1, dtype=np.int32)
    slot[frequent] = np.arange(len(frequent))
    dense = np.zeros((n, len(frequent)))
    inside = slot[t] >= 0
    dense[row[inside], slot[t[inside]]] = weight[inside]
    return Index(idf, other, ids, toxic, rest, begin, held, held_weight, start, row, weight, bound, dense, slot, prior, names, packed, slope, shift)


def _ordered(names: list[str], idf: np.ndarray, other: float, ids: np.ndarray, toxic: np.ndarray, words: np.ndarray, at: np.ndarray, t: np.ndarray, c: np.ndarray) -> tuple[bytes, list[int]]:
    """What an index is made from, packed, and the labels in its order; example ``at`` holds term ``t`` ``c`` times."""
    size = np.bincount(at, minlength=len(ids))
    empty = size == 0
    prior = (int(toxic[empty].sum()) + 0.5) / (int(empty.sum()) + 10)
    # examples with the same strongest term share blocks: bounds are tight
    w = c * idf[t]
    by = np.lexsort((t, -w, at))
    strongest, most = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids))
    at_first = by[np.flatnonzero(np.diff(at[by], prepend=-1))]
    strongest[at[at_first]], most[at[at_first]] = t[at_first], w[at_first]
    full = np.lexsort((ids, -most, strongest))
    full = full[~empty[full]]
    new = np.full(len(ids), -1, dtype=np.int32)
    new[full] = np.arange(len(full))
    by = np.lexsort((t, new[at]))
    parts = (names, idf, other, ids[full], toxic[full], words[full], size[full], t[by].astype(np.int32), c[by].astype(np.int32), prior)
    return zlib.compress(pickle.dumps(parts), 1), toxic[full].tolist()


@dataclass
class Model:
    """An index as it travels: tasks unpack it, the driver does not."""

    packed: bytes
    slope: float = 1.0
    shift: float = 0.0

    @cached_property
    def index(self) -> Index:
        return _unpacked(self.packed, self.slope, self.shift)

    def __reduce__(self):
        return Model, (self.packed, self.slope, self.shift)


def _votes(spark: SparkSession, model: Model, n: int) -> list[float]:
    """Left-out votes of all examples, made in tasks; a number an example comes back."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ranges = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            votes = [v for lo, hi in ranges for v in shared.value.index.left_out_votes(lo, hi)]
            rows = [i for lo, hi in ranges for i in range(lo, hi)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(votes, pa.float64())], names=["row", "vote"])

    parts = spark.range(0, n, VOTE_ROWS, numPartitions=-(-n // (4 * VOTE_ROWS)))
    parts = parts.select(F.col("id").alias("lo"), F.least(F.col("id") + VOTE_ROWS, F.lit(n)).alias("hi"))
    found = parts.mapInArrow(run, "row long, vote double").toArrow()
    out = np.empty(n)
    out[found["row"].to_numpy()] = found["vote"].to_numpy()
    return out.tolist()


def _frequencies(packed: DataFrame, column: str, terms: int) -> np.ndarray:
    """Documents that hold each term, and last the documents; a task counts by itself and hands on its sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms + 1, dtype=np.int64)
        for b in slices(batches):
            for x in b.column(0).to_pylist():
                held[unpack_counts(x)[1]] += 1
            held[-1] += b.num_rows
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], names=["term", "docs"])

    sums = packed.select(column).mapInArrow(run, "term int, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).toArrow()
    out = np.zeros(terms + 1)
    out[sums["term"].to_numpy()] = sums["docs"].to_numpy()
    return out


def learn(
    docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> tuple[Model, DataFrame, str]:
    """(model, docs with their counted words, name of that column): every text is cut into words once, for all that follows.

    At most ``examples`` labelled documents are read as such; the held-out fifth of the ids never is.  A doc_id labelled
    twice is toxic if any of its labels is.  Null ids, null labels and labels without a document are left out; of
    repeated documents the one with the smallest text counts.  Document frequencies are those of all documents,
    held-out ones included: they need no label.  The driver holds the examples' distinct words and packed counts.
    """
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
    y = y.where("toxic is not null").where(crc_mod("doc_id", 5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    rows = texts(docs, id_col, text_col).join(F.broadcast(y), "doc_id").select("doc_id", "toxic", "text")
    rows = stage(rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxic-examples")
    terms = rows.select("toxic", "text").mapInArrow(_term_counts, "term string, examples long, toxic long")
    terms = terms.groupBy("term").agg(F.sum("examples").alias("examples"), F.sum("toxic").alias("toxic")).orderBy("term").toArrow()
    names = terms["term"].to_pylist()
    held = counted(rows, names, "counts", keep=["doc_id", "toxic"]).orderBy("doc_id").toArrow()
    ids, toxic = held["doc_id"].to_numpy(), held["toxic"].to_numpy()
    own = [unpack_counts(x) for x in held["counts"].to_pylist()]
    words = np.array([x[0] for x in own], dtype=np.int64)
    at = np.repeat(np.arange(len(own)), [len(x[1]) for x in own])
    t, c = (np.concatenate([np.empty(0, dtype=np.int32), *[x[i] for x in own]]) for i in (1, 2))
    del held, own
    column = "counts"
    while column in docs.columns:
        column += "_"
    cut = stage(counted(docs, names, column, text_col, keep), "toxic-counts")
    if not names:
        return Model(_ordered([], np.zeros(0), 1.0, ids, toxic, words, at, t, c)[0]), cut, column
    *seen, total = _frequencies(cut, column, len(names))
    ratio = _ratio(terms["toxic"].to_numpy(), terms["examples"].to_numpy().astype(float), len(ids), int(toxic.sum()))
    idf = np.log(1 + total / np.maximum(seen, 1)) * (1 + ratio / CHANCE)
    packed, y = _ordered(names, idf, math.log(1 + len(ids)), ids, toxic, words, at, t, c)
    model = Model(packed)
    return Model(packed, *_calibrate(_votes(docs.sparkSession, model, len(y)), y)), cut, column


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index of at most ``examples`` labelled documents, see ``learn``."""
    return learn(texts(docs, id_col, text_col), labels, examples, keep=["doc_id"])[0].index


SCORED = "doc_id long, held_out boolean, score double, predicted int, neighbours array<long>, terms array<string>"


def _scored(cut: DataFrame, column: str, model: Model) -> DataFrame:
    """``SCORED`` rows of (doc_id, counted words)."""
    shared = cut.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value.index
        for b in slices(batches):
            got = index.score_counts([unpack_counts(x) for x in b.column(1).to_pylist()])
            p = [x[0] for x in got]
            arrays = [b.column(0), b.column(2), pa.array(p, pa.float64()), pa.array([int(x >= 0.5) for x in p], pa.int32())]
            arrays += [pa.array([x[1] for x in got], pa.list_(pa.int64())), pa.array([x[2] for x in got], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "score", "predicted", "neighbours", "terms"])

    return cut.select("doc_id", column, (crc_mod("doc_id", 5) == 0).alias("held_out")).mapInArrow(run, SCORED)


def score(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score, decision and evidence for every input row, read from its text alone.

    Null and empty texts, and texts without a word of any example, get the smoothed share of toxic examples
    without words and no evidence.  Very long texts are read in pieces cut between words.  Repeated rows get a
    row each; held_out is null for a null doc_id.  An empty table gives no rows.
    """
    cut = counted(texts(docs, id_col, text_col), index.names, "counts", keep=["doc_id"])
    return _scored(cut, "counts", Model(index.packed, index.slope, index.shift))


def toxicity_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents scored under 0.5 stay, with all their columns; no shuffle.

    Rows are judged one by one: a null or empty text by the share of toxic examples without words, repeated rows and
    null ids each for itself, very long texts whole.  Other columns pass as they are, whatever their names.
    An empty table stays empty.
    """
    model, cut, column = learn(docs, table(spark, sf_dir, "labels"))
    shared = spark.sparkContext.broadcast(model)
    at, n = cut.columns.index(column), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value.index
        for b in slices(batches):
            got = index.score_counts([unpack_counts(x) for x in b.column(at).to_pylist()])
            yield b.select(range(n)).filter(pa.array([x[0] < 0.5 for x in got], pa.bool_()))

    return cut.mapInArrow(run, docs.schema)


def op10_nearest_toxic(spark, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"))
    model, cut, column = learn(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])
    return _scored(cut, column, model)


QUERIES = {"op10_nearest_toxic": op10_nearest_toxic}
ORACLE: dict[str, str] = {}
