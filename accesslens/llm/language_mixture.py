"""Language identification as inference of a mixture.

Each language has an n-gram model.  A document's words are taken as drawn from several
languages; expectation-maximisation estimates their proportions from the words' n-gram
likelihoods.  Of the nested sets of its strongest languages the document gets the one
with the best penalised likelihood, and of those the language with the largest proportion.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import CHUNK_BYTES, chunks, crc_mod, slices, table, texts
from accesslens.llm.packing import pack, unpack

#: Bound of the training sample: documents for each language.  All languages are learned, at 0.25 MB each.
TRAIN_DOCS = 1500
#: Bytes of a gram and cells that grams are hashed to.
GRAM = 3
CELLS = 1 << 16
SMOOTHING = 0.2
STEPS = 12
#: A further language must gain this many times the log of the number of words.
PENALTY = 2.0
UNKNOWN = "und"

#: Bytes that are no letters become blanks; bytes of other than ASCII characters count as letters.
_BLANKED = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def _blanked(text: str) -> bytes:
    return b" " + text.lower().encode().translate(_BLANKED) + b" "


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the grams around each letter, and where the words begin among them."""
    at = np.flatnonzero(data[1:-1] != 0x20) + 1
    x = data.astype(np.uint32)
    key = (x[at - 1] << np.uint32(16)) | (x[at] << np.uint32(8)) | x[at + 1]
    cells = (key * np.uint32(0x9E3779B1)) >> np.uint32(16)
    words = np.flatnonzero(data[at - 1] == 0x20)
    return cells, words


def _slabs(data: bytes) -> Iterator[bytes]:
    """Pieces cut at blanks, each with a blank at both ends."""
    lo = 0
    while lo < len(data) - 1:
        hi = len(data) if len(data) - lo <= CHUNK_BYTES else data.find(b" ", lo + CHUNK_BYTES) + 1
        yield data[lo:hi]
        lo = hi - 1


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # log probability, cells x languages, as float32

    def words(self, data: bytes) -> np.ndarray:
        """Log likelihoods of the words of blanked text, words x languages."""
        out = [np.empty((0, len(self.languages)), dtype=np.float32)]
        for piece in _slabs(data):
            cells, words = _grams(np.frombuffer(piece, np.uint8))
            if len(words):
                out.append(np.add.reduceat(self.logs[cells], words, axis=0))
        return np.concatenate(out)


def _em(e: np.ndarray, first: np.ndarray, n: np.ndarray, start: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Proportions, documents x languages, from likelihoods e relative to a word's best; 0 stays 0."""
    share = start
    for _ in range(steps):
        r = e * np.repeat(share, n, axis=0)
        r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-30)
        share = np.add.reduceat(r, first, axis=0) / n[:, None]
    return share


def _gain(e: np.ndarray, first: np.ndarray, n: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Log likelihood of each document, less that of every word in its best language."""
    return np.add.reduceat(np.log(np.maximum((e * np.repeat(share, n, axis=0)).sum(axis=1), 1e-30)), first)


def proportions(logs: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Proportions of documents of n > 0 words each, in the chosen set of languages."""
    k = logs.shape[1]
    first = np.cumsum(n) - n
    e = np.exp(logs - logs.max(axis=1, keepdims=True)).astype(np.float64)
    whole = np.add.reduceat(logs.astype(np.float64), first, axis=0)
    best = whole.argmax(axis=1)
    chosen = np.zeros((len(n), k))
    chosen[np.arange(len(n)), best] = 1
    if k == 1:
        return chosen
    free = _em(e, first, n, np.full((len(n), k), 1 / k))
    top = whole.max(axis=1) - np.add.reduceat(logs.max(axis=1).astype(np.float64), first)
    cost = PENALTY * np.log(n + 1)
    open_ = np.flatnonzero(_gain(e, first, n, free) - top > cost)  # no set can gain more than all
    rank = np.argsort(-free, axis=1, kind="stable")
    for size in range(2, k + 1):
        if not len(open_):
            break
        words = np.repeat(np.isin(np.arange(len(n)), open_), n)
        some, m = e[words], n[open_]
        at = np.cumsum(m) - m
        start = np.zeros((len(open_), k))
        np.put_along_axis(start, rank[open_, :size], 1 / size, axis=1)
        share = _em(some, at, m, start)
        value = _gain(some, at, m, share) - cost[open_] * (size - 1)
        better = value > top[open_]
        chosen[open_[better]] = share[better]
        top[open_[better]] = value[better]
        open_ = open_[better]  # sets are nested: without a gain here, larger ones are left
    return chosen


def _counts_of(group: pa.Table) -> pa.Table:
    counts = np.zeros(CELLS, dtype=np.int64)
    for text in group.column("text").to_pylist():
        for piece in _slabs(_blanked(text)):
            counts += np.bincount(_grams(np.frombuffer(piece, np.uint8))[0], minlength=CELLS)
    return pa.table({"lang": pa.array([group.column("lang")[0].as_py()]), "counts": pa.array([pack(counts)], pa.binary())})


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Models of the languages of rows outside the held-out third, each from at most ``train_docs`` documents.

    Documents are taken by the hash of their id.  Rows with a null id, text or language are left out; so are
    languages without any letter in the sample.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("lang is not null and text is not null").where(crc_mod("doc_id", 3) != 1)
    found = rows.groupBy("lang").count().collect()  # a row for each language
    if not found:
        return Model([], np.zeros((CELLS, 0), dtype=np.float32))
    scale = 1 << 20
    rate = {r["lang"]: min(scale, 2 * scale * train_docs // r["count"] + 1) for r in found}
    limits = F.create_map(*[x for lang, n in rate.items() for x in (F.lit(lang), F.lit(n))])
    hashed = F.xxhash64("doc_id")
    sample = rows.where(F.pmod(hashed, F.lit(scale)) < limits[F.col("lang")])  # about twice the bound
    place = F.row_number().over(Window.partitionBy("lang").orderBy(hashed, "doc_id", "text"))
    sample = sample.withColumn("place", place).where(F.col("place") <= train_docs).drop("place")
    got = sample.groupBy("lang").applyInArrow(_counts_of, "lang string, counts binary").collect()
    counts = {r["lang"]: unpack(r["counts"], np.int64) for r in got}
    languages = sorted(lang for lang, c in counts.items() if c.any())
    if not languages:
        return Model([], np.zeros((CELLS, 0), dtype=np.float32))
    logs = np.empty((CELLS, len(languages)), dtype=np.float32)
    for i, x in enumerate(languages):
        p = counts.pop(x) + SMOOTHING
        logs[:, i] = np.log(p / p.sum())
    return Model(languages, logs)


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, mixture string"


def _predict(model: Model, values: list[str | None]) -> list[tuple[str, float, str]]:
    out: list[tuple[str, float, str]] = [(UNKNOWN, 0.0, "")] * len(values)
    rows = [i for i, t in enumerate(values) if model.languages and t and _LETTER.search(t)]
    data = [_blanked(values[i]) for i in rows]
    limit = max(1 << 16, CHUNK_BYTES * 4 // max(1, len(model.languages)))
    for lo, hi in chunks([len(x) for x in data], limit):
        logs = [model.words(x) for x in data[lo:hi]]
        n = np.array([len(x) for x in logs])
        share = proportions(np.concatenate(logs), n)
        smooth = (n[:, None] * share + 0.5) / (n[:, None] + 0.5 * share.shape[1])
        for i, s, m in zip(rows[lo:hi], share, smooth):
            best = int(s.argmax())
            mixture = ",".join(f"{model.languages[j]}:{s[j]:.3f}" for j in np.argsort(-s, kind="stable") if s[j] >= 0.0005)
            out[i] = (model.languages[best], float(m[best]), mixture)
    return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, mixture) for every input row, from its text alone.

    A null text, one without a letter, and any text where no language was learned is ``und`` with
    score 0 and no mixture.  Ties go to the first language by name.  Score: the smoothed proportion of
    the language named.  Repeated rows get a row each; held_out is null for a null doc_id.  An empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = _predict(shared.value, b.column(1).to_pylist())
            arrays = [b.column(0), b.column(2), pa.array([x[0] for x in got], pa.string())]
            arrays += [pa.array([x[1] for x in got], pa.float64()), pa.array([x[2] for x in got], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in PREDICTED.split(", ")])

    rows = texts(docs, id_col, text_col).withColumn("held_out", crc_mod("doc_id", 3) == 1)
    return rows.mapInArrow(run, PREDICTED)


def op7_language_mixture(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


QUERIES = {"op7_language_mixture": op7_language_mixture}
ORACLE: dict[str, str] = {}
