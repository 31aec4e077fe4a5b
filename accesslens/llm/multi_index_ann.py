"""Nearest neighbours by inner product with multi-index hashing of learned binary codes.

Codes are the signs of learned rotations.  A code is cut into 16-bit substrings, each indexed.
If two codes differ in at most R bits, some substring differs in at most R // substrings bits, so
probing the buckets within that distance of a query's substrings retrieves every code within R.
What is found is measured in whole codes and then reranked by the inner products of the
original vectors, in double precision.

The index is sharded by rows: each shard holds all substring tables of its rows, and blocks of queries
visit every shard.  Equal vectors are one entry with their smallest ids, as no more of them can be
among the nearest.  Rotations and R are learned on a bounded sample; every row is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import stage, table
from accesslens.llm.packing import PACKED, Rows, rows_of

#: Bound of the sample that rotations and the radius are learned on.
FIT_ROWS = 8192
CODE_BITS = 256
SUBSTRING = 16
ROTATION_STEPS = 15
#: Share of the sample's near pairs that the radius covers.
COVER = 0.97
SHARD_ROWS = 8192
QUERY_BLOCK = 256
NEIGHBOURS = 20
SEED = 7

_WORDS = CODE_BITS // 64
_PARTS = CODE_BITS // SUBSTRING


@dataclass
class Model:
    rotation: np.ndarray  # dimensions + 1, code bits
    largest: float  # norm of the longest vector
    radius: int

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors with a coordinate that makes all equally long: nearest by angle is then largest by product."""
        rest = np.sqrt(np.maximum(self.largest**2 - (x * x).sum(axis=1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def codes(self, lifted: np.ndarray) -> np.ndarray:
        """Codes as substrings, rows x parts of 16 bits."""
        return np.packbits(lifted @ self.rotation > 0, axis=1).view(np.uint16)

    def row_codes(self, x: np.ndarray) -> np.ndarray:
        return self.codes(self.lifted(x))

    def query_codes(self, x: np.ndarray) -> np.ndarray:
        return self.codes(np.concatenate([x, np.zeros((len(x), 1))], axis=1))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of all codes of a and b."""
    a, b = (np.ascontiguousarray(c).view(np.uint64) for c in (a, b))
    out = np.zeros((len(a), len(b)), dtype=np.uint16)
    for k in range(a.shape[1]):
        out += np.bitwise_count(a[:, k, None] ^ b[None, :, k])
    return out


def learn(sample: np.ndarray, largest: float, total: int, neighbours: int = NEIGHBOURS) -> Model:
    """Rotations that bring the sample close to the corners of a cube, and the radius that covers its near pairs."""
    rng = np.random.default_rng(SEED)
    model = Model(np.zeros((sample.shape[1] + 1, CODE_BITS)), largest, CODE_BITS)
    x = model.lifted(sample)
    d = x.shape[1]
    columns = []
    for _ in range(-(-CODE_BITS // d)):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(ROTATION_STEPS):  # iterative quantisation
            u, _, v = np.linalg.svd(np.where(x @ r > 0, 1.0, -1.0).T @ x)
            r = (u @ v).T
        columns.append(r)
    model.rotation = np.concatenate(columns, axis=1)[:, :CODE_BITS]
    rows, asked = model.row_codes(sample), sample[: min(256, len(sample))]
    depth = min(len(sample) - 1, max(1, -(-neighbours * len(sample) // max(total, 1))))
    if depth > 0:
        products = asked @ sample.T
        np.fill_diagonal(products, -np.inf)
        near = np.argsort(-products, axis=1, kind="stable")[:, :depth]
        far = np.take_along_axis(distances(model.query_codes(asked), rows), near, axis=1)
        model.radius = int(np.quantile(far, COVER, method="higher"))
    return model


class Shard:
    """Rows of one shard with the tables of all substrings."""

    def __init__(self, model: Model, vectors: np.ndarray, ids: list[np.ndarray]):
        self.model, self.vectors, self.ids = model, vectors, ids
        self.first = np.array([x[0] for x in ids], dtype=np.int64)
        self.codes = model.row_codes(vectors)
        self.tables = [np.unique(self.codes[:, j], return_inverse=True) for j in range(_PARTS)]

    def probed(self, codes: np.ndarray) -> np.ndarray:
        """queries x rows: rows in a bucket within radius // parts of a query's substring, over all tables.

        Where a substring has more probes than filled buckets, the filled ones are compared instead.
        """
        within = self.model.radius // _PARTS
        hit = np.zeros((len(codes), len(self.codes)), dtype=bool)
        for j, (values, bucket) in enumerate(self.tables):
            near = np.bitwise_count(codes[:, j, None] ^ values) <= within
            hit |= near[:, bucket]
        return hit

    def search(self, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query: ids and products of its k nearest found here, ties to the smaller id."""
        codes = self.model.query_codes(queries)
        hit = self.probed(codes)
        far = np.where(hit, distances(codes, self.codes), CODE_BITS + 1)
        found = far <= self.model.radius
        short = np.flatnonzero(found.sum(axis=1) < k)  # widen the radius until k are found
        if len(short):
            whole = distances(codes[short], self.codes)
            last = min(k, whole.shape[1]) - 1
            found[short] = whole <= np.partition(whole, last, axis=1)[:, last, None]
        for q, mask in zip(queries, found):
            at = np.flatnonzero(mask)
            product = np.einsum("ij,j->i", self.vectors[at], q)
            best = np.lexsort((self.first[at], -product))[:k]
            ids = [self.ids[i] for i in at[best]]
            product = np.repeat(product[best], [len(x) for x in ids])
            ids = np.concatenate(ids)
            order = np.lexsort((ids, -product))[:k]
            yield ids[order], product[order]


_ROWS, _ASKED = 0, 1


def _valid(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, v, ids) to one row per shard and batch."""
    for b in batches:
        shards = b.column(0).to_numpy(zero_copy_only=False)
        vectors = _matrix(b.column(1))
        ids = b.column(2)
        out = Rows()
        for s in np.unique(shards):
            i = np.flatnonzero(shards == s)
            some = [np.array(ids[k].as_py(), dtype=np.int64) for k in i.tolist()]
            out.add(int(s), _ROWS, vectors[i].tobytes(), np.array([len(x) for x in some], dtype=np.int64).tobytes(), np.concatenate(some).tobytes())
        yield from out.batches(16)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, entry) to blocks of queries."""
    for b in batches:
        vectors, entry = _matrix(b.column(0)) if b.num_rows else None, b.column(1).to_numpy(zero_copy_only=False)
        out = Rows()
        for lo in range(0, b.num_rows, QUERY_BLOCK):
            hi = lo + QUERY_BLOCK
            out.add(0, _ASKED, vectors[lo:hi].tobytes(), entry[lo:hi].astype(np.int64).tobytes())
        yield from out.batches(16)


def _search(model: Model, dims: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, shard = None, [], None
        for to, kind, a, b, c, _ in rows_of(batches):
            if to != part:
                part, held, shard = to, [], None
            vectors = np.frombuffer(a, np.float64).reshape(-1, dims)
            if kind == _ROWS:
                held.append((vectors, np.split(np.frombuffer(c, np.int64), np.cumsum(np.frombuffer(b, np.int64))[:-1])))
                continue
            if not held:
                continue  # a shard without rows
            shard = shard or Shard(model, np.concatenate([x for x, _ in held]), [i for _, x in held for i in x])
            entries, ids, products = [], [], []
            for entry, (i, p) in zip(np.frombuffer(b, np.int64).tolist(), shard.search(vectors, k)):
                entries.append(np.full(len(i), entry))
                ids.append(i)
                products.append(p)
            arrays = [pa.array(np.concatenate(x)) for x in (entries, ids, products)]
            yield pa.RecordBatch.from_arrays(arrays, names=["entry", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, every: int, k: int = NEIGHBOURS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is divisible by ``every``.

    Nearest first, ties to the smaller id; a row is no neighbour of its own id, equal vectors of other ids are.  All
    candidates are returned where there are fewer than k.  Rows with a null id, and vectors that are null, zero,
    hold null or non-finite components, or have another length than most, take no part.  A row that repeats
    id and vector counts once.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null").where(_valid(F.col("v")))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims = usual[0]["n"] if usual else 1
    rows = rows.where(F.size("v") == dims).withColumn("h", F.xxhash64("v"))

    keep = k + 1  # of equal vectors no more than k besides the query itself can be among the nearest
    place = F.row_number().over(Window.partitionBy("h", "v").orderBy("vec_id"))
    entries = rows.distinct().withColumn("place", place).where(F.col("place") <= keep)
    entries = entries.groupBy("h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = stage(entries.withColumn("entry", F.col("ids")[0]), "ann-entries")
    asked = rows.where(F.col("vec_id") % every == 0).select("h", "v", "vec_id").distinct()
    asked = asked.withColumnRenamed("vec_id", "query_id")

    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    total, largest = entries.agg(F.count("*"), F.max(norm)).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = entries.orderBy(F.xxhash64("entry"), "entry").select("v").limit(FIT_ROWS).collect()
    model = learn(np.array([r["v"] for r in sample]), float(np.sqrt(largest)), total, k)

    shards = -(-total // SHARD_ROWS)
    packed = entries.select(F.pmod(F.xxhash64("entry"), F.lit(shards)).cast("int").alias("part"), "v", "ids").mapInArrow(_pack_rows, PACKED)
    members = asked.join(entries.select("h", "v", "entry"), ["h", "v"]).select("query_id", "entry")
    queries = entries.join(members.select("entry").distinct(), "entry", "left_semi")
    blocks = queries.select("v", "entry").mapInArrow(_pack_queries, PACKED)
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = packed.unionByName(blocks).repartition(shards, "part").sortWithinPartitions("part", "kind")
    found = both.mapInArrow(_search(model, dims, keep), "entry long, vec_id long, score double")

    best = Window.partitionBy("entry").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep)
    own = members.join(found.select("entry", "vec_id", "score"), "entry").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return own.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_multi_index_ann(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), 20)


QUERIES = {"op8_multi_index_ann": op8_multi_index_ann}
ORACLE: dict[str, str] = {}
