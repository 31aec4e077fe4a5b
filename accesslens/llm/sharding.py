"""Contiguous shards of near equal bytes, cut out of one global order.

Rows are sorted by range partitions.  Each partition gives its own running sums and
a total; totals of the partitions before give each row its global byte offset.  The
order is cut at equal targets.  Equal texts lie next to each other and a cut moves to
the nearer end of the group it falls in, so no shard boundary splits copies.  Groups
of over 1 / 64 of a shard come first, largest first: where cuts fall, groups are small.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import long_array, stage, table, texts

SHARDS = 8
#: A group with more than this part of a shard is placed first.
LARGE_PART = 64

_GROUP = ["h", "text_crc32", "size"]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, h): what is needed of each text; size is its bytes plus 1."""
    t = texts(docs, id_col, text_col)
    return t.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.md5(F.col("text").cast("binary")).alias("h"),
    )


def _large_first(rows: DataFrame, shards: int, total: int) -> DataFrame:
    """Adds ``first``: the bytes of a large group, else 0.  There are at most shards x LARGE_PART such groups."""
    groups = rows.groupBy(*_GROUP).agg(F.sum("size").alias("first")).where(F.col("first") * (LARGE_PART * shards) > total)
    groups = F.broadcast(groups.select(*[F.col(c).alias(f"g_{c}") for c in _GROUP], "first"))
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in _GROUP])
    return rows.join(groups, on, "left").select(*rows.columns, F.coalesce("first", F.lit(0)).alias("first"))


def _running(rows: DataFrame) -> DataFrame:
    """Per partition: its number, each row's byte offset and place in it."""
    columns = ["doc_id", *_GROUP]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        offset = place = 0
        for b in batches:
            sizes = b.column(b.schema.get_field_index("size")).to_numpy(zero_copy_only=False)
            ends = offset + np.cumsum(sizes, dtype=np.int64)
            n = len(sizes)
            out = [b.column(b.schema.get_field_index(c)) for c in columns]
            out += [long_array(np.full(n, part)), long_array(ends - sizes), long_array(place + np.arange(n))]
            yield pa.RecordBatch.from_arrays(out, names=[*columns, "part", "at", "place"])
            if n:
                offset, place = int(ends[-1]), place + n

    return rows.mapInArrow(run, "doc_id long, h string, text_crc32 long, size long, part long, at long, place long")


def _global(rows: DataFrame) -> DataFrame:
    """Offsets over all partitions, from the totals of those before; one total per partition reaches the driver."""
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    at = place = 0
    before = []
    for t in sorted(totals, key=lambda t: t["part"]):
        before.append((t["part"], at, place))
        at, place = at + t["bytes"], place + t["rows"]
    table = rows.sparkSession.createDataFrame(before, "p long, at0 long, place0 long")
    joined = rows.join(F.broadcast(table), F.col("part") == F.col("p"))
    return joined.select("doc_id", *_GROUP, (F.col("at") + F.col("at0")).alias("at"), (F.col("place") + F.col("place0")).alias("place"))


def _cuts(rows: DataFrame, shards: int, total: int) -> list[int]:
    """Byte offsets of the shard boundaries: equal targets, moved to the nearer end of a group."""
    targets = [total * i // shards for i in range(1, shards)]
    end = F.col("at") + F.col("size")
    struck = reduce(lambda a, b: a | b, [(F.col("at") <= t) & (end > t) for t in targets])
    keys = rows.where(struck).select(*_GROUP).distinct()  # at most one group for each target
    keys = F.broadcast(keys.select(*[F.col(c).alias(f"g_{c}") for c in _GROUP]))
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in _GROUP])
    spans = rows.join(keys, on).groupBy(*_GROUP).agg(F.min("at").alias("lo"), F.max(end).alias("hi")).collect()
    return [next((s["lo"] if t - s["lo"] <= s["hi"] - t else s["hi"]) for s in spans if s["lo"] <= t < s["hi"]) for t in targets]


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every input row; law is ``bytes``.

    A null text has size 1, no checksum and is a group with other null texts; empty
    texts are another.  Repeated rows keep a slot each; a null doc_id is a row like any
    other.  Rows of one group follow doc_id.  A group larger than a shard fills one alone and may
    leave others empty.  An empty table gives no rows.
    """
    rows = stage(measured(docs, id_col, text_col), "shard-sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    order = [F.desc("first"), F.asc("h"), F.asc("text_crc32"), F.asc("size"), F.asc("doc_id")]
    ordered = _large_first(rows, shards, total).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = _global(stage(_running(ordered), "shard-order"))
    cuts = _cuts(ordered, shards, total) if total and shards > 1 else []
    at = F.col("at")
    firsts = [0]
    if cuts:
        firsts += list(ordered.agg(*[F.count(F.when(at < c, 1)) for c in cuts]).first())
    number = reduce(lambda a, b: a + b, [(at >= c).cast("int") for c in cuts], F.lit(0))
    first = F.element_at(F.array(*[F.lit(x).cast("long") for x in firsts]), number + 1)
    return ordered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        number.cast("int").alias("shard"),
        (F.col("place") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: where every document goes."""
    return shard(docs)


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


QUERIES = {"op4_sharding": op4_sharding}
#: CRC-32 byte by byte from its table of 256; then the order, the cuts and the slots.
ORACLE = {
    "op4_sharding": f"""
WITH t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i::bigint], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::bigint, c >> 1) ELSE c >> 1 END)) AS tab),
d AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, md5(text) AS h,
    xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(strlen(text)), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295::bigint) AS text_crc32
  FROM (SELECT doc_id, text, hex(encode(text)) AS x FROM documents), t),
total AS (SELECT sum(size)::bigint AS n FROM d),
grouped AS (
  SELECT *, CASE WHEN held * {SHARDS * LARGE_PART} > n THEN held ELSE 0 END AS first
  FROM (SELECT *, sum(size) OVER (PARTITION BY h, text_crc32, size)::bigint AS held FROM d), total),
placed AS (
  SELECT *, row_number() OVER w - 1 AS place, sum(size) OVER w - size AS pos FROM grouped
  WINDOW w AS (ORDER BY first DESC, h NULLS FIRST, text_crc32, size, doc_id NULLS FIRST)),
spans AS (SELECT min(pos) AS lo, max(pos + size) AS hi FROM placed GROUP BY h, text_crc32, size),
cuts AS (
  SELECT i, CASE WHEN t - lo <= hi - t THEN lo ELSE hi END AS cut
  FROM (SELECT i, n * i // {SHARDS} AS t FROM total, (SELECT unnest(range(1, {SHARDS})) AS i)) JOIN spans ON lo <= t AND t < hi),
dealt AS (SELECT *, (SELECT count(*) FROM cuts WHERE pos >= cut) AS shard FROM placed)
SELECT doc_id, size::bigint AS size, text_crc32, 'bytes' AS law, shard::int AS shard,
  (place - min(place) OVER (PARTITION BY shard))::bigint AS slot, NULL::int AS grown_shard FROM dealt"""
}
