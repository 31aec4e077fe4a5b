"""Dimensions written once and read by path.

A dimension is kept under its content version: the files it comes from, with their lengths and times, and the plan
that turns them into rows.  Its bytes and rows are counted while it is written and noted in a manifest, written last.  A
query or micro-batch that needs it reads the manifest and the path; no job runs unless the version is new.
A dimension that does not come from files alone has no such version and is kept for the one that asked.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from accesslens.sources import staging

#: Largest dimension, in bytes of its rows, that is sent to every executor.
BROADCAST_BYTES = 32 << 20
#: Leaves of a plan whose rows do not show in its text.
_NO_VERSION = ("LocalRelation [", "LogicalRDD", "ExternalRDD", "InMemoryRelation", "StreamingRelation")


def _bytes(c: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, StructType):
        return sum((_bytes(c[f.name], f.dataType) for f in kind), F.lit(16))
    if isinstance(kind, ArrayType):
        if isinstance(kind.elementType, (StringType, StructType, ArrayType)):
            held = F.aggregate(c, F.lit(0), lambda s, x: s + _bytes(x, kind.elementType))
        else:
            held = F.size(c) * 8
        return F.coalesce(held, F.lit(0)) + 16
    return F.lit(8)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as a hash table holds it: 8 per fixed value, 16 and the content per text or array."""
    return sum((_bytes(F.col(f.name), f.dataType) for f in df.schema), F.lit(16)).cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def _settings(spark: SparkSession) -> list[str]:
    """What a session decides about the rows of a plan."""
    return [spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")]


def content_version(df: DataFrame) -> str | None:
    """A digest of the files and the plan behind ``df``; None where rows come from elsewhere too.  Runs no job."""
    plan = df._jdf.queryExecution().analyzed().canonicalized().treeString(True, False, 1 << 20, False, False)
    if any(leaf in plan for leaf in _NO_VERSION):
        return None
    files = staging.file_marks(df.sparkSession, df.inputFiles())
    text = json.dumps([plan, df.schema.jsonValue(), files, _settings(df.sparkSession)])
    return hashlib.sha256(text.encode()).hexdigest()[:32]


@dataclass(frozen=True)
class Kept:
    """A written dimension: where it is, what it holds, and the first row's values if those were asked for."""

    path: str
    rows: int
    bytes: int
    schema: dict
    first: dict | None = None


#: Dimensions this process has met by recipe and files, so that it need not even build their plan again.
_MET: dict[tuple, Kept] = {}
Recipe = Callable[[], DataFrame]


class DimStore:
    """Dimensions under the shared folder of the session's cluster.

    A dimension is given as a DataFrame, or as a recipe with the files or folders it reads (``sources``): then its
    plan is built once in a process for each state of those files.  Recipes of one store go by their names.
    """

    def __init__(self, spark: SparkSession, max_bytes: int = BROADCAST_BYTES):
        self.spark, self.max_bytes = spark, max_bytes
        self.root = f"{staging.shared_root(spark)}/accesslens/dims"

    def keep(self, name: str, dim: DataFrame | Recipe, sources: Sequence[str] = (), first: bool = False) -> Kept:
        """The dimension as it is kept; it is written only if this version of it is not there yet."""
        met = None
        if sources:
            met = (self.root, name, *_settings(self.spark), *[m for s in sources for m in staging.folder_marks(self.spark, s)])
            if met in _MET and staging.exists(self.spark, _MET[met].path):
                return _MET[met]
        kept = self._kept(name, dim if isinstance(dim, DataFrame) else dim(), first)
        if met:
            _MET[met] = kept
        return kept

    def _kept(self, name: str, df: DataFrame, first: bool) -> Kept:
        version = content_version(df)
        folder = f"{self.root}/{name}/{version or uuid.uuid4().hex}"
        manifest = f"{folder}/manifest.json"
        found = staging.read_text(self.spark, manifest) if version else None
        if found is not None:
            kept = Kept(**json.loads(found))
            if staging.exists(self.spark, kept.path):  # else someone cleared the folder
                return kept
        made = self._write(f"{folder}/{uuid.uuid4().hex}", df, first)
        staging.replace_text(self.spark, manifest, json.dumps(asdict(made)))
        return made

    def _write(self, path: str, df: DataFrame, first: bool) -> Kept:
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes"))
        counted.hint("rebalance").write.option("compression", "zstd").parquet(path)
        totals = seen.get
        kept = Kept(path, totals["rows"], totals["bytes"] or 0, df.schema.jsonValue())
        return replace(kept, first=self.read(kept).first().asDict()) if first else kept

    def read(self, kept: Kept) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(kept.schema)).parquet(kept.path)

    def table(self, name: str, dim: DataFrame | Recipe, sources: Sequence[str] = ()) -> DataFrame:
        """The kept dimension, marked for broadcast if its counted bytes allow it.

        A marked table may exceed the planner's threshold, which keeps log rows from being shuffled for it; an
        unmarked one is left to the planner, which joins it by shuffle.
        """
        kept = self.keep(name, dim, sources)
        return F.broadcast(self.read(kept)) if kept.bytes <= self.max_bytes else self.read(kept)

    def first(self, name: str, dim: DataFrame | Recipe, sources: Sequence[str] = ()) -> dict:
        """Values of a one-row dimension, from the manifest."""
        return self.keep(name, dim, sources, first=True).first
