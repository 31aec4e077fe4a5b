"""Dimension loads: text lines in, typed and de-duplicated tables out.

Every load takes a DataFrame ``(value string, pos)``, where ``pos`` orders the
lines of the source.  A repeated key keeps its last line, so a lookup can never
multiply fact rows.  Nothing here is collected to the driver.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from accesslens.constants import DIR_SCHEMA_KEYS, WILDCARD_PREFIX, WILDCARD_TYPE
from accesslens.sources.dimstore import BROADCAST_BYTES, DimStore, measured_bytes  # noqa: F401


#: Addresses a range may hold: IPv4.
ADDRESSES = 1 << 32


@dataclass(frozen=True)
class Dims:
    """The lookups one job needs; each is a small table, read where it is used.

    ``places`` is the isp, province and area by address block (``enrich.place_table``); it is made
    of the three where it is not given.  ``isp``, ``prv`` and ``named`` are ranges, or tables by block.
    """

    domains: DataFrame | None = None
    isp: DataFrame | None = None
    prv: DataFrame | None = None
    area: DataFrame | None = None
    machines: DataFrame | None = None
    parents: DataFrame | None = None
    named: DataFrame | None = None
    places: DataFrame | None = None

    def measured(self, max_bytes: int = BROADCAST_BYTES, store: DimStore | None = None) -> KeptDims:
        """The same lookups as they are joined, each written once and marked for broadcast if its bytes allow it."""
        given = [getattr(self, f.name) for f in fields(self)]
        spark = next((d.sparkSession for d in given if d is not None), None)
        return KeptDims(self.made, store or (DimStore(spark, max_bytes) if spark else None))

    def made(self, name: str) -> DataFrame | None:
        from accesslens.operators import enrich

        dim = getattr(self, name)
        if name == "places" and dim is None and self.isp is not None and self.prv is not None:
            return enrich.place_table(self.isp, self.prv, self.area)
        if dim is None or name not in ("isp", "prv", "named"):
            return dim
        return enrich.named_table(dim) if name == "named" else enrich.code_table(dim)


LOOKUPS = tuple(f.name for f in fields(Dims))


class KeptDims:
    """The lookups of ``Dims`` under the same names, kept by a store; one that no step asks for is never computed.

    Ranges are kept as tables by address block.  ``make`` gives a lookup by name; ``sources`` names the files of
    lookups that come from files alone, whose plans are then built once in a process.
    """

    def __init__(self, make: Callable[[str], DataFrame | None], store: DimStore | None, sources: dict[str, list[str]] | None = None):
        self._make, self._store, self._sources = make, store, sources or {}

    def __getattr__(self, name: str) -> DataFrame | None:
        if name not in LOOKUPS:
            raise AttributeError(name)
        if name in self._sources:
            found = self._store.table(name, lambda: self._make(name), self._sources[name])
        else:
            dim = self._make(name)
            found = self._store.table(name, dim) if dim is not None else None
        setattr(self, name, found)
        return found


class TimedDims:
    """Lookups that a running stream takes again after a time, and not before.

    ``load(spark)`` gives the lookups.  Within ``every_sec`` of a load all batches share its tables and start
    no job for them; after it the next batch loads again, which writes only what has a new version.  A load
    that fails leaves the old lookups in use until the next batch, unless there are none yet.
    """

    def __init__(self, load: Callable[[SparkSession], Dims], every_sec: float, clock: Callable[[], float] = time.monotonic):
        self.load, self.every_sec, self.clock = load, every_sec, clock
        self.loads = 0
        self._held: KeptDims | None = None
        self._at = 0.0
        self.failed: Exception | None = None

    def __call__(self, spark: SparkSession) -> KeptDims:
        now = self.clock()
        if self._held is None or now - self._at >= self.every_sec:
            try:
                fresh = self.load(spark)
                self._held = fresh if isinstance(fresh, KeptDims) else fresh.measured()
                self.loads, self._at, self.failed = self.loads + 1, now, None
            except Exception as e:
                if self._held is None:
                    raise
                self.failed = e
        return self._held


#: How long loaded lookups serve a stream: an hour; the named ranges change every other day, agent keywords daily.
HOURLY, NAMED_EVERY, AGENTS_EVERY = 3600, 48 * 3600, 24 * 3600


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) as ``(value, pos)``; ``pos`` follows file order exactly.

    The running id grows inside one file block, so (file, block start, id)
    orders all lines however the blocks were spread over tasks.
    """
    return spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
    )


def _last_per(df: DataFrame, key: str) -> DataFrame:
    """Last line per key; map-side combined, so a hot key costs nothing."""
    rest = [c for c in df.columns if c not in (key, "pos")]
    if not rest:
        return df.select(key).distinct()
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*rest), "pos").alias("r"))
        .select(key, *[F.col(f"r.{c}").alias(c) for c in rest])
    )


def load_domains(lines: DataFrame) -> DataFrame:
    """CSV of domains -> ``(name, wildcard, userid)``.

    An ``ext.`` row of type ``2`` is a wildcard for the name behind the prefix.
    """
    c = F.split("value", ",")
    wildcard = F.col("value").startswith(WILDCARD_PREFIX) & (F.get(c, F.lit(2)) == WILDCARD_TYPE)
    rows = lines.filter(F.size(c) > 6).select(
        "pos",
        wildcard.alias("wildcard"),
        F.when(wildcard, F.substr(F.get(c, F.lit(0)), F.lit(len(WILDCARD_PREFIX) + 1)))
        .otherwise(F.get(c, F.lit(0)))
        .alias("name"),
        F.get(c, F.lit(6)).alias("userid"),
    )
    return (
        rows.groupBy("name", "wildcard")
        .agg(F.max_by("userid", "pos").alias("userid"))
        .select("name", "wildcard", "userid")
    )


def user_domains(domains: DataFrame, userids: list[str]) -> DataFrame:
    """Domains owned by chosen users; wildcard rows carry the bare name."""
    return domains.filter(F.col("userid").isin(*userids)).select(F.col("name").alias("domain")).distinct()


def is_range(lo: Column, hi: Column) -> Column:
    """Whether two bounds are an IPv4 range; null counts as no."""
    return F.coalesce((lo >= 0) & (lo <= hi) & (hi < ADDRESSES), F.lit(False))


def load_ranges(lines: DataFrame) -> DataFrame:
    """``lo hi code`` separated by spaces; malformed lines and impossible bounds are dropped.

    A repeated ``lo`` keeps its last line.
    """
    c = F.split("value", " ")
    rows = lines.filter(F.size(c) == 3).select(
        "pos",
        F.get(c, F.lit(0)).try_cast("bigint").alias("lo"),
        F.get(c, F.lit(1)).try_cast("bigint").alias("hi"),
        F.get(c, F.lit(2)).try_cast("int").alias("code"),
    )
    return _last_per(rows.filter(is_range(F.col("lo"), F.col("hi")) & F.col("code").isNotNull()), "lo")


def load_named_ranges(lines: DataFrame, min_fields: int = 6) -> DataFrame:
    """``lo hi isp isp_name prv prv_name``; short and blank lines are skipped.

    With ``min_fields=3`` the names may be absent and come back null.  A
    repeated ``lo`` keeps its last line.
    """
    c = F.split(F.trim("value"), " ")

    def word(i: int) -> Column:
        return F.trim(F.get(c, F.lit(i)))

    rows = lines.filter((F.trim("value") != "") & (F.size(c) >= min_fields)).select(
        "pos",
        word(0).try_cast("bigint").alias("lo"),
        word(1).try_cast("bigint").alias("hi"),
        word(2).try_cast("int").alias("isp"),
        word(3).alias("isp_name"),
        word(4).try_cast("int").alias("prv"),
        word(5).alias("prv_name"),
    )
    return _last_per(rows.filter(is_range(F.col("lo"), F.col("hi")) & F.col("isp").isNotNull()), "lo")


def load_area(lines: DataFrame) -> DataFrame:
    """Three-field CSV rows -> ``(area_id, area_pid, area_cid)``; header dropped."""
    c = F.split("value", ",")
    rows = lines.filter((F.size(c) == 3) & (F.get(c, F.lit(0)) != "area_id")).select(
        "pos",
        F.get(c, F.lit(0)).alias("area_id"),
        F.get(c, F.lit(1)).alias("area_pid"),
        F.get(c, F.lit(2)).alias("area_cid"),
    )
    return _last_per(rows, "area_id")


def load_machines(lines: DataFrame) -> DataFrame:
    """CSV of 8+ fields per host; all malformed lines make one ``-`` row."""
    c = F.split("value", ",")

    def num(i: int) -> Column:
        return F.get(c, F.lit(i)).try_cast("int")

    ok = (
        (F.size(c) >= 8) & num(2).isNotNull() & num(4).isNotNull() & num(7).isNotNull()
    )

    def text(i: int) -> Column:
        return F.when(ok, F.get(c, F.lit(i))).otherwise("-")

    def number(i: int) -> Column:
        return F.when(ok, num(i)).otherwise(0)

    rows = lines.select(
        "pos",
        text(0).alias("host"),
        text(1).alias("machine_isp"),
        number(2).alias("machine_isp_code"),
        text(3).alias("machine_prv"),
        number(4).alias("machine_prv_code"),
        text(5).alias("platform"),
        text(6).alias("machine_ip"),
        number(7).alias("pop_id"),
    )
    return _last_per(rows, "host")


def load_parents(lines: DataFrame) -> DataFrame:
    """One-field rows -> distinct ``ip``."""
    return lines.filter(F.size(F.split("value", ",")) == 1).select(F.col("value").alias("ip")).distinct()


def load_user_filter(lines: DataFrame) -> DataFrame:
    return lines.select(F.explode(F.split(F.trim("value"), ",")).alias("userid")).distinct()


def load_ua_keywords(lines: DataFrame) -> DataFrame:
    """Ordered keyword list -> ``(ord, keyword)``; ``ord`` is (line, place)."""
    return lines.select(
        "pos", F.posexplode(F.split(F.trim("value"), ",")).alias("place", "keyword")
    ).select(F.struct("pos", "place").alias("ord"), "keyword")


def load_monitor_domains(lines: DataFrame) -> DataFrame:
    """Only the last line counts."""
    last = lines.groupBy().agg(F.max_by("value", "pos").alias("value"))
    return last.select(F.explode(F.split("value", ",")).alias("domain")).distinct()


def load_dir_domains(lines: DataFrame, skip=DIR_SCHEMA_KEYS) -> DataFrame:
    """JSON file: keys of ``result`` except the two schema keys, any case.

    One JSON document per line; ``result`` is the third child of the document.
    """
    doc = F.from_json("value", "struct<result: map<string,string>>")
    keys = F.explode(F.map_keys(doc["result"])).alias("domain")
    rows = lines.select(keys)
    return rows.filter(~F.lower("domain").isin(*[k.lower() for k in skip])).distinct()


def overlapping_ranges(ranges: DataFrame, shift: int = 16) -> DataFrame:
    """Ranges that share an address with the range before them.

    Two overlapping ranges share at least one address block, so the check runs
    per block and never sorts the whole table in one task.
    """
    ranges = ranges.filter(is_range(F.col("lo"), F.col("hi")))
    blocks = F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright("hi", shift)))
    w = Window.partitionBy("block").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.select("lo", "hi", blocks.alias("block"))
        .withColumn("seen_hi", F.max("hi").over(w))
        .filter(F.col("lo") <= F.col("seen_hi"))
        .select("lo", "hi")
        .distinct()
    )


def require_disjoint(ranges: DataFrame) -> DataFrame:
    """Fail on load when ranges overlap: a lookup would return two codes."""
    bad = overlapping_ranges(ranges).limit(5).collect()
    if bad:
        raise ValueError(f"overlapping ranges, e.g. {[tuple(r) for r in bad]}")
    return ranges
