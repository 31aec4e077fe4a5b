"""Dimension lookups.

No lookup forces a broadcast.  The planner broadcasts a dimension while its
size stays under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks the
measured size; a larger one becomes a shuffled join, whose hot keys AQE splits.
A job that keeps its dimensions (``Dims.measured``) decides by their counted bytes.
Range tables are cut into address pieces that cannot overlap and gathered into one
row per block of addresses, so a range lookup is an equi join on a unique key, and a binary
search inside the row that it finds.  All lookups are left joins on unique keys: they
never change the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from accesslens.constants import WILDCARD_PREFIX
from accesslens.functions import agent, net
from accesslens.sources.dims import Dims, is_range

BLOCK_BITS = 16


def _with(joined: DataFrame, df: DataFrame, outs: dict[str, Column]) -> DataFrame:
    """The columns of ``df``, with ``outs`` added or put in place; lookup columns go."""
    kept = [F.col(c) for c in df.columns if c not in outs]
    return joined.select(*kept, *[c.alias(n) for n, c in outs.items()])


def map_domain(df: DataFrame, domains: DataFrame, host: str = "host") -> DataFrame:
    """Add ``domain`` and ``userid``: exact name, else wildcard parent, else null."""
    exact = domains.filter(~F.col("wildcard")).select(
        F.col("name").alias("_exact"), F.col("userid").alias("_exact_user")
    )
    wild = domains.filter("wildcard").select(
        F.col("name").alias("_wild"), F.col("userid").alias("_wild_user")
    )
    joined = df.join(exact, F.col(host) == F.col("_exact"), "left").join(
        wild, net.parent_domain(F.col(host)) == F.col("_wild"), "left"
    )
    domain = F.coalesce(F.col("_exact"), F.concat(F.lit(WILDCARD_PREFIX), F.col("_wild")))
    userid = F.when(F.col("_exact").isNotNull(), F.col("_exact_user")).otherwise(F.col("_wild_user"))
    return _with(joined, df, {"domain": domain, "userid": userid})


def domain_owner(df: DataFrame, domains: DataFrame, domain: str = "domain") -> DataFrame:
    """``userid`` of an already canonical domain; '' when it has none."""
    names = domains.select(
        F.when(F.col("wildcard"), F.concat(F.lit(WILDCARD_PREFIX), F.col("name")))
        .otherwise(F.col("name"))
        .alias("_name"),
        F.col("wildcard").alias("_w"),
        F.col("userid").alias("_user"),
    )
    # an exact row may itself be named ext.*; it wins over the wildcard
    owners = names.groupBy("_name").agg(F.min_by("_user", "_w").alias("_user"))
    joined = df.join(owners, F.col(domain) == F.col("_name"), "left")
    return _with(joined, df, {"userid": F.coalesce("_user", F.lit(""))})


def _blocks(df: DataFrame, bits: int) -> DataFrame:
    """Ranges cut at the borders of blocks of 2^bits addresses, with the block as ``_block``."""
    block = F.explode(F.sequence(F.shiftright("_lo", bits), F.shiftright("_hi", bits)))
    cut = df.withColumn("_block", block)
    first = F.shiftleft(F.col("_block"), bits)
    return cut.withColumns({"_lo": F.greatest("_lo", first), "_hi": F.least("_hi", first + ((1 << bits) - 1))})


def pieces(tables: dict[str, DataFrame], fill: bool = False) -> DataFrame:
    """Address pieces of one or more range tables ``(lo, hi, value)``: (_block, _lo, _hi, one value column per table).

    Pieces never overlap, so a lookup in them finds one row at most, however many tables they join.  A
    table whose own ranges share an address fails the job that uses it.  Impossible bounds are left
    out.  ``fill`` adds the pieces no range covers.  Bounds are put in order per 2^24 addresses, and
    pieces cut to blocks of 2^16 afterwards: at most 65,536 rows more than pieces.
    """
    wide = 24
    parts = []
    kinds = [f"struct<v:{t.schema['value'].dataType.simpleString()}>" for t in tables.values()]
    for i, ranges in enumerate(tables.values()):
        r = ranges.filter(is_range(F.col("lo"), F.col("hi")))
        r = _blocks(r.select(F.col("lo").cast("bigint").alias("_lo"), F.col("hi").cast("bigint").alias("_hi"), "value"), wide)
        end = F.shiftleft(F.col("_block") + 1, wide)
        opens = F.struct(F.col("_lo").alias("at"), F.lit(1).alias("step"), F.col("value"))
        closes = F.struct((F.col("_hi") + 1).alias("at"), F.lit(-1).alias("step"), F.when(F.lit(False), F.col("value")).alias("value"))
        both = F.filter(F.array(opens, closes), lambda e: e["at"] < F.col("end"))
        events = r.withColumn("end", end).select("_block", F.explode(both).alias("e"))
        steps = [F.col("e.step") if j == i else F.lit(0) for j in range(len(tables))]
        named = [F.struct(F.col("e.value").alias("v")) if j == i else F.lit(None).cast(kinds[j]) for j in range(len(tables))]
        parts.append(events.select("_block", F.col("e.at").alias("at"), *[x.cast("int").alias(f"s{j}") for j, x in enumerate(steps)], *[x.alias(f"v{j}") for j, x in enumerate(named)]))
    events = parts[0]
    for more in parts[1:]:
        events = events.unionByName(more)
    n = range(len(tables))
    if fill:
        every = events.sparkSession.range(1 << (32 - wide)).select(F.col("id").alias("_block"), F.shiftleft("id", wide).alias("at"))
        events = events.unionByName(every, allowMissingColumns=True)
    # several bounds in one place: what opens there counts
    points = events.repartition("_block").groupBy("_block", "at").agg(
        *[F.coalesce(F.sum(f"s{j}"), F.lit(0)).alias(f"s{j}") for j in n],
        *[F.max_by(f"v{j}", F.when(F.col(f"v{j}").isNotNull(), F.col(f"s{j}"))).alias(f"v{j}") for j in n],
    )
    order = Window.partitionBy("_block").orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = points.select(
        "_block",
        "at",
        F.coalesce(F.lead("at").over(order) - 1, F.shiftleft(F.col("_block") + 1, wide) - 1).alias("_hi"),
        F.greatest(F.lit(0), *[F.sum(f"s{j}").over(upto) for j in n]).alias("open"),
        *[F.last(f"v{j}", ignorenulls=True).over(upto).alias(f"v{j}") for j in n],
    )
    lo = F.when(F.col("open") > 1, F.raise_error(F.lit("ranges of one table overlap")).cast("bigint")).otherwise(F.col("at"))
    found = state.select(lo.alias("_lo"), "_hi", *[F.col(f"v{j}.v").alias(name) for j, name in enumerate(tables)])
    if not fill:
        some = F.coalesce(*[F.when(F.col(name).isNotNull(), True) for name in tables], F.lit(False))
        found = found.filter(some)
    return _blocks(found, BLOCK_BITS)


def by_block(cut: DataFrame) -> DataFrame:
    """Pieces as one row per block: begins and ends inside the block in order, and an array of each value column.

    A block has 2^16 addresses, so no row holds more pieces than that.
    """
    names = [c for c in cut.columns if c not in ("_block", "_lo", "_hi")]
    inside = lambda c: F.col(c).bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias(c)
    held = F.array_sort(F.collect_list(F.struct(inside("_lo"), inside("_hi"), F.struct(*names).alias("_v"))))
    grouped = cut.groupBy("_block").agg(held.alias("_p"))
    return grouped.select(
        "_block", F.col("_p._lo").alias("_begins"), F.col("_p._hi").alias("_ends"), *[F.col(f"_p._v.{n}").alias(n) for n in names]
    )


def _place(at: Column) -> Column:
    """Position of the last begin that is not behind ``at``, by halves; -1 before the first."""
    halves = F.array(*[F.lit(1 << b) for b in range(BLOCK_BITS, -1, -1)])
    step = lambda place, half: F.when(F.get("_begins", place + half) <= at, place + half).otherwise(place)
    return F.when(F.size("_begins") == 1, F.lit(0)).otherwise(F.aggregate(halves, F.lit(-1), step))


def _find(df: DataFrame, blocks: DataFrame, ip: str, outs: dict[str, str], defaults: dict[str, Column]) -> DataFrame:
    """Columns ``outs`` (output -> value column of a table by block) for an address."""
    dim = blocks.select("_block", "_begins", "_ends", *dict.fromkeys(outs.values()))
    joined = df.join(dim, F.shiftright(F.col(ip), BLOCK_BITS) == F.col("_block"), "left")
    at = F.col(ip).bitwiseAND((1 << BLOCK_BITS) - 1).cast("int")
    joined = joined.withColumn("_at", at).withColumn("_place", _place(F.col("_at")))
    inside = (F.col("_at") >= F.get("_begins", F.col("_place"))) & (F.col("_at") <= F.get("_ends", F.col("_place")))
    found = {o: F.coalesce(F.when(inside, F.get(c, F.col("_place"))), defaults[o]) for o, c in outs.items()}
    return _with(joined, df, found)


def _range_table(ranges: DataFrame, columns: list[str]) -> DataFrame:
    if "_block" in ranges.columns:
        return ranges
    values = F.struct(*[F.col(c).alias(f"_{c}") for c in columns])
    cut = pieces({"_found": ranges.select("lo", "hi", values.alias("value"))})
    return by_block(cut.select("_block", "_lo", "_hi", "_found.*"))


def code_table(ranges: DataFrame) -> DataFrame:
    """Ranges ``(lo, hi, code)`` by block, codes as text."""
    if "_block" in ranges.columns:
        return ranges
    return _range_table(ranges.select("lo", "hi", F.col("code").cast("string").alias("code")), ["code"])


NAMED = ["isp", "isp_name", "prv", "prv_name"]


def named_table(ranges: DataFrame) -> DataFrame:
    """Named ranges by block."""
    return _range_table(ranges, NAMED)


def with_range(
    df: DataFrame, ranges: DataFrame, ip: str, columns: dict[str, str], defaults: dict[str, Column]
) -> DataFrame:
    """Left range lookup ``lo <= ip <= hi`` (both inclusive) on ``ip``.

    ``ranges`` are ranges or a table by block made of them.  ``columns`` maps range-table
    columns to output names; ``defaults`` fills addresses no range covers.
    """
    blocks = _range_table(ranges, list(columns))
    return _find(df, blocks, ip, {out: f"_{c}" for c, out in columns.items()}, defaults)


def with_code(df: DataFrame, ranges: DataFrame, out: str, ip: str = "ip") -> DataFrame:
    """Address to code as text; ``0`` when no range covers it."""
    return with_range(df, code_table(ranges), ip, {"code": out}, {out: F.lit("0")})


PLACE = ("isp", "prv", "area_pid", "area_cid")


def place_table(isp: DataFrame, prv: DataFrame, area: DataFrame | None = None) -> DataFrame:
    """Isp, province and area of every IPv4 address, by block: one lookup for all four.

    Uncovered addresses have code ``0``, and its area if there is one.
    """
    tables = {n: r.select("lo", "hi", F.col("code").cast("string").alias("value")) for n, r in (("_isp", isp), ("_prv", prv))}
    cut = pieces(tables, fill=True)
    cut = cut.select("_block", "_lo", "_hi", F.coalesce("_isp", F.lit("0")).alias("_isp"), F.coalesce("_prv", F.lit("0")).alias("_prv"))
    if area is None:
        return by_block(cut.withColumns({"_area_pid": F.lit("0"), "_area_cid": F.lit("0")}))
    ids = area.select(F.col("area_id").alias("_prv"), F.col("area_pid").alias("_area_pid"), F.col("area_cid").alias("_area_cid"))
    found = cut.join(ids, "_prv", "left")
    filled = {c: F.coalesce(c, F.lit("0")) for c in ("_area_pid", "_area_cid")}
    return by_block(found.withColumns(filled).select(*cut.columns, *filled))


def with_place(df: DataFrame, places: DataFrame, columns: tuple[str, ...] = ("isp", "prv"), ip: str = "ip") -> DataFrame:
    """Add columns of ``PLACE`` for an address; ``0`` where it has none."""
    return _find(df, places, ip, {c: f"_{c}" for c in columns}, {c: F.lit("0") for c in columns})


def locate(df: DataFrame, dims: Dims, columns: tuple[str, ...] = ("isp", "prv")) -> DataFrame:
    """``with_place`` from a job's lookups."""
    places = dims.places if dims.places is not None else place_table(dims.isp, dims.prv, dims.area)
    return with_place(df, places, columns)


def with_named(df: DataFrame, named: DataFrame, prefix: str, ip: str = "ip") -> DataFrame:
    """Address to isp, isp name and province name; not found is 0 / ``NULL``.

    The floor entry of non-overlapping ranges, bounded by its ``hi``, is the
    range that holds the address, so this is the same lookup.
    """
    cols = {"isp": f"{prefix}isp", "isp_name": f"{prefix}isp_name", "prv_name": f"{prefix}prv_name"}
    defaults = {
        f"{prefix}isp": F.lit(0),
        f"{prefix}isp_name": F.lit("NULL"),
        f"{prefix}prv_name": F.lit("NULL"),
    }
    return with_range(df, named, ip, cols, defaults)


def with_area(
    df: DataFrame, area: DataFrame, code: str = "prv", pid: str = "area_pid", cid: str = "area_cid"
) -> DataFrame:
    """Area of a province code; both ids default to ``0``."""
    dim = area.select(
        F.col("area_id").alias("_area"), F.col("area_pid").alias("_pid"), F.col("area_cid").alias("_cid")
    )
    joined = df.join(dim, F.col(code) == F.col("_area"), "left")
    return _with(joined, df, {pid: F.coalesce("_pid", F.lit("0")), cid: F.coalesce("_cid", F.lit("0"))})


MACHINE_TEXT = ["machine_isp", "machine_prv", "platform", "machine_ip"]
MACHINE_CODES = ["machine_isp_code", "machine_prv_code", "pop_id"]


def with_machine(df: DataFrame, machines: DataFrame, host: str = "machine") -> DataFrame:
    """Machine attributes; unknown hosts get ``-`` and 0."""
    names = MACHINE_TEXT + MACHINE_CODES
    dim = machines.select(F.col("host").alias("_host"), *[F.col(c).alias(f"_{c}") for c in names])
    outs = {c: F.coalesce(F.col(f"_{c}"), F.lit("-")) for c in MACHINE_TEXT}
    outs |= {c: F.coalesce(F.col(f"_{c}"), F.lit(0)) for c in MACHINE_CODES}
    return _with(df.join(dim, F.col(host) == F.col("_host"), "left"), df, outs)


def flag_parent(
    df: DataFrame, parents: DataFrame, up: str = "up", out: str = "up_is_parent"
) -> DataFrame:
    """Whether the upstream address is a parent cache."""
    dim = parents.select(F.col("ip").alias("_parent_ip"))
    joined = df.join(dim, F.col(up) == F.col("_parent_ip"), "left")
    return _with(joined, df, {out: F.col("_parent_ip").isNotNull()})


def client_host_isp(df: DataFrame, named: DataFrame, client: str = "ip", host: str = "host_ip") -> DataFrame:
    """Isp and province names of the client, ``other`` when the server's isp differs."""
    both = with_named(with_named(df, named, "c_", client), named, "h_", host)
    same = F.col("c_isp") == F.col("h_isp")
    return both.withColumns(
        {
            "isp": F.when(same, F.col("c_isp_name")).otherwise("other"),
            "province": F.when(same, F.col("c_prv_name")).otherwise("other"),
        }
    ).drop(*[f"{p}{c}" for p in ("c_", "h_") for c in ("isp", "isp_name", "prv_name")])


def with_ua_list(df: DataFrame, keywords: DataFrame, ua: str, out: str) -> DataFrame:
    """Agent class by a loaded keyword list, first keyword in list order wins.

    The list is one configuration row, read once as a scalar.
    """
    ordered = F.array_sort(F.collect_list(F.struct("ord", "keyword")))
    words = keywords.agg(F.transform(ordered, lambda x: x["keyword"]).alias("words")).scalar()
    return df.withColumn("_words", words).withColumn(out, agent.ua_from_list(F.col(ua), F.col("_words"))).drop("_words")
