"""Registered dimension loads: lines rendered from the tables, loaded back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from accesslens.plans.oracle_view import host, sql
from accesslens.plans.registry import register
from accesslens.sources import dims


def _csv(*cells: Column | str) -> Column:
    return F.concat_ws(",", *cells)


def domain_lines(v) -> DataFrame:
    """Two lines per name: the first with an outdated user, the second counts."""
    d = v.domains.withColumn("name", F.when(F.col("wildcard"), F.concat(F.lit("ext."), "name")).otherwise(F.col("name")))
    kind = F.when(F.col("wildcard"), "2").otherwise("1")
    line = _csv("name", F.lit("x"), kind, F.lit("a"), F.lit("b"), F.lit("c"), "user")
    old = F.struct(F.lit(0).alias("pos"), F.lit("old").alias("user"))
    new = F.struct(F.lit(1).alias("pos"), F.col("userid").alias("user"))
    both = F.explode(F.array(old, new))
    return d.select("name", "wildcard", both.alias("b")).select("name", "wildcard", "b.pos", "b.user").select(
        line.alias("value"), "pos"
    )


@register("dim_domain_load", sql("dim_domain", "SELECT name, wildcard, userid FROM dim_domain"))
def dim_domain_load(v):
    return dims.load_domains(domain_lines(v))


@register(
    "dim_user_domains",
    sql("dim_domain", "SELECT DISTINCT name AS domain FROM dim_domain WHERE userid IN ('1', '4', '9')"),
)
def dim_user_domains(v):
    return dims.user_domains(dims.load_domains(domain_lines(v)), ["1", "4", "9"])


def _ranges(v) -> DataFrame:
    return v.ranges.withColumn("pos", F.col("n_nationkey"))


@register(
    "dim_range_load",
    sql("dim_range", 'SELECT lo, hi, isp AS code FROM dim_range WHERE prv % 8 <> 3'),
)
def dim_range_load(v):
    """Nations 3 mod 8 lose their last field and with it their range.

    Every range also has an older line of another code, an inverted one, one with an end beyond all
    addresses and one with a negative start.
    """
    n, lo, hi = F.col("n_nationkey"), F.col("lo").cast("string"), F.col("hi").cast("string")
    code = F.when(n % 8 != 3, (n % 9 + 11).cast("string"))
    texts = [
        F.concat_ws(" ", lo, hi, F.lit("99")),
        F.concat_ws(" ", hi, lo, F.lit("98")),
        F.concat_ws(" ", lo, F.lit("9000000000000000000 97")),
        F.concat_ws(" ", F.lit("-1"), hi, F.lit("96")),
        F.concat_ws(" ", lo, hi, code),
    ]
    kept = F.when(n % 8 == 3, F.slice(F.array(*texts), 2, 4)).otherwise(F.array(*texts))
    lines = _ranges(v).select(F.posexplode(kept).alias("line", "value"), "pos")
    return dims.load_ranges(lines.select("value", F.struct("pos", "line").alias("pos")))


@register("dim_named_range_load", sql("dim_range", "SELECT lo, hi, isp, isp_name, prv, prv_name FROM dim_range"))
def dim_named_range_load(v):
    """Blank lines between the ranges are skipped."""
    named = v.named_ranges
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in ("lo", "hi", "isp", "isp_name", "prv", "prv_name")])
    lines = named.select(F.explode(F.array(F.lit("  "), line)).alias("value"), F.col("prv").alias("pos"))
    return dims.load_named_ranges(lines)


@register("dim_area_load", sql("dim_area", "SELECT area_id, area_pid, area_cid FROM dim_area"))
def dim_area_load(v):
    """A header and a two-field line come with every row."""
    rows = v.area.select(
        F.explode(F.array(F.lit("area_id,area_pid,area_cid"), _csv("area_id", "area_pid", "area_cid"), _csv("area_id", "area_pid"))).alias("value"),
        F.lit(0).alias("pos"),
    )
    return dims.load_area(rows)


@register(
    "dim_machine_load",
    sql(
        "dim_machine",
        """SELECT host, machine_isp, machine_isp_code, machine_prv, machine_prv_code, platform, machine_ip, pop_id
        FROM dim_machine WHERE pop_id % 10 <> 3
        UNION ALL SELECT '-', '-', 0, '-', 0, '-', '-', 0""",
    ),
)
def dim_machine_load(v):
    """Hosts 3 mod 10 have a malformed code; every host also has an older line."""
    code = F.when(F.col("pop_id") % 10 == 3, "x").otherwise(F.col("machine_isp_code").cast("string"))
    tail = ["machine_prv", F.col("machine_prv_code").cast("string"), "platform", "machine_ip", F.col("pop_id").cast("string"), F.lit("1")]
    new = F.struct(F.lit(1).alias("pos"), _csv("host", "machine_isp", code, *tail).alias("value"))
    old = F.struct(F.lit(0).alias("pos"), _csv("host", F.lit("OLD"), code, *tail).alias("value"))
    return dims.load_machines(v.machines.select(F.explode(F.array(old, new)).alias("l")).select("l.value", "l.pos"))


@register("dim_parent_load", sql("dim_parent", "SELECT ip FROM dim_parent"))
def dim_parent_load(v):
    """Each address twice, and once with a second field that drops the line."""
    ip = F.col("ip")
    lines = v.parents.select(F.explode(F.array(ip, ip, F.concat(F.lit("9."), ip, F.lit(",x")))).alias("value"), F.lit(0).alias("pos"))
    return dims.load_parents(lines)


@register(
    "dim_user_filter",
    "SELECT DISTINCT u AS userid FROM (SELECT unnest([n_nationkey::varchar, n_regionkey::varchar]) AS u FROM nation)",
)
def dim_user_filter(v):
    line = F.concat(F.lit(" "), _csv(F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")), F.lit(" "))
    return dims.load_user_filter(v.table("nation").select(line.alias("value"), F.col("n_nationkey").alias("pos")))


UA_LINES = {0: "safari,android", 1: "cpu", 2: "x86_64", 3: "curl"}


def ua_lines(v) -> DataFrame:
    """Keyword lines, one per region; the last region has a keyword nobody sends."""
    r = F.col("r_regionkey")
    value = F.coalesce(*[F.when(r == k, w) for k, w in UA_LINES.items()], F.lower("r_name"))
    return v.table("region").select(value.alias("value"), r.alias("pos"))


@register(
    "dim_ua_keywords",
    """SELECT r_regionkey AS line, i AS place, w AS keyword FROM (
      SELECT r_regionkey, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (
        SELECT r_regionkey, string_split(CASE r_regionkey WHEN 0 THEN 'safari,android' WHEN 1 THEN 'cpu'
        WHEN 2 THEN 'x86_64' WHEN 3 THEN 'curl' ELSE lower(r_name) END, ',') AS ws FROM region))""",
)
def dim_ua_keywords(v):
    words = dims.load_ua_keywords(ua_lines(v))
    return words.select(F.col("ord.pos").alias("line"), F.col("ord.place").alias("place"), "keyword")


@register(
    "dim_monitor_domains",
    f"""SELECT unnest([{host('url')}, 'www.' || {host('url')}]) AS domain FROM pages
    WHERE page_id = (SELECT max(page_id) FROM pages)""",
)
def dim_monitor_domains(v):
    """One list per page; only the last one counts."""
    line = _csv("host", F.concat(F.lit("www."), "host"))
    return dims.load_monitor_domains(v.page_hosts.select(line.alias("value"), F.col("page_id").alias("pos")))


@register("dim_dir_domains", f"SELECT DISTINCT {host('url')} AS domain FROM pages")
def dim_dir_domains(v):
    head = F.lit('{"status":1,"info":"ok","result":{"domain_schema":{"a":0},"Schema_Desc":{"a":"x"},"')
    doc = F.concat(head, "host", F.lit('":["1","3037",{"deep":1}]}}'))
    return dims.load_dir_domains(v.page_hosts.select(doc.alias("value"), F.col("page_id").alias("pos")))
