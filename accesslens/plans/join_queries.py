"""Registered lookups and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from accesslens.functions import net
from accesslens.operators import enrich, filters
from accesslens.plans.oracle_view import sql
from accesslens.plans.registry import register
from accesslens.plans.view import PRV_SHIFT


# -------------------------------------------------------------------- lookups
@register("join_domain", sql("mapped", "SELECT event_id, host, domain FROM mapped"))
def join_domain(v):
    return enrich.map_domain(v.log(), v.owners).select("event_id", "host", "domain")


@register("join_domain_user", sql("mapped", "SELECT event_id, domain, coalesce(userid, '') AS userid FROM mapped"))
def join_domain_user(v):
    named = enrich.map_domain(v.log(), v.owners).select("event_id", "domain")
    return enrich.domain_owner(named, v.owners)


@register(
    "join_area",
    sql(
        "located dim_area",
        """SELECT event_id, l.prv AS city, coalesce(area_pid, '0') AS prv, coalesce(area_cid, '0') AS country
        FROM located l LEFT JOIN dim_area a ON a.area_id = l.prv""",
    ),
)
def join_area(v):
    rows = enrich.with_code(v.events().select("event_id", "ip"), v.dims.prv, "city")
    return enrich.with_area(rows, v.dims.area, "city", "prv", "country").select("event_id", "city", "prv", "country")


MACHINE_COLUMNS = "machine_isp machine_isp_code machine_prv machine_prv_code platform machine_ip pop_id".split()


@register(
    "join_machine",
    sql(
        "log dim_machine",
        "SELECT event_id, machine, "
        + ", ".join(
            f"coalesce(d.{c}, {0 if 'code' in c or c == 'pop_id' else chr(39) + '-' + chr(39)}) AS {c}"
            for c in MACHINE_COLUMNS
        )
        + " FROM log LEFT JOIN dim_machine d ON d.host = machine",
    ),
)
def join_machine(v):
    rows = enrich.with_machine(v.log(pages=False, machine=True), v.dims.machines)
    return rows.select("event_id", "machine", *MACHINE_COLUMNS)


def code_sql(c: str, inset: int = 0) -> str:
    return sql(
        "log dim_range",
        f"""SELECT event_id, ip, coalesce(r.{c}, 0)::varchar AS {c}
        FROM log LEFT JOIN dim_range r ON ip BETWEEN lo + {inset} AND hi - {inset}""",
    )


@register("join_ip_isp", code_sql("isp"))
def join_ip_isp(v):
    return enrich.with_code(v.events().select("event_id", "ip"), v.dims.isp, "isp")


@register("join_ip_prv", code_sql("prv", PRV_SHIFT))
def join_ip_prv(v):
    return enrich.with_code(v.events().select("event_id", "ip"), v.dims.prv, "prv")


@register(
    "join_ip_named",
    sql(
        "log dim_range",
        """SELECT event_id, coalesce(r.isp, 0) AS c_isp, coalesce(isp_name, 'NULL') AS c_isp_name,
        coalesce(prv_name, 'NULL') AS c_prv_name FROM log LEFT JOIN dim_range r ON ip BETWEEN lo AND hi""",
    ),
)
def join_ip_named(v):
    return enrich.with_named(v.events().select("event_id", "ip"), v.dims.named, "c_").drop("ip")


@register(
    "join_client_host_isp",
    sql(
        "log dim_range",
        """SELECT event_id, CASE WHEN coalesce(c.isp, 0) = coalesce(h.isp, 0) THEN coalesce(c.isp_name, 'NULL') ELSE 'other' END AS isp,
        CASE WHEN coalesce(c.isp, 0) = coalesce(h.isp, 0) THEN coalesce(c.prv_name, 'NULL') ELSE 'other' END AS province
        FROM (SELECT *, 16777216 + event_id * 7919 * 1003 % 3690987520 AS host_ip FROM log) l
        LEFT JOIN dim_range c ON l.ip BETWEEN c.lo AND c.hi LEFT JOIN dim_range h ON l.host_ip BETWEEN h.lo AND h.hi""",
    ),
)
def join_client_host_isp(v):
    host = F.lit(16777216) + F.col("event_id") * 7919 * 1003 % 3690987520
    rows = v.events().select("event_id", "ip", host.alias("host_ip"))
    return enrich.client_host_isp(rows, v.dims.named).select("event_id", "isp", "province")


@register(
    "flag_parent",
    sql("log dim_parent", "SELECT event_id, up, p.ip IS NOT NULL AS up_is_parent FROM log LEFT JOIN dim_parent p ON p.ip = up"),
)
def flag_parent(v):
    return enrich.flag_parent(v.events().select("event_id", "up"), v.dims.parents)


# -------------------------------------------------------------------- filters
@register("filter_loopback", sql("log", "SELECT event_id, ip FROM log WHERE ip // 16777216 <> 127"))
def filter_loopback(v):
    rows = v.events().select("event_id", "ip", net.long_to_ip(F.col("ip")).alias("ip_text"))
    return filters.drop_loopback(rows).drop("ip_text")


@register("filter_known_domain", sql("owned", "SELECT event_id, domain FROM owned"))
def filter_known_domain(v):
    return v.owned().select("event_id", "domain")


def owned_hosts(v):
    """Names with an exact owner, as a plain list of domains."""
    return v.owners.filter(~F.col("wildcard")).select(F.col("name").alias("domain"))


IN_EXACT = "host IN (SELECT name FROM dim_domain WHERE NOT wildcard)"


@register("scan_domain_filter", sql("log dim_domain", f"SELECT event_id FROM log WHERE {IN_EXACT} AND k % 2 = 0"))
def scan_domain_filter(v):
    """Only plain lines have the domain between the second space and ``#_#``."""
    lines = v.lines(v.hash_text(bare_path=True))
    return filters.lines_of_hash_domains(lines, owned_hosts(v)).select("event_id")


@register("scan_dir_domains", sql("log dim_domain", f"SELECT event_id FROM log WHERE {IN_EXACT}"))
def scan_dir_domains(v):
    return filters.lines_of_url_domains(v.lines(v.edge_text()), owned_hosts(v)).select("event_id")


WATCHED = ["spam-farm.example.org", "www.cheap-pills.example.com"]


@register("scan_slow_domains", sql("log", f"SELECT event_id FROM log WHERE host IN ('{WATCHED[0]}', '{WATCHED[1]}')"))
def scan_slow_domains(v):
    return filters.lines_of_fixed_domains(v.lines(v.edge_text()), WATCHED).select("event_id")


@register(
    "scan_predicate",
    sql("log", "SELECT event_id FROM log WHERE status = '206'"),
)
def scan_predicate(v):
    """A user predicate on the raw line, before any parsing."""
    lines = v.lines(v.edge_text())
    return filters.keep(lines, lambda df: df["value"].rlike('HTTP/1.1" 206 ')).select("event_id")


@register("filter_substring", sql("log", "SELECT event_id FROM log WHERE contains(url, 'example.org/en/')"))
def filter_substring(v):
    return filters.containing(v.lines(v.edge_text()), "example.org/en/").select("event_id")


MONITORED_SQL = "domain IN (SELECT name FROM dim_domain WHERE NOT wildcard AND userid::int % 3 = 0)"


@register("filter_monitored", sql("owned dim_domain", f"SELECT event_id, domain FROM owned WHERE {MONITORED_SQL}"))
def filter_monitored(v):
    listed = v.owners.filter(~F.col("wildcard") & (F.col("userid").cast("int") % 3 == 0))
    return filters.monitored(v.owned(), listed.select(F.col("name").alias("domain"))).select("event_id", "domain")


@register("filter_users", sql("owned", "SELECT event_id, userid FROM owned WHERE userid::int < 10"))
def filter_users(v):
    users = v.owners.filter("cast(userid as int) < 10").select("userid")
    return filters.of_users(v.owned(), users).select("event_id", "userid")


@register(
    "filter_known_area",
    sql("located dim_area", "SELECT event_id, prv FROM located WHERE prv IN (SELECT area_id FROM dim_area)"),
)
def filter_known_area(v):
    rows = enrich.with_code(v.events().select("event_id", "ip"), v.dims.prv, "prv")
    return filters.known_area(rows, v.dims.area).select("event_id", "prv")


@register("split_on_time", sql("log", "SELECT event_id, ts_sec, arrival_sec FROM log WHERE arrival_sec <= ts_sec + 600"))
def split_on_time(v):
    return filters.on_time(v.events().select("event_id", "ts_sec", "arrival_sec"))


@register("split_late", sql("log", "SELECT event_id, ts_sec, arrival_sec FROM log WHERE arrival_sec > ts_sec + 600"))
def split_late(v):
    return filters.late(v.events().select("event_id", "ts_sec", "arrival_sec"))
