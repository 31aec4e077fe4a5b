"""Registered parsers: the log rendered as raw lines and cut back into rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from accesslens.constants import HASH_USERID
from accesslens.functions import net
from accesslens.operators import parse, rollups
from accesslens.plans.oracle_view import (
    SUFFIX_BASE,
    dotted,
    five,
    part,
    path,
    sql,
    stamp,
    suffix,
    ua_device,
    ua_keyword,
)
from accesslens.plans.registry import register
from accesslens.schemas import ACCESS_LOG, BILLING, JSON_LOG, MACHINE

DAMAGED = "event_id % 100 = 7"
LOOP = "ip // 16777216 = 127"
GOOD = f"NOT ({LOOP}) AND NOT ({DAMAGED}) AND domain IS NOT NULL"
BAD = f"NOT ({LOOP}) AND (({DAMAGED}) OR domain IS NULL)"


def rows(parsed: DataFrame, names: list[str]) -> DataFrame:
    return parse.accepted(parsed).select("event_id", *names)


def bad_ids(parsed: DataFrame) -> DataFrame:
    return parsed.filter(parse.is_rejected()).select("event_id")


# --------------------------------------------------------- edge, powza, media
EDGE_SQL = f"""event_id, machine, ip, isp, prv, domain, path AS url, {suffix('path')} AS suffix, status, cs,
    CASE WHEN k % 4 = 0 THEN '-' ELSE 'ref.example.com' END AS refer, {ua_keyword('agent')} AS ua, es, hit,
    {stamp('ts_sec')} AS timestmp, (k % 2)::int AS dd, userid, '-' AS rk, up, fa AS "Fa", fv AS "Fv",
    CASE WHEN k % 2 = 0 THEN 'c06.i06' ELSE '-' END AS platform, node::varchar AS node"""
POWZA_SQL = f"""event_id, machine, ip, isp, prv, domain, path AS url, {suffix('path')} AS suffix, status, cs,
    '-' AS refer, {ua_keyword('agent')} AS ua, 0.0::double AS es, 'unkown' AS hit, {stamp('ts_sec')} AS timestmp,
    0 AS dd, userid, '-' AS rk, '-' AS up, '-' AS "Fa", '-' AS "Fv", '-' AS platform, node::varchar AS node"""
BILLING_SQL = """event_id, domain, isp, prv, area_pid, area_cid, cs, status, userid, ts_sec, '-' AS platform,
    0 AS pop_id, node, es"""


@register("parse_edge", sql("located", f"SELECT {EDGE_SQL} FROM located WHERE {GOOD}"))
def parse_edge(v):
    return rows(parse.edge(v.lines(v.edge_text()), v.dims), ACCESS_LOG.names)


@register("parse_edge_rejects", sql("located", f"SELECT event_id FROM located WHERE {BAD}"))
def parse_edge_rejects(v):
    return bad_ids(parse.edge(v.lines(v.edge_text()), v.dims))


@register("parse_powza", sql("located", f"SELECT {POWZA_SQL} FROM located WHERE {GOOD}"))
def parse_powza(v):
    return rows(parse.powza(v.lines(v.powza_text()), v.dims), ACCESS_LOG.names)


@register("parse_edge_billing", sql("billing", f"SELECT {BILLING_SQL} FROM billing WHERE {GOOD}"))
def parse_edge_billing(v):
    return rows(parse.edge_billing(v.lines(v.edge_text()), v.dims), BILLING.names)


@register("parse_powza_billing", sql("billing", f"SELECT {BILLING_SQL} FROM billing WHERE {GOOD}"))
def parse_powza_billing(v):
    return rows(parse.powza_billing(v.lines(v.powza_text()), v.dims), BILLING.names)


MEDIA_SQL = BILLING_SQL.replace("cs, status,", "cs, '0' AS status,").replace("node, es", "node, 0.0::double AS es")


@register("parse_media", sql("billing", f"SELECT {MEDIA_SQL} FROM billing WHERE {GOOD}"))
def parse_media(v):
    return rows(parse.media_billing(v.lines(v.media_text()), v.dims), BILLING.names)


@register(
    "parse_machine",
    sql(
        "mach",
        f"""SELECT event_id, machine, ts_sec, isp, prv, domain, status, hit_type, ua, '0' AS speed_interval, speed, es, cs,
        1 AS req_num, userid, zero_speed, platform, pop_id, machine_isp, machine_prv, machine_isp_code, machine_prv_code
        FROM mach WHERE NOT ({DAMAGED})""",
    ),
)
def parse_machine(v):
    return rows(parse.machine(v.lines(v.edge_text()), v.dims), MACHINE.names)


@register(
    "parse_dispatch",
    sql(
        "billing",
        f"""SELECT {BILLING_SQL} FROM billing WHERE {GOOD} AND event_id % 3 <> 2
        UNION ALL SELECT {MEDIA_SQL} FROM billing WHERE {GOOD} AND event_id % 3 = 2""",
    ),
)
def parse_dispatch(v):
    """Billing rows of a mixed stream of all three formats."""
    return rows(parse.dispatch_billing(v.lines(v.mixed_text()), v.dims), BILLING.names)


@register(
    "parse_dispatch_access",
    sql(
        "located",
        f"""SELECT {EDGE_SQL} FROM located WHERE {GOOD} AND event_id % 3 = 0
        UNION ALL SELECT {POWZA_SQL} FROM located WHERE {GOOD} AND event_id % 3 = 1""",
    ),
)
def parse_dispatch_access(v):
    """Wide rows of the same mixed lines; media lines have no wide form."""
    return rows(parse.dispatch_access(v.lines(v.mixed_text()), v.dims), ACCESS_LOG.names)


# ------------------------------------------------------------------ #_# lines
HASH_IP = "CASE WHEN event_id % 50 = 3 THEN 2130706433 ELSE ip END"
part(
    "hashed",
    "mapped dim_range",
    f"""
SELECT h.* EXCLUDE (isp_, prv_), coalesce(isp_, 0)::varchar AS isp, coalesce(prv_, 0)::varchar AS prv
FROM (SELECT m.*, r.isp AS isp_, p.prv AS prv_ FROM
  (SELECT * EXCLUDE (ip), {HASH_IP} AS ip,
          'cnc-tj-010-000-' || lpad((node // 256)::varchar, 3, '0') || '-' || lpad((node % 256)::varchar, 3, '0') AS hname,
          CASE WHEN k % 4 = 0 THEN substr(path, length(host) + 1) ELSE split_part(url, '?', 1) END AS asked,
          167772160 + node AS hnode
   FROM mapped) m
  LEFT JOIN dim_range r ON m.ip BETWEEN r.lo AND r.hi
  LEFT JOIN dim_range p ON m.ip BETWEEN p.lo + 30000000 AND p.hi - 30000000) h
""",
)
HASH_TAIL = f"""status, cs, '-' AS refer, {ua_device('agent')} AS ua, es, hit, {stamp('ts_sec')} AS timestmp, 0 AS dd,
    userid, '-' AS rk, '-' AS up, '-' AS "Fa", '-' AS "Fv", '-' AS platform, hnode::varchar AS node"""


@register(
    "parse_hash_v1",
    sql(
        "hashed",
        f"""SELECT event_id, hname AS machine, ip, isp, prv, domain, path AS url, {suffix('path', SUFFIX_BASE)} AS suffix,
        {HASH_TAIL} FROM hashed WHERE NOT ({DAMAGED}) AND domain IS NOT NULL""",
    ),
)
def parse_hash_v1(v):
    return rows(parse.hash_v1(v.lines(v.hash_text(bare_path=False)), v.dims), ACCESS_LOG.names)


HASH_GOOD = f"NOT ({DAMAGED}) AND event_id % 50 <> 3 AND domain IS NOT NULL"


@register(
    "parse_hash_v2",
    sql(
        "hashed",
        f"""SELECT event_id, hname AS machine, ip, isp, prv,
        CASE WHEN k % 5 = 0 THEN 'https_' || domain ELSE domain END AS domain, asked AS url,
        {suffix('asked', SUFFIX_BASE)} AS suffix, {HASH_TAIL} FROM hashed WHERE {HASH_GOOD}""",
    ),
)
def parse_hash_v2(v):
    return rows(parse.hash_v2(v.lines(v.hash_text(bare_path=True)), v.dims), ACCESS_LOG.names)


@register("parse_rejects", sql("hashed", f"SELECT event_id FROM hashed WHERE NOT ({HASH_GOOD})"))
def parse_rejects(v):
    """Loopback clients, damaged lines and unowned domains."""
    return bad_ids(parse.hash_v2(v.lines(v.hash_text(bare_path=True)), v.dims))


HASH_DIR_SQL = f"""SELECT event_id, host AS domain,
    '/' || CASE WHEN k % 4 = 0 THEN split_part(asked, '/', 2) WHEN url LIKE 'http:%' THEN split_part(url, '/', 4) ELSE '' END AS dir,
    {five('ts_sec')} AS timestamp, cs AS flow_size, CASE WHEN k % 5 = 0 THEN 'https' ELSE 'http' END AS https_flag
    FROM hashed WHERE NOT ({DAMAGED}) AND event_id % 50 <> 3"""
HASH_DIR_COLUMNS = ["domain", "dir", "timestamp", "flow_size", "https_flag"]


def hash_dir_rows(v):
    return rows(parse.hash_dir(v.lines(v.hash_text(bare_path=True))), HASH_DIR_COLUMNS)


@register("parse_hash_dir", sql("hashed", HASH_DIR_SQL))
def parse_hash_dir(v):
    return hash_dir_rows(v)


HASH_SUMS = "sum(flow_size)::bigint AS flow_size, count(*) AS req_count"


@register(
    "hash_dir_traffic_5m",
    sql("hashed", f"SELECT domain, dir, timestamp, https_flag, {HASH_SUMS} FROM ({HASH_DIR_SQL}) GROUP BY 1, 2, 3, 4"),
)
def hash_dir_traffic_5m(v):
    return rollups.hash_dir_traffic_5m(hash_dir_rows(v))


@register(
    "hash_traffic_5m",
    sql(
        "hashed",
        f"SELECT domain, timestamp, https_flag, {HASH_SUMS}, '{HASH_USERID}' AS userid FROM ({HASH_DIR_SQL}) GROUP BY 1, 2, 3",
    ),
)
def hash_traffic_5m(v):
    return rollups.hash_traffic_5m(hash_dir_rows(v))


# ----------------------------------------------------------------------- JSON
JSON_GOOD = f"url LIKE 'http://%' AND NOT ({DAMAGED}) AND domain IS NOT NULL"
# ids mod 40 with spoilt numbers: the strict form takes a number with a fraction for a whole one, and reads the status as a number
JSON_LOOSE, JSON_STRICT = "event_id % 40 NOT IN (11, 12, 13, 15)", "event_id % 40 NOT IN (11, 15, 16) AND event_id % 10 <> 4"


def json_sql(cond: str, cs: str) -> str:
    last = "list_last(string_split(url, '.'))"
    return sql(
        "located",
        f"""SELECT event_id, machine AS hostname, ip, isp, prv, domain, url AS ru,
        CASE WHEN {last} IN ({SUFFIX_BASE}) THEN {last} ELSE 'other' END AS suffix, status AS "Fs", {cs} AS cs, '' AS refer,
        {ua_device('agent')} AS ua, es, hit AS st, {stamp('ts_sec')} AS timestamp, 0 AS dd, userid, 8.047::double AS tl,
        'GET' AS rm, 'HTTP/1.1' AS rv, '-' AS rf, {dotted('ip')} AS a, ts_sec AS "timestampLong"
        FROM located WHERE {JSON_GOOD} AND {cond}""",
    )


@register("parse_json", json_sql(JSON_LOOSE, "CASE WHEN event_id % 10 = 4 THEN 0 ELSE cs END"))
def parse_json(v):
    return rows(parse.json(v.lines(v.json_text()), v.dims), JSON_LOG.names)


@register("parse_json_rejects", sql("located", f"SELECT event_id FROM located WHERE NOT ({JSON_GOOD} AND {JSON_LOOSE})"))
def parse_json_rejects(v):
    return bad_ids(parse.json(v.lines(v.json_text()), v.dims))


@register("parse_json_strict", json_sql(JSON_STRICT, "CASE WHEN event_id % 40 = 12 THEN 5 ELSE cs END"))
def parse_json_strict(v):
    return rows(parse.json_strict(v.lines(v.json_text()), v.dims), JSON_LOG.names)


# --------------------------------------------------- directories and slow rate
PATH_PARTS = f"string_split({path('url')}, '/')"


@register(
    "parse_dir",
    sql(
        "located",
        f"""SELECT event_id, domain, CASE WHEN len({PATH_PARTS}) > 2 THEN {PATH_PARTS}[2] ELSE '-' END AS dir1,
        CASE WHEN len({PATH_PARTS}) > 3 THEN {PATH_PARTS}[3] ELSE '-' END AS dir2,
        {stamp('ts_sec', '%Y%m%d%H%M')} AS timestmp, cs, '' AS pno, isp, prv FROM located WHERE {GOOD}""",
    ),
)
def parse_dir(v):
    names = ["domain", "dir1", "dir2", "timestmp", "cs", "pno", "isp", "prv"]
    return rows(parse.directories(v.lines(v.edge_text()), v.dims), names)


part(
    "slow",
    "log dim_domain dim_range",
    f"""
SELECT l.event_id, l.host AS domain, l.machine AS host,
       CASE WHEN coalesce(c.isp, 0) = coalesce(h.isp, 0) THEN coalesce(c.isp_name, 'NULL') ELSE 'other' END AS isp,
       CASE WHEN coalesce(c.isp, 0) = coalesce(h.isp, 0) THEN coalesce(c.prv_name, 'NULL') ELSE 'other' END AS province,
       {five('l.ts_sec')} AS time,
       CASE WHEN es > 0 AND cs::float / es::float * 1000 / 1024 < 100 THEN 1 ELSE 0 END AS "ifSlow"
FROM (SELECT *, CASE WHEN k % 3 = 0 THEN ip ELSE 16777216 + event_id * 7919 * 1003 % 3690987520 END AS host_ip FROM log) l
JOIN dim_domain d ON d.name = l.host AND NOT d.wildcard
LEFT JOIN dim_range c ON l.ip BETWEEN c.lo AND c.hi
LEFT JOIN dim_range h ON l.host_ip BETWEEN h.lo AND h.hi
WHERE event_id % 50 NOT IN (3, 4) AND NOT ({DAMAGED}) AND status NOT IN ('404', '504') AND cs >= 262144
""",
)


def slow_rows(v):
    listed = v.owners.filter(~F.col("wildcard")).select(F.col("name").alias("domain"))
    parsed = parse.slow_rate(v.lines(v.slow_text()), v.dims.named, listed)
    return rows(parsed, ["domain", "host", "isp", "province", "time", "ifSlow"])


@register("parse_slow_rate", sql("slow", "SELECT * FROM slow"))
def parse_slow_rate(v):
    return slow_rows(v)


SLOW_KEYS = "domain, host, isp, province, time"


@register("slow_rate_5m", sql("slow", f'SELECT {SLOW_KEYS}, "ifSlow", count(*) AS "count" FROM slow GROUP BY ALL'))
def slow_rate_5m(v):
    return rollups.slow_rate_5m(slow_rows(v))


@register(
    "slow_share_5m",
    sql("slow", f'SELECT {SLOW_KEYS}, avg("ifSlow") AS slow_share, count(*) AS "count" FROM slow GROUP BY ALL'),
)
def slow_share_5m(v):
    return rollups.slow_share_5m(slow_rows(v))


# -------------------------------------------------------------- line rewriting
TIME_SQL = f"CASE WHEN {DAMAGED} THEN '-' ELSE '[' || {stamp('ts_sec', '%d/%b/%Y:%H:%M:%S')} || ' +0000]' END"


def hash_rest(asked: str) -> str:
    """Everything after the machine name of a ``#_#`` line, in SQL."""
    return f"""host || '#_#' || CASE WHEN event_id % 50 = 3 THEN '127.0.0.1' ELSE {dotted('ip')} END || '#_#-#_#' || {TIME_SQL}
    || '#_#GET ' || {asked} || ' HTTP/1.1#_#' || status || '#_#' || cs::varchar || '#_#-#_#' || agent || '#_#' || es::bigint::varchar
    || '#_#0.000#_#10.0.0.1#_#' || hit || ' -#_#agent#_#' || cs::varchar || ' x#_#'
    || CASE WHEN k % 5 = 0 THEN 'https ' ELSE 'http ' END || {dotted('node')}"""


part("named", "log", "SELECT *, 'cnc-tj-010-000-' || lpad((node // 256)::varchar, 3, '0') || '-' || lpad((node % 256)::varchar, 3, '0') AS hname FROM log")


@register("strip_envelope", sql("named", f"SELECT event_id, 'LOG ' || hname || ' ' || {hash_rest('url')} AS value FROM named"))
def strip_envelope(v):
    lines = v.lines(v.hash_text(bare_path=False))
    return lines.select("event_id", net.strip_envelope(F.col("value")).alias("value"))


@register("envelope_platform", sql("log", "SELECT event_id, CASE WHEN k % 2 = 0 THEN 'c06.i06' ELSE '-' END AS platform FROM log"))
def envelope_platform(v):
    lines = v.lines(v.edge_text())
    tag = F.substring_index("value", " ", 1)
    return lines.select("event_id", net.envelope_platform(tag).alias("platform"))


@register(
    "trim_request_host",
    sql(
        "named",
        f"""SELECT event_id, CASE WHEN k % 2 = 1 THEN '@|@c06@|@68@|@POP_1@|@LOG ' || hname || ' @|@00000000@|@'
        ELSE 'LOG ' || hname || ' ' END || {hash_rest("substr(url, strpos(url, host) + length(host))")} AS value
        FROM named WHERE NOT ({DAMAGED})""",
    ),
)
def trim_request_host(v):
    lines = v.lines(v.hash_text(bare_path=True))
    return parse.trim_request_host(lines).select("event_id", "value")


@register("extract_original", sql("log", "SELECT event_id, 'line \"' || event_id::varchar || '\"' AS value FROM log"))
def extract_original(v):
    return parse.extract_original(v.lines(v.json_text())).select("event_id", "value")


@register("extract_original_raw", sql("log", "SELECT event_id, 'line \\\"' || event_id::varchar || '\\\"' AS value FROM log"))
def extract_original_raw(v):
    return parse.extract_original(v.lines(v.json_text()), raw=True).select("event_id", "value")


ACCESS_FORMAT = r'%>a %es %ss [%lt] \"%rm %ru %rv\" %Fs %cs \"%rf\" \"%ua\" %st %tl %dd %rk %up %Fa %Fv'


@register(
    "parse_by_format",
    sql(
        "log",
        f"""SELECT event_id, {dotted('ip')} AS ip, es::bigint::varchar AS es, '-' AS ss, trim({TIME_SQL}, '[]') AS lt,
        'GET ' || url || ' HTTP/1.1' AS rm_ru_rv, status AS fs, cs::varchar AS cs,
        CASE WHEN k % 4 = 0 THEN '-' ELSE 'http://ref.example.com/x' END AS rf, agent AS ua, hit AS st, '0.174' AS tl_es,
        (k % 2)::varchar AS dd, '-' AS rk, up, fa, fv FROM log""",
    ),
)
def parse_by_format(v):
    """Edge lines without tag and machine, read by their format string."""
    lines = v.lines(F.regexp_replace(v.edge_text(), "^[^ ]+ [^ ]+ ", ""))
    return parse.by_format(lines, ACCESS_FORMAT).drop("value", "arrival_sec")
