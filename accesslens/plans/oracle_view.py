"""The view of ``view.LogView`` in SQL: named table expressions, put together on demand."""

from __future__ import annotations

from accesslens.constants import SUFFIXES_BASE, SUFFIXES_EDGE, UA_KEYWORDS, UA_MOBILE, UA_PC, UA_TV

PARTS: dict[str, tuple[str, str]] = {}  # name -> (tables it reads, body)


def part(name: str, needs: str, body: str) -> None:
    PARTS[name] = (needs, body)


def sql(needs: str, body: str) -> str:
    """``body`` with the named parts it needs, and theirs, in front."""
    order: list[str] = []

    def add(names: str) -> None:
        for n in names.split():
            if n not in order:
                add(PARTS[n][0])
                order.append(n)

    add(needs)
    ctes = ",\n".join(f"{n} AS (\n{PARTS[n][1].strip()}\n)" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


def host(url: str) -> str:
    return f"regexp_extract({url}, '://([^/]*)', 1)"


def path(url: str) -> str:
    return f"regexp_extract({url}, '://([^?]*)', 1)"


def parent(h: str) -> str:
    return f"substr({h}, strpos({h}, '.') + 1)"


def dotted(n: str) -> str:
    return (
        f"(({n}) // 16777216)::varchar || '.' || ((({n}) // 65536) % 256)::varchar || '.' || "
        f"((({n}) // 256) % 256)::varchar || '.' || (({n}) % 256)::varchar"
    )


def speed(es: str, cs: str) -> str:
    raw = f"(({cs})::bigint // 1024) // ({es})::bigint * 1000"
    return (
        f"(CASE WHEN ({es})::bigint <> 0 AND ({cs}) <> 0 AND {raw} BETWEEN 5 AND 10240 "
        f"THEN {raw} ELSE 0 END)::bigint"
    )


def five(t: str) -> str:
    return f"(({t}) // 300 * 300 + 300)"


def minute(t: str) -> str:
    return f"(({t}) // 60 * 60)"


def hour(t: str) -> str:
    return f"(({t}) // 3600 * 3600)"


def stamp(t: str, fmt: str = "%Y%m%d%H%M%S") -> str:
    return f"strftime(make_timestamp(({t}) * 1000000), '{fmt}')"


def quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


SUFFIX_BASE = quoted(SUFFIXES_BASE)
SUFFIX_EDGE = quoted(SUFFIXES_EDGE)


def suffix(p: str, words: str = SUFFIX_EDGE) -> str:
    last = f"lower(list_last(string_split({p}, '.')))"
    return f"CASE WHEN contains({p}, '.') AND {last} IN ({words}) THEN {last} ELSE 'other' END"


def ua_keyword(ua: str) -> str:
    cases = " ".join(f"WHEN contains(lower({ua}), '{w}') THEN '{w}'" for w in UA_KEYWORDS)
    return f"CASE {cases} ELSE 'other' END"


def ua_device(ua: str) -> str:
    low = f"lower({ua})"
    return (
        f"CASE WHEN regexp_matches({low}, '{'|'.join(UA_TV)}') THEN 'tv' "
        f"WHEN regexp_matches({low}, '{'|'.join(UA_MOBILE)}') THEN 'mobile' "
        f"WHEN regexp_matches({low}, '{'|'.join(UA_PC)}') THEN 'pc' ELSE 'other' END"
    )


# ---------------------------------------------------------------- log rows
part(
    "log",
    "",
    f"""
SELECT e.event_id, e.user_id, e.k, e.ts_sec, e.page_id, e.ip, e.node, e.cs, e.es, e.status, e.hit,
       e.up, e.fa, e.fv, e.agent, e.arrival_sec, p.url,
       {host('p.url')} AS host, {path('p.url')} AS path,
       coalesce(s.s_name, '-') AS machine
FROM (
  SELECT event_id, user_id, k, ts_sec, event_id % np.n AS page_id,
         16777216 + ((user_id * 7919 + event_id * 104729) * 2557) % 3690987520 AS ip,
         event_id % (ns.n + 1) AS node,
         floor(value * 65536)::bigint AS cs,
         ((event_id * 37) % 20011)::double AS es,
         CASE event_type WHEN 'view' THEN '200' WHEN 'click' THEN '206' WHEN 'purchase' THEN '304'
              WHEN 'signup' THEN '404' WHEN 'error' THEN '504' END AS status,
         CASE k % 3 WHEN 0 THEN 'FCACHE_HIT_MEM' WHEN 1 THEN 'FCACHE_MISS' ELSE '-' END AS hit,
         CASE WHEN k % 5 = 0 THEN '-' ELSE '10.0.0.' || (k % 20)::varchar END AS up,
         CASE WHEN k % 7 = 0 THEN '-' ELSE '10.1.0.' || (k % 20)::varchar END AS fa,
         CASE WHEN k % 2 = 0 THEN 'HIT' ELSE 'MISS' END AS fv,
         CASE user_id % 6 WHEN 0 THEN 'Mozilla/5.0 (Linux; Android 5.1.1; Mobile Safari)'
              WHEN 1 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 9_3_4)'
              WHEN 2 THEN 'MIUI/7 Android 4.4 Browser'
              WHEN 3 THEN 'Mozilla/5.0 (Windows NT 6.1) Chrome/50.0'
              WHEN 4 THEN 'Mozilla/5.0 (X11; Linux x86_64) Firefox/43.0'
              ELSE 'curl/7.19.7' END AS agent,
         ts_sec + (event_id * 13) % 1200 AS arrival_sec
  FROM (SELECT *, regexp_extract(props, '"k": (\\d+)', 1)::bigint AS k,
               1704067200 + (epoch_us(ts) // 1000000 - 1704067200) % 7200 AS ts_sec FROM events) ev,
       (SELECT count(*) AS n FROM pages) np, (SELECT count(*) AS n FROM supplier) ns
) e
JOIN pages p ON p.page_id = e.page_id
LEFT JOIN supplier s ON s.s_suppkey = e.node - 1
""",
)

# --------------------------------------------------------------- dimensions
part(
    "dim_domain",
    "",
    f"""
SELECT host AS name, false AS wildcard, (p % 20)::varchar AS userid FROM hosts_ WHERE p % 2 = 0
UNION ALL
SELECT {parent('host')}, true, (min(p) % 20)::varchar FROM hosts_
WHERE p % 2 = 1 AND length(host) - length(replace(host, '.', '')) >= 3 AND p % 3 = 0 GROUP BY 1
""",
)
part("hosts_", "", f"SELECT {host('url')} AS host, min(page_id) AS p FROM pages GROUP BY 1")
PARTS["dim_domain"] = ("hosts_", PARTS["dim_domain"][1])
part(
    "dim_range",
    "",
    """
SELECT 16777216 + n_nationkey::bigint * 147639500 AS lo, 16777216 + n_nationkey::bigint * 147639500 + 140000000 AS hi,
       11 + n_nationkey % 9 AS isp, n_nationkey AS prv, 'ISP_' || (11 + n_nationkey % 9)::varchar AS isp_name,
       n_name AS prv_name FROM nation
""",
)
part(
    "dim_area",
    "",
    """
SELECT n_nationkey::varchar AS area_id, n_regionkey::varchar AS area_pid,
       CASE WHEN n_nationkey % 2 = 0 THEN '10' ELSE '20' END AS area_cid
FROM nation WHERE n_nationkey % 7 <> 6
""",
)
part(
    "dim_machine",
    "",
    f"""
SELECT s_name AS host, r_name AS machine_isp, r_regionkey + 10 AS machine_isp_code, n_name AS machine_prv,
       n_nationkey + 8600 AS machine_prv_code, 'c0' || r_regionkey::varchar AS platform,
       {dotted('167772160 + s_suppkey')} AS machine_ip, s_suppkey::int AS pop_id
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""",
)
part(
    "dim_parent",
    "",
    "SELECT '10.0.0.' || i::varchar AS ip FROM (SELECT unnest([r_regionkey * 2, r_regionkey * 2 + 1]) AS i FROM region)",
)

# -------------------------------------------------------------- row families
part(
    "mapped",
    "log dim_domain",
    f"""
SELECT l.*, CASE WHEN x.name IS NOT NULL THEN x.name WHEN w.name IS NOT NULL THEN 'ext.' || w.name END AS domain,
       CASE WHEN x.name IS NOT NULL THEN x.userid ELSE w.userid END AS userid
FROM log l
LEFT JOIN dim_domain x ON x.name = l.host AND NOT x.wildcard
LEFT JOIN dim_domain w ON w.name = {parent('l.host')} AND w.wildcard
""",
)
part(
    "located",
    "mapped dim_range",
    """
SELECT m.*, coalesce(r.isp, 0)::varchar AS isp, coalesce(p.prv, 0)::varchar AS prv
FROM mapped m LEFT JOIN dim_range r ON m.ip BETWEEN r.lo AND r.hi
LEFT JOIN dim_range p ON m.ip BETWEEN p.lo + 30000000 AND p.hi - 30000000
""",
)
part("owned", "located", "SELECT * FROM located WHERE domain IS NOT NULL")
part(
    "billing",
    "owned dim_area",
    """
SELECT o.*, coalesce(a.area_pid, '0') AS area_pid, coalesce(a.area_cid, '0') AS area_cid
FROM owned o LEFT JOIN dim_area a ON a.area_id = o.prv
""",
)
part(
    "mach",
    "owned dim_machine dim_parent dim_area",
    f"""
SELECT *, CASE WHEN speed = 0 THEN 1 ELSE 0 END AS zero_speed FROM (
SELECT o.event_id, o.machine, o.ts_sec, o.arrival_sec, o.isp, o.prv, o.domain, o.userid, o.status, o.es, o.cs, o.k,
       {ua_keyword('o.agent')} AS ua, {speed('o.es', 'o.cs')} AS speed,
       CASE WHEN contains(lower(o.hit), 'hit') THEN 0
            WHEN contains(lower(o.hit), 'miss') THEN
              CASE WHEN length(o.up) = 1 OR p.ip IS NULL THEN 2 WHEN o.fv = 'HIT' THEN 1 ELSE 3 END
            ELSE 4 END AS hit_type,
       coalesce(d.machine_isp, '-') AS machine_isp, coalesce(d.machine_isp_code, 0) AS machine_isp_code,
       coalesce(d.machine_prv, '-') AS machine_prv, coalesce(d.machine_prv_code, 0) AS machine_prv_code,
       coalesce(d.platform, '-') AS platform, coalesce(d.pop_id, 0) AS pop_id, coalesce(d.machine_ip, '-') AS machine_ip,
       coalesce(a.area_pid, '0') AS area_pid, coalesce(a.area_cid, '0') AS area_cid, a.area_id IS NOT NULL AS known_area
FROM owned o LEFT JOIN dim_machine d ON d.host = o.machine
LEFT JOIN dim_parent p ON p.ip = o.up
LEFT JOIN dim_area a ON a.area_id = o.prv)
""",
)
