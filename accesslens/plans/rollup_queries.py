"""Registered roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from accesslens.functions import agent, net, timing
from accesslens.operators import filters, rollups
from accesslens.plans.oracle_view import five, hour, minute, parent, path, speed, sql, stamp, ua_keyword
from accesslens.plans.registry import register

BATCH_SEC = 1704074400
FLOW_SQL = "sum(cs)::bigint AS flow_size, count(*) AS req_count"


def watched_users(v):
    """User ids 0 to 9, read off the domain table."""
    return v.owners.filter("cast(userid as int) < 10").select("userid")


# --------------------------------------------------------------- five minutes
@register(
    "domain_traffic_5m",
    sql("owned", f"SELECT domain, userid, {five('ts_sec')} AS timestamp, {FLOW_SQL} FROM owned GROUP BY 1, 2, 3"),
)
def domain_traffic_5m(v):
    return rollups.traffic_by_domain(v.log(), v.owners, [], timing.five_label(F.col("ts_sec")))


@register(
    "user_status_traffic_5m",
    sql(
        "owned",
        f"""SELECT domain, userid, status AS status_code, {five('ts_sec')} AS timestamp, {FLOW_SQL}
        FROM owned WHERE userid::int < 10 GROUP BY 1, 2, 3, 4""",
    ),
)
def user_status_traffic_5m(v):
    return rollups.traffic_by_domain(
        v.log(),
        v.owners,
        ["status"],
        timing.five_label(F.col("ts_sec")),
        keep=lambda df: filters.of_users(df, watched_users(v)),
    ).withColumnRenamed("status", "status_code")


@register(
    "status_count_5m",
    sql(
        "owned",
        f"""SELECT domain, userid, status AS status_code, {five('ts_sec')} AS timestamp, count(*) AS req_count
        FROM owned GROUP BY 1, 2, 3, 4""",
    ),
)
def status_count_5m(v):
    counts = rollups.traffic_by_domain(v.log(), v.owners, ["status"], timing.five_label(F.col("ts_sec")))
    return counts.drop("flow_size").withColumnRenamed("status", "status_code")


@register(
    "platform_traffic_5m",
    sql(
        "billing",
        f"""SELECT domain, userid, isp, prv, area_pid, area_cid, status, {five('ts_sec')} AS timestamp,
        '-' AS "platformName", 0 AS "popID", {FLOW_SQL} FROM billing GROUP BY ALL""",
    ),
)
def platform_traffic_5m(v):
    return rollups.platform_traffic_5m(v.billing())


@register(
    "isp_prv_traffic_5m",
    sql(
        "billing",
        f"""SELECT domain, userid, isp, prv, area_pid, {five('ts_sec')} AS timestamp, {FLOW_SQL}
        FROM billing GROUP BY ALL""",
    ),
)
def isp_prv_traffic_5m(v):
    return rollups.isp_prv_traffic_5m(v.billing())


# ----------------------------------------------------------------- node speed
NODE = "isp, prv, node"
LARGE = "cs >= 3145728 AND node <> 0 AND es > 0 AND es < 20000000"
NODE_SUMS = 'sum(cs)::bigint AS cs, sum(es) AS es, count(*) AS "count"'
MEDIAN = "quantile_disc(cs / es, 0.5 ORDER BY cs / es)"


@register(
    "node_speed_5m",
    sql(
        "owned",
        f"""SELECT {NODE}, {five('ts_sec')} AS timestamp, {NODE_SUMS} FROM owned
        WHERE node <> 0 AND es > 0 AND es < 20000 GROUP BY ALL""",
    ),
)
def node_speed_5m(v):
    return rollups.node_speed_5m(v.located(v.owned()))


@register(
    "node_speed_large_5m",
    sql("owned", f"SELECT {NODE}, {five('ts_sec')} AS timestamp, {NODE_SUMS} FROM owned WHERE {LARGE} GROUP BY ALL"),
)
def node_speed_large_5m(v):
    return rollups.node_speed_large_5m(v.located(v.owned()))


MEDIAN_SQL = f"""
SELECT {NODE}, cs / es AS speed FROM (
  SELECT *, row_number() OVER (PARTITION BY {NODE} ORDER BY cs / es DESC) AS rn,
         count(*) OVER (PARTITION BY {NODE}) AS n
  FROM owned WHERE {LARGE}) WHERE rn = n // 2 + 1
"""


@register("node_speed_median", sql("owned", MEDIAN_SQL))
def node_speed_median(v):
    return rollups.node_speed_median(v.located(v.owned()))


@register("node_speed_median_rank", sql("owned", MEDIAN_SQL))
def node_speed_median_rank(v):
    return rollups.node_speed_median_rank(v.located(v.owned()))


@register(
    "node_speed_join",
    sql(
        "owned",
        f"""SELECT a.isp, a.prv, a.node, {BATCH_SEC // 300 * 300 + 300}::bigint AS timestamp, a.cs, a.es, a."count", m.speed
        FROM (SELECT {NODE}, {NODE_SUMS} FROM owned WHERE {LARGE} GROUP BY ALL) a
        JOIN ({MEDIAN_SQL}) m USING (isp, prv, node)""",
    ),
)
def node_speed_join(v):
    return rollups.node_speed_join(v.located(v.owned()), BATCH_SEC)


# -------------------------------------------------------------- hits, machines
ON_TIME, LATE = "arrival_sec <= ts_sec + 600", "arrival_sec > ts_sec + 600"


def hit_sql(cond: str, label: str) -> str:
    return sql(
        "mach",
        f"""SELECT domain, isp, prv AS city, area_pid AS prv, area_cid AS country,
        CASE WHEN hit_type = 3 THEN 1 ELSE hit_type END AS hit_type, userid, timestamp,
        {speed('es', 'flow_size')}::int AS speed_size, es, flow_size, req_count, "zeroSpeedReqNum"
        FROM (SELECT domain, isp, prv, area_pid, area_cid, hit_type, userid, {label} AS timestamp, sum(es) AS es,
              sum(cs)::bigint AS flow_size, count(*) AS req_count, sum(zero_speed)::bigint AS "zeroSpeedReqNum"
              FROM mach WHERE {cond} GROUP BY ALL)""",
    )


@register("hit_traffic_1m", hit_sql(ON_TIME, minute("ts_sec")))
def hit_traffic_1m(v):
    return rollups.hit_traffic_1m(v.hit_rows(), v.dims.area)


@register("late_hit_traffic_1h", hit_sql(LATE, hour("ts_sec")))
def late_hit_traffic_1h(v):
    return rollups.late_hit_traffic_1h(v.hit_rows(), v.dims.area)


@register("late_hit_traffic_5m", hit_sql(LATE, five("ts_sec")))
def late_hit_traffic_5m(v):
    return rollups.late_hit_traffic_5m(v.hit_rows(), v.dims.area)


@register(
    "status_traffic_1s",
    sql(
        "mach",
        f"""SELECT domain, isp, prv AS city, area_pid AS prv, area_cid AS country, ts_sec AS timestamp,
        status AS status_code, userid, {FLOW_SQL} FROM mach GROUP BY ALL""",
    ),
)
def status_traffic_1s(v):
    return rollups.status_traffic_1s(v.located(v.owned()), v.dims.area)


PLATFORM_SQL = 'max(platform) AS platform, max(pop_id)::varchar AS "popId"'
MACHINE_SQL = 'machine AS "machineName", machine_isp AS "machineIsp", machine_prv AS "machinePrv"'


@register(
    "machine_flow_1m",
    sql(
        "mach",
        f"""SELECT * EXCLUDE (code) FROM (SELECT {MACHINE_SQL}, domain, isp, prv AS code, area_pid AS prv,
        {minute('ts_sec')} AS timestamp, sum(cs)::bigint AS "flowSize", {PLATFORM_SQL},
        max(machine_isp_code)::varchar AS "machineIspCode", max(machine_prv_code)::varchar AS "machinePrvCode"
        FROM mach WHERE known_area AND {ON_TIME} GROUP BY ALL)""",
    ),
)
def machine_flow_1m(v):
    return rollups.machine_flow_1m(v.machine_rows(columns=("isp", "prv")), v.dims.area)


@register(
    "machine_hit_1m",
    sql(
        "mach",
        f"""SELECT {MACHINE_SQL}, domain, hit_type AS "hitType", {minute('ts_sec')} AS timestamp,
        count(*) AS "reqCount", sum(cs)::bigint AS "flowSize", {PLATFORM_SQL}
        FROM mach WHERE known_area AND {ON_TIME} GROUP BY ALL""",
    ),
)
def machine_hit_1m(v):
    return rollups.machine_hit_1m(v.machine_rows(hits=True, columns=("prv",)), v.dims.area)


def machine_speed_sql(cond: str) -> str:
    return f"""SELECT {MACHINE_SQL}, domain, hit_type AS "hitType", {minute('ts_sec')} AS timestamp,
        count(*) AS "reqCount", sum(speed)::bigint AS speed, {PLATFORM_SQL}
        FROM mach WHERE speed <> 0 AND {cond} GROUP BY ALL"""


@register("machine_speed_1m", sql("mach", machine_speed_sql(ON_TIME)))
def machine_speed_1m(v):
    return rollups.machine_speed_1m(v.machine_rows(hits=True))


@register(
    "late_machine_speed_hour",
    sql("mach", f"SELECT * REPLACE ({hour('timestamp')} AS timestamp) FROM ({machine_speed_sql(LATE)})"),
)
def late_machine_speed_hour(v):
    return rollups.late_machine_speed_hour(v.machine_rows(hits=True))


def machine_status_sql(cond: str) -> str:
    return f"""SELECT {MACHINE_SQL}, status AS "statusCode", {minute('ts_sec')} AS timestamp,
        count(*) AS "reqCount", {PLATFORM_SQL} FROM mach WHERE {cond} GROUP BY ALL"""


@register("machine_status_1m", sql("mach", machine_status_sql(ON_TIME)))
def machine_status_1m(v):
    return rollups.machine_status_1m(v.machine_rows())


@register(
    "late_machine_status_hour",
    sql("mach", f"SELECT * REPLACE ({hour('timestamp')} AS timestamp) FROM ({machine_status_sql(LATE)})"),
)
def late_machine_status_hour(v):
    return rollups.late_machine_status_hour(v.machine_rows())


# ------------------------------------------------------------ flags, agents
@register(
    "client_speed_flag",
    sql(
        "billing",
        f"""SELECT c.machine AS hostname, c.domain, c.area_pid AS prv, c.isp, c.ip, c.userid, c.ratio,
        {minute('c.ts_sec')} AS timestamp, {five(minute('c.ts_sec'))} AS fivetime, c.serverip,
        coalesce(r.isp, 0)::varchar AS serverisp, c.n AS "count"
        FROM (SELECT machine, domain, prv, area_pid, isp, ip, userid, ts_sec,
              CASE WHEN cs <> 0 AND es <> 0 AND (cs // 1024)::double / es * 1000 < 80 THEN '0' ELSE '1' END AS ratio,
              CASE WHEN fa <> '-' THEN 167837696 + split_part(fa, '.', 4)::bigint END AS serverip, count(*) AS n
              FROM billing GROUP BY ALL) c
        LEFT JOIN dim_range r ON c.serverip BETWEEN r.lo AND r.hi""",
    ),
)
def client_speed_flag(v):
    return rollups.client_speed_flag(v.located(v.owned(machine=True)), v.dims.isp, v.dims.area)


@register(
    "ua_traffic",
    sql("mach", f"SELECT domain, ts_sec AS timestamp, ua, userid, {FLOW_SQL} FROM mach GROUP BY ALL"),
)
def ua_traffic(v):
    rows = v.owned().withColumn("ua", agent.ua_keyword(F.col("agent")))
    return rollups.ua_traffic(rows)


@register(
    "speed_histogram",
    sql(
        "mach",
        "SELECT domain, userid, "
        + five("ts_sec")
        + " AS timestamp, sum(cs)::bigint AS flow_size, count(*) AS req_count, "
        + ", ".join(
            f"""sum(CASE WHEN event_id % 2 = 0
            THEN CASE WHEN event_id % 10 = {i} THEN event_id % 7 WHEN (event_id + 1) % 10 = {i} THEN 2 ELSE 0 END
            ELSE CASE WHEN least(speed // 1024, 9) = {i} THEN 1 ELSE 0 END END)::bigint AS speed{i}"""
            for i in range(10)
        )
        + " FROM mach GROUP BY 1, 2, 3",
    ),
)
def speed_histogram(v):
    """Even ids carry bucket text (with a bad entry), odd ids none."""
    e = F.col("event_id")
    text = F.concat_ws(
        ",",
        F.concat_ws(":", (e % 10).cast("string"), (e % 7).cast("string")),
        F.concat_ws(":", ((e + 1) % 10).cast("string"), F.lit("2")),
        F.lit("x:y"),
        F.lit("12:5"),
    )
    rows = v.speed_rows().withColumn("speed_interval", F.when(e % 2 == 0, text).otherwise("0"))
    return rollups.speed_histogram(rows)


# ------------------------------------------------------------- directories
def dir_sql(i: int) -> str:
    parts = f"string_split({path('url')}, '/')"
    return f"CASE WHEN len({parts}) > {i + 1} THEN {parts}[{i + 1}] ELSE '-' END"


@register(
    "dir_traffic_1m",
    sql(
        "owned",
        f"""SELECT domain, {dir_sql(1)} AS dir1, {dir_sql(2)} AS dir2, {minute('ts_sec')} AS timestamp,
        sum(cs)::bigint AS cs FROM owned GROUP BY ALL""",
    ),
)
def dir_traffic_1m(v):
    dir1, dir2 = net.dir_parts(F.col("path"))
    rows = v.owned().withColumns(
        {
            "dir1": dir1,
            "dir2": dir2,
            "timestmp": F.substring(timing.stamp(F.col("ts_sec")), 1, 12),
            "pno": F.lit(""),
        }
    )
    return rollups.dir_traffic_1m(rows)
