"""Registered column expressions, each over a whole table of the view."""

from __future__ import annotations

from pyspark.sql import functions as F

from accesslens.functions import agent, net, speed, timing
from accesslens.operators import enrich
from accesslens.plans.oracle_view import (
    SUFFIX_BASE,
    five,
    hour,
    minute,
    sql,
    stamp,
    suffix,
    ua_device,
    ua_keyword,
)
from accesslens.plans.oracle_view import speed as speed_sql
from accesslens.plans.registry import register


# ------------------------------------------------------------------ addresses
@register(
    "fn_ip_to_long",
    sql("log", "SELECT event_id, CASE WHEN event_id % 10 NOT IN (3, 4) THEN ip END AS ip FROM log"),
)
def fn_ip_to_long(v):
    """Ids 3 mod 10 have three parts, 4 mod 10 a word for a part."""
    e = F.col("event_id")
    dotted = net.long_to_ip(F.col("ip"))
    text = F.when(e % 10 == 3, "1.2.3").when(e % 10 == 4, "1.2.x.4").otherwise(dotted)
    return v.events().select("event_id", net.ip_to_long(text).alias("ip"))


@register("fn_url_host", "SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages")
def fn_url_host(v):
    return v.table("pages").select("page_id", net.url_host(F.col("url")).alias("host"))


@register("fn_url_path", "SELECT page_id, split_part(split_part(url, '://', 2), '?', 1) AS path FROM pages")
def fn_url_path(v):
    return v.table("pages").select("page_id", net.url_path(F.col("url")).alias("path"))


@register(
    "fn_suffix",
    f"""SELECT page_id, {suffix("split_part(split_part(url, '://', 2), '?', 1)")} AS suffix,
    CASE WHEN list_last(string_split(url, '.')) IN ({SUFFIX_BASE}) THEN list_last(string_split(url, '.')) ELSE 'other' END
    AS json_suffix FROM pages""",
)
def fn_suffix(v):
    from accesslens.constants import SUFFIXES_BASE

    return v.page_hosts.select(
        "page_id",
        net.suffix_class(F.col("path")).alias("suffix"),
        net.suffix_class(F.col("url"), SUFFIXES_BASE, fold_case=False).alias("json_suffix"),
    )


@register(
    "fn_first_dir",
    """SELECT page_id, '/' || CASE WHEN url LIKE 'http:%' THEN split_part(url, '/', 4) ELSE split_part(url, '/', 2) END
    AS dir FROM pages""",
)
def fn_first_dir(v):
    return v.table("pages").select("page_id", net.first_dir(F.col("url")).alias("dir"))


@register(
    "fn_dirs",
    """SELECT page_id, CASE WHEN len(p) > 2 THEN p[2] ELSE '-' END AS dir1, CASE WHEN len(p) > 3 THEN p[3] ELSE '-' END AS dir2
    FROM (SELECT page_id, string_split(split_part(split_part(url, '://', 2), '?', 1), '/') AS p FROM pages)""",
)
def fn_dirs(v):
    dir1, dir2 = net.dir_parts(F.col("path"))
    return v.page_hosts.select("page_id", dir1.alias("dir1"), dir2.alias("dir2"))


@register(
    "fn_machine_ip",
    "SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 5 THEN '0' ELSE (167772160 + s_suppkey)::varchar END AS node FROM supplier",
)
def fn_machine_ip(v):
    k = F.col("s_suppkey")
    name = F.when(k % 9 == 5, "short-name").otherwise(
        F.format_string("cnc-tj-010-000-%03d-%03d", F.shiftright(k, 8), k.bitwiseAND(255))
    )
    node = F.coalesce(net.machine_ip(name).cast("string"), F.lit("0"))
    return v.table("supplier").select("s_suppkey", node.alias("node"))


# --------------------------------------------------------------------- agents
@register("fn_ua_keyword", sql("log", f"SELECT event_id, {ua_keyword('agent')} AS ua FROM log"))
def fn_ua_keyword(v):
    return v.events().select("event_id", agent.ua_keyword(F.col("agent")).alias("ua"))


@register("fn_ua_device", sql("log", f"SELECT event_id, {ua_device('agent')} AS ua FROM log"))
def fn_ua_device(v):
    return v.events().select("event_id", agent.ua_device(F.col("agent")).alias("ua"))


@register(
    "fn_ua_list",
    sql(
        "log",
        """SELECT event_id, CASE WHEN contains(lower(agent), 'safari') THEN 'safari'
        WHEN contains(lower(agent), 'android') THEN 'android' WHEN contains(lower(agent), 'cpu') THEN 'cpu'
        WHEN contains(lower(agent), 'x86_64') THEN 'x86_64' WHEN contains(lower(agent), 'curl') THEN 'curl'
        ELSE 'other' END AS ua FROM log""",
    ),
)
def fn_ua_list(v):
    from accesslens.plans.dim_queries import ua_lines
    from accesslens.sources import dims

    words = dims.load_ua_keywords(ua_lines(v))
    return enrich.with_ua_list(v.events().select("event_id", "agent"), words, "agent", "ua").select("event_id", "ua")


# ---------------------------------------------------------------- speed, hits
@register("fn_speed", sql("log", f"SELECT event_id, {speed_sql('es', 'cs')} AS speed FROM log"))
def fn_speed(v):
    return v.events().select("event_id", speed.speed_kbps(F.col("es"), F.col("cs")).alias("speed"))


@register(
    "fn_hit_type",
    sql(
        "log dim_parent",
        """SELECT event_id, CASE WHEN k % 3 = 0 THEN 0 WHEN k % 3 = 2 THEN 4 WHEN up = '-' OR p.ip IS NULL THEN 2
        WHEN fv = 'HIT' THEN 1 ELSE 3 END AS hit_type FROM log LEFT JOIN dim_parent p ON p.ip = up""",
    ),
)
def fn_hit_type(v):
    rows = enrich.flag_parent(v.events(), v.dims.parents)
    kind = speed.hit_type(
        F.col("hit"), F.col("up"), speed.first_word_has_hit(F.col("fv")), F.col("up_is_parent")
    )
    return rows.select("event_id", kind.alias("hit_type"))


@register(
    "fn_fast_flag",
    sql(
        "log",
        """SELECT event_id, CASE WHEN cs <> 0 AND es > 0 AND (cs // 1024)::double / es * 1000 < 80 THEN '0' ELSE '1' END
        AS ratio FROM log""",
    ),
)
def fn_fast_flag(v):
    return v.events().select("event_id", speed.fast_flag(F.col("es"), F.col("cs")).alias("ratio"))


@register(
    "fn_slow_flag",
    sql(
        "log",
        """SELECT event_id, CASE WHEN es > 0 AND cs::double / es * 1000 / 1024 < 100 THEN 1 ELSE 0 END AS slow FROM log""",
    ),
)
def fn_slow_flag(v):
    return v.events().select("event_id", speed.slow_flag(F.col("es"), F.col("cs")).alias("slow"))


# ----------------------------------------------------------------------- time
@register(
    "fn_log_time",
    sql("log", "SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN ts_sec END AS ts_sec FROM log"),
)
def fn_log_time(v):
    """Local time at +0800; ids 3 mod 10 name no month."""
    local = F.date_format(F.timestamp_seconds(F.col("ts_sec") + 28800), "dd/MMM/yyyy:HH:mm:ss")
    text = F.when(F.col("event_id") % 10 == 3, "01/Xxx/2024:00:00:00 +0800").otherwise(
        F.concat(local, F.lit(" +0800"))
    )
    return v.events().select("event_id", timing.log_time(text).alias("ts_sec"))


def _labels(name: str, build, text: str) -> None:
    @register(name, sql("log", f"SELECT event_id, {text} AS label FROM log"))
    def query(v):
        return v.events().select("event_id", build(F.col("ts_sec")).alias("label"))


_labels("fn_five_label", timing.five_label, five("ts_sec"))
_labels("fn_minute_label", timing.minute_label, minute("ts_sec"))
_labels("fn_hour_label", timing.hour_label, hour("ts_sec"))


@register(
    "fn_labels",
    sql(
        "log",
        f"""SELECT event_id, {stamp('ts_sec', '%Y%m')} AS month_, {stamp('ts_sec', '%d')} AS day_,
        {stamp('ts_sec', '%H')} AS hour_, {stamp('ts_sec', '%M')} AS minute_, {stamp('ts_sec', '%Y%m%d')} AS day,
        {stamp('ts_sec', '%Y%m%d%H')} AS day_hour FROM log""",
    ),
)
def fn_labels(v):
    sec = F.col("ts_sec")
    return (
        v.events()
        .withColumns(timing.partition_labels(sec))
        .select(
            "event_id", "month_", "day_", "hour_", "minute_",
            timing.day_label(sec).alias("day"), timing.day_hour_label(sec).alias("day_hour"),
        )
    )


@register(
    "fn_lt_seconds",
    sql("log", "SELECT event_id, ts_sec FROM log"),
)
def fn_lt_seconds(v):
    lt = F.col("ts_sec").cast("double") * 1e9
    return v.events().select("event_id", timing.lt_seconds(lt).alias("ts_sec"))
