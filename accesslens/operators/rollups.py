"""Roll-ups: keyed sums at minute, five-minute and hour grain.

Three families cover the named roll-ups: ``traffic`` (sums over log rows),
``node speed`` (sums and median per node) and ``rollup`` (sums over stored
roll-ups).  All are hash aggregations with map-side combine, so a hot key
arrives at its reducer as one partial row per task.  Lookups that do not change
the grouping run after the aggregation, on its small result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from accesslens.constants import HASH_USERID, STORED_MINUTE_REACH
from accesslens.functions import net, speed, timing
from accesslens.operators import enrich, filters, median


def _five() -> Column:
    return timing.five_label(F.col("ts_sec"))


def _minute() -> Column:
    return timing.minute_label(F.col("ts_sec"))


def _hour() -> Column:
    return timing.hour_label(F.col("ts_sec"))


def traffic(
    rows: DataFrame, keys: list[str], label: Column, measures: list[Column] | None = None
) -> DataFrame:
    """Sum of bytes and count of requests per keys and time label."""
    aggs = measures or [F.sum("cs").alias("flow_size"), F.count(F.lit(1)).alias("req_count")]
    return rows.groupBy(*keys, label.alias("timestamp")).agg(*aggs)


def traffic_by_domain(
    hosts: DataFrame,
    domains: DataFrame,
    keys: list[str],
    label: Column,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``traffic`` per owned domain, straight from host names.

    Rows are summed per host first; the owner lookup then sees one row per host
    and label instead of every log row, so neither a hot host nor a large owner
    table makes the join expensive.  Sums of sums are exact.
    """
    per_host = traffic(hosts, ["host", *keys], label)
    owned = filters.known_domain(enrich.map_domain(per_host, domains))
    owned = keep(owned) if keep else owned
    return owned.groupBy("domain", "userid", *keys, "timestamp").agg(
        F.sum("flow_size").alias("flow_size"), F.sum("req_count").alias("req_count")
    )


# --------------------------------------------------------------- five minutes
def domain_traffic_5m(rows: DataFrame) -> DataFrame:
    return traffic(rows, ["domain", "userid"], _five())


def user_status_traffic_5m(rows: DataFrame, users: DataFrame) -> DataFrame:
    kept = filters.of_users(rows, users)
    return traffic(kept, ["domain", "userid", "status"], _five()).withColumnRenamed("status", "status_code")


def status_count_5m(rows: DataFrame) -> DataFrame:
    counts = traffic(rows, ["domain", "userid", "status"], _five(), [F.count(F.lit(1)).alias("req_count")])
    return counts.withColumnRenamed("status", "status_code")


def platform_traffic_5m(rows: DataFrame) -> DataFrame:
    keys = ["domain", "userid", "isp", "prv", "area_pid", "area_cid", "status", "platform", "pop_id"]
    return traffic(rows, keys, _five()).withColumnsRenamed({"platform": "platformName", "pop_id": "popID"})


def isp_prv_traffic_5m(rows: DataFrame) -> DataFrame:
    return traffic(rows, ["domain", "userid", "isp", "prv", "area_pid"], _five())


# ----------------------------------------------------------------- node speed
NODE_KEYS = ["isp", "prv", "node"]


def _node_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*NODE_KEYS, _five().alias("timestamp")).agg(
        F.sum("cs").alias("cs"), F.sum("es").alias("es"), F.count(F.lit(1)).alias("count")
    )


def node_speed_5m(rows: DataFrame) -> DataFrame:
    return _node_sums(filters.node_rows(rows))


def node_speed_large_5m(rows: DataFrame) -> DataFrame:
    return _node_sums(filters.large_node_rows(rows))


def _large_speeds(rows: DataFrame) -> DataFrame:
    kept = filters.large_node_rows(rows)
    return kept.withColumn("speed", speed.large_file_speed(F.col("es"), F.col("cs")))


def node_speed_median(rows: DataFrame) -> DataFrame:
    return median.discrete_median(_large_speeds(rows), NODE_KEYS, "speed")


def node_speed_median_rank(rows: DataFrame) -> DataFrame:
    return median.median_by_rank(_large_speeds(rows), NODE_KEYS, "speed")


def node_speed_join(rows: DataFrame, batch_sec: int) -> DataFrame:
    """Sums, count and median per node of one batch, labelled by batch time."""
    both = median.sums_and_median(_large_speeds(rows), NODE_KEYS, "speed", ["cs", "es"])
    label = F.lit(batch_sec // 300 * 300 + 300).cast("bigint")
    return both.select(*NODE_KEYS, label.alias("timestamp"), "cs", "es", "count", "speed")


# -------------------------------------------------------------- hits, machines
HIT_KEYS = ["domain", "isp", "prv", "hit_type", "userid"]


def _hit_traffic(rows: DataFrame, area: DataFrame, label: Column) -> DataFrame:
    """Speed is recomputed from the sums; area joins the aggregated rows."""
    sums = traffic(
        rows,
        HIT_KEYS,
        label,
        [
            F.sum("es").alias("es"),
            F.sum("cs").alias("flow_size"),
            F.sum("req_num").alias("req_count"),
            F.sum("zero_speed").alias("zeroSpeedReqNum"),
        ],
    )
    return _with_area(sums, area).withColumns(
        {
            "speed_size": speed.speed_kbps(F.col("es"), F.col("flow_size")).cast("int"),
            "hit_type": speed.shown_hit_type(F.col("hit_type")),
        }
    )


def _with_area(df: DataFrame, area: DataFrame) -> DataFrame:
    """Output names: the looked-up code is ``city``, the area ids ``prv`` and ``country``."""
    return enrich.with_area(df.withColumnRenamed("prv", "city"), area, "city", "prv", "country")


def hit_traffic_1m(rows: DataFrame, area: DataFrame) -> DataFrame:
    return _hit_traffic(filters.on_time(rows), area, _minute())


def late_hit_traffic_1h(rows: DataFrame, area: DataFrame) -> DataFrame:
    return _hit_traffic(filters.late(rows), area, _hour())


def late_hit_traffic_5m(rows: DataFrame, area: DataFrame) -> DataFrame:
    return _hit_traffic(filters.late(rows), area, _five())


def status_traffic_1s(rows: DataFrame, area: DataFrame) -> DataFrame:
    sums = traffic(rows, ["domain", "isp", "prv", "status", "userid"], F.col("ts_sec"))
    return _with_area(sums, area).withColumnRenamed("status", "status_code")


# Platform, pop and codes depend on the machine alone, so any value of the
# group is the value; max keeps them out of the shuffle key.
def _platform() -> list[Column]:
    return [F.max("platform").alias("platform"), F.max("pop_id").cast("string").alias("popId")]


_MACHINE_NAMES = {"machine": "machineName", "machine_isp": "machineIsp", "machine_prv": "machinePrv"}


def machine_flow_1m(rows: DataFrame, area: DataFrame) -> DataFrame:
    kept = filters.on_time(filters.known_area(rows, area))
    keys = ["machine", "machine_isp", "machine_prv", "domain", "isp", "prv"]
    codes = [
        F.max("machine_isp_code").cast("string").alias("machineIspCode"),
        F.max("machine_prv_code").cast("string").alias("machinePrvCode"),
    ]
    sums = traffic(kept, keys, _minute(), [F.sum("cs").alias("flowSize"), *_platform(), *codes])
    looked_up = _with_area(sums, area).drop("city", "country")
    return looked_up.withColumnsRenamed(_MACHINE_NAMES)


def machine_hit_1m(rows: DataFrame, area: DataFrame) -> DataFrame:
    kept = filters.on_time(filters.known_area(rows, area))
    keys = ["machine", "machine_isp", "machine_prv", "domain", "hit_type"]
    measures = [F.sum("req_num").alias("reqCount"), F.sum("cs").alias("flowSize"), *_platform()]
    return traffic(kept, keys, _minute(), measures).withColumnsRenamed(
        _MACHINE_NAMES | {"hit_type": "hitType"}
    )


def _machine_speed(rows: DataFrame) -> DataFrame:
    keys = ["machine", "domain", "hit_type", "machine_isp", "machine_prv"]
    measures = [F.sum("req_num").alias("reqCount"), F.sum("speed").alias("speed"), *_platform()]
    return traffic(filters.with_speed(rows), keys, _minute(), measures).withColumnsRenamed(
        _MACHINE_NAMES | {"hit_type": "hitType"}
    )


def machine_speed_1m(rows: DataFrame) -> DataFrame:
    return _machine_speed(filters.on_time(rows))


def late_machine_speed_hour(rows: DataFrame) -> DataFrame:
    """Minute rows of late data under an hour label; not summed again."""
    minutes = _machine_speed(filters.late(rows))
    return minutes.withColumn("timestamp", timing.hour_label(F.col("timestamp")))


def _machine_status(rows: DataFrame) -> DataFrame:
    keys = ["machine", "status", "machine_isp", "machine_prv"]
    measures = [F.sum("req_num").alias("reqCount"), *_platform()]
    return traffic(rows, keys, _minute(), measures).withColumnsRenamed(
        _MACHINE_NAMES | {"status": "statusCode"}
    )


def machine_status_1m(rows: DataFrame) -> DataFrame:
    return _machine_status(filters.on_time(rows))


def late_machine_status_hour(rows: DataFrame) -> DataFrame:
    minutes = _machine_status(filters.late(rows))
    return minutes.withColumn("timestamp", timing.hour_label(F.col("timestamp")))


# ------------------------------------------------------- slow rate, speed flags
def slow_rate_5m(rows: DataFrame) -> DataFrame:
    return rows.groupBy("domain", "host", "isp", "province", "time", "ifSlow").agg(
        F.count(F.lit(1)).alias("count")
    )


def slow_share_5m(rows: DataFrame) -> DataFrame:
    """Share of slow downloads per the same keys without the flag."""
    return rows.groupBy("domain", "host", "isp", "province", "time").agg(
        F.avg("ifSlow").alias("slow_share"), F.count(F.lit(1)).alias("count")
    )


def client_speed_flag(rows: DataFrame, isp: DataFrame, area: DataFrame) -> DataFrame:
    """Fast / slow downloads per client and second; server isp from the server address."""
    flagged = rows.withColumns(
        {
            "ratio": speed.fast_flag(F.col("es"), F.col("cs")),
            "serverip": net.ip_to_long(F.col("Fa")),
        }
    )
    keys = ["machine", "domain", "prv", "isp", "ip", "userid", "ts_sec", "ratio", "serverip"]
    counts = flagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    looked_up = enrich.with_code(counts, isp, "serverisp", "serverip")
    looked_up = enrich.with_area(looked_up, area, "prv", "area_pid", "area_cid")
    minute = timing.minute_label(F.col("ts_sec"))
    return looked_up.select(
        F.col("machine").alias("hostname"),
        "domain",
        F.col("area_pid").alias("prv"),
        "isp",
        "ip",
        "userid",
        "ratio",
        minute.alias("timestamp"),
        timing.five_label(minute).alias("fivetime"),
        "serverip",
        "serverisp",
        "count",
    )


# ------------------------------------------------------- directories, #_# lines
def dir_traffic_1m(rows: DataFrame) -> DataFrame:
    kept = rows.filter(F.col("pno") == "")
    sums = kept.groupBy("domain", "dir1", "dir2", "timestmp").agg(F.sum("cs").alias("cs"))
    return sums.select(
        "domain", "dir1", "dir2", timing.minute_text_to_sec(F.col("timestmp")).alias("timestamp"), "cs"
    )


def _hash_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("flow_size").alias("flow_size"), F.count(F.lit(1)).alias("req_count")
    )


def hash_dir_traffic_5m(rows: DataFrame) -> DataFrame:
    return _hash_sums(rows, ["domain", "dir", "timestamp", "https_flag"])


def hash_traffic_5m(rows: DataFrame, userid: str = HASH_USERID) -> DataFrame:
    return _hash_sums(rows, ["domain", "timestamp", "https_flag"]).withColumn("userid", F.lit(userid))


# --------------------------------------------------------------- agents, speeds
def ua_traffic(rows: DataFrame) -> DataFrame:
    return traffic(rows, ["domain", "ua", "userid"], F.col("ts_sec"))


def _good_entries() -> Column:
    """``i:n,i:n`` as an array of pairs; bad entries are ignored."""
    entries = F.transform(F.split("speed_interval", ","), lambda e: F.split(e, ":"))
    return F.filter(
        entries,
        lambda e: F.get(e, F.lit(0)).try_cast("int").between(0, 9)
        & F.get(e, F.lit(1)).try_cast("bigint").isNotNull(),
    )


def _bucket_count(i: int) -> Column:
    """The last entry of bucket ``i``; without text the row's own bucket."""
    mine = F.filter("_entries", lambda e: F.get(e, F.lit(0)).try_cast("int") == i)
    found = F.get(F.get(F.reverse(mine), F.lit(0)), F.lit(1)).try_cast("bigint")
    own = F.when(speed.speed_bucket(F.col("speed")) == i, 1).otherwise(0).cast("bigint")
    return F.when(F.col("speed_interval").contains(":"), F.coalesce(found, F.lit(0).cast("bigint"))).otherwise(own)


def speed_histogram(rows: DataFrame) -> DataFrame:
    """Bytes, requests and ten speed buckets per domain, five minutes and user.

    A row's buckets come from its ``speed_interval`` text; where that is absent
    the row counts once, in the bucket of its own speed.
    """
    wide = rows.withColumn("_entries", _good_entries()).withColumns(
        {f"speed{i}": _bucket_count(i) for i in range(10)}
    )
    measures = [F.sum("cs").alias("flow_size"), F.sum("req_num").alias("req_count")]
    measures += [F.sum(f"speed{i}").alias(f"speed{i}") for i in range(10)]
    return traffic(wide, ["domain", "userid"], _five(), measures)


# --------------------------------------------------------- stored roll-ups again
def rollup(
    stored: DataFrame, keys: list[str], measures: list[Column], label: int
) -> DataFrame:
    """Sum a stored roll-up over the range it was read with."""
    return stored.groupBy(*keys).agg(*measures).withColumn("timestamp", F.lit(label).cast("bigint"))


def _sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def hit_traffic_rollup(stored: DataFrame, label: int) -> DataFrame:
    """``speed_size`` adds the stored ratios; the recomputed one uses the sums."""
    keys = ["domain", "isp", "city", "prv", "country", "hit_type", "userid"]
    sums = _sums("speed_size", "flow_size", "req_count", "zeroSpeedReqNum", "es")
    out = rollup(stored, keys, sums, label)
    again = speed.speed_kbps(F.col("es"), F.col("flow_size"))
    return out.withColumn("speed_size_recomputed", again).drop("es")


def status_rollup(stored: DataFrame, label: int) -> DataFrame:
    keys = ["domain", "isp", "city", "prv", "country", "status_code", "userid"]
    return rollup(stored, keys, _sums("flow_size", "req_count"), label)


def ua_rollup(stored: DataFrame, label: int) -> DataFrame:
    return rollup(stored, ["domain", "userid", "ua"], _sums("flow_size", "req_count"), label)


def machine_speed_rollup(stored: DataFrame, label: int) -> DataFrame:
    keys = ["machineName", "domain", "hitType", "machineIsp", "machinePrv"]
    carried = [F.max("platform").alias("platform"), F.max("popId").alias("popId")]
    return rollup(stored, keys, [*_sums("reqCount", "speed"), *carried], label)


def pno_traffic_5m(stored: DataFrame, start_sec: int, write_time: str) -> DataFrame:
    """Five-minute sums of stored minute rows near the start time.

    The reach test uses the five-minute label, as the sums do.
    """
    label = timing.five_label(F.col("timestamp"))
    near = F.abs(label - start_sec) < STORED_MINUTE_REACH
    if "hour" in stored.columns:  # the partitions of stored roll-ups: only those in reach are listed and read
        first, last = (timing.day_hour_label(F.lit(start_sec + r).cast("bigint")) for r in (-STORED_MINUTE_REACH, STORED_MINUTE_REACH))
        near = near & F.col("hour").cast("string").between(first, last)
    return (
        stored.filter(near)
        .groupBy("domain", "pno", label.alias("timestamp"))
        .agg(F.sum("cs").alias("cs"))
        .withColumn("write_time", F.lit(write_time))
    )
