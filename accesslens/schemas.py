"""Schemas, stated once and never inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(text: str) -> T.StructType:
    fields = []
    types = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
             "double": T.DoubleType(), "timestamp_ntz": T.TimestampNTZType()}
    for item in text.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, types[kind]))
    return T.StructType(fields)


LINES = struct("value string")

EVENTS = struct(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

#: The given tables the view reads; reading by schema needs no footer scan.
TABLES = {
    "events": EVENTS,
    "pages": struct("page_id bigint, url string, html string"),
    "supplier": struct("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "nation": struct("n_nationkey int, n_name string, n_regionkey int"),
    "region": struct("r_regionkey int, r_name string"),
    "part": struct("p_partkey bigint"),
}

#: The wide log row, in the order user SQL over ``loginfo`` expects it.
ACCESS_LOG = struct(
    "machine string, ip bigint, isp string, prv string, domain string, url string, suffix string,"
    "status string, cs bigint, refer string, ua string, es double, hit string, timestmp string,"
    "dd int, userid string, rk string, up string, Fa string, Fv string, platform string, node string"
)

BILLING = struct(
    "domain string, isp string, prv string, area_pid string, area_cid string, cs bigint,"
    "status string, userid string, ts_sec bigint, platform string, pop_id int, node bigint, es double"
)

MACHINE = struct(
    "machine string, ts_sec bigint, isp string, prv string, domain string, status string,"
    "hit_type int, ua string, speed_interval string, speed bigint, es double, cs bigint, req_num int,"
    "userid string, zero_speed bigint, platform string, pop_id int, machine_isp string,"
    "machine_prv string, machine_isp_code int, machine_prv_code int"
)

JSON_LOG = struct(
    "hostname string, ip bigint, isp string, prv string, domain string, ru string, suffix string,"
    "Fs string, cs bigint, refer string, ua string, es double, st string, timestamp string, dd int,"
    "userid string, tl double, rm string, rv string, rf string, a string, timestampLong bigint"
)

#: What a JSON line may hold; every key is read by name, numbers as they are written.
JSON_LINE = T.StructType(
    [T.StructField("tl", T.StructType([T.StructField("value", T.StringType())]))]
    + [T.StructField(c, T.StringType()) for c in "es rm Fs st hostname ru ua rv rf a cs lt".split()]
)
