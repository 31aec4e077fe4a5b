"""Row filters: list membership, loopback, ranges and the lateness split."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from accesslens.constants import ES_LIMIT_LARGE_MS, ES_LIMIT_MS, HASH_SEPARATOR, LARGE_MIN_BYTES
from accesslens.functions import net, timing

Predicate = Callable[[DataFrame], Column]


def keep(df: DataFrame, predicate: Predicate) -> DataFrame:
    """User predicate at ingest; applied before any parsing."""
    return df.filter(predicate(df))


def keep_listed(df: DataFrame, key: Column, listed: DataFrame, column: str) -> DataFrame:
    """Left semi join with a one-column list."""
    names = listed.select(F.col(column).alias("_listed"))
    return df.join(names, key == F.col("_listed"), "left_semi")


def hash_line_domain(value: Column) -> Column:
    """Text between the second space and the first field separator."""
    head = F.substring_index(value, HASH_SEPARATOR, 1)
    return F.when(value.contains(HASH_SEPARATOR), F.regexp_extract(head, "^[^ ]* [^ ]* (.*)$", 1))


def url_domain(value: Column) -> Column:
    """Text between ``://`` and the next ``/``, which must follow; else null."""
    found = F.regexp_extract(value, "://([^/]*)/", 1)
    return F.nullif(found, F.lit(""))


def lines_of_hash_domains(lines: DataFrame, domains: DataFrame) -> DataFrame:
    return keep_listed(lines, hash_line_domain(F.col("value")), domains, "domain")


def lines_of_url_domains(lines: DataFrame, domains: DataFrame) -> DataFrame:
    return keep_listed(lines, url_domain(F.col("value")), domains, "domain")


def lines_of_fixed_domains(lines: DataFrame, domains: list[str]) -> DataFrame:
    return lines.filter(F.trim(url_domain(F.col("value"))).isin(*domains))


def containing(lines: DataFrame, text: str) -> DataFrame:
    return lines.filter(F.col("value").contains(text))


def drop_loopback(df: DataFrame, ip: str = "ip_text", rule: str = "prefix127") -> DataFrame:
    return df.filter(~net.is_loopback(F.col(ip), rule))


def known_domain(df: DataFrame) -> DataFrame:
    return df.filter(F.col("domain").isNotNull())


def monitored(df: DataFrame, domains: DataFrame) -> DataFrame:
    return keep_listed(df, F.col("domain"), domains, "domain")


def of_users(df: DataFrame, users: DataFrame) -> DataFrame:
    return keep_listed(df, F.col("userid"), users, "userid")


def known_area(df: DataFrame, area: DataFrame) -> DataFrame:
    return keep_listed(df, F.col("prv"), area, "area_id")


def with_speed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("speed") != 0)


def node_rows(df: DataFrame) -> DataFrame:
    return df.filter((F.col("node") != 0) & (F.col("es") > 0) & (F.col("es") < ES_LIMIT_MS))


def large_node_rows(df: DataFrame) -> DataFrame:
    return df.filter(
        (F.col("cs") >= LARGE_MIN_BYTES)
        & (F.col("node") != 0)
        & (F.col("es") > 0)
        & (F.col("es") < ES_LIMIT_LARGE_MS)
    )


def on_time(df: DataFrame, arrival: str = "arrival_sec", sec: str = "ts_sec") -> DataFrame:
    return df.filter(~timing.is_late(F.col(arrival), F.col(sec)))


def late(df: DataFrame, arrival: str = "arrival_sec", sec: str = "ts_sec") -> DataFrame:
    return df.filter(timing.is_late(F.col(arrival), F.col(sec)))
