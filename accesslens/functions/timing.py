"""Log time, bucket labels and partition labels.

Epoch seconds do not depend on a zone; text labels use the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from accesslens.constants import LATE_SECONDS, LOG_TIME_FORMAT, MINUTE_FORMAT, STAMP_FORMAT


def log_time(text: Column) -> Column:
    """``01/Nov/2016:09:49:34 +0800`` to epoch seconds, null if malformed."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit(LOG_TIME_FORMAT)))


def stamp(sec: Column) -> Column:
    return F.date_format(F.timestamp_seconds(sec), STAMP_FORMAT)


def _floor(sec: Column, step: int) -> Column:
    return sec - sec % step


def five_label(sec: Column) -> Column:
    """End of the five-minute window that holds ``sec``."""
    return _floor(sec, 300) + 300


def minute_label(sec: Column) -> Column:
    return _floor(sec, 60)


def hour_label(sec: Column) -> Column:
    return _floor(sec, 3600)


def rollup_label(task: str, start_sec: int, stop_sec: int) -> int:
    """Label of one re-aggregation run."""
    if task == "five":
        return stop_sec // 300 * 300
    if task == "hour":
        return start_sec // 3600 * 3600
    return 0


def minute_text_to_sec(text: Column) -> Column:
    parsed = F.unix_timestamp(F.try_to_timestamp(text, F.lit(MINUTE_FORMAT)))
    return F.coalesce(parsed, F.lit(0).cast("bigint"))


def partition_labels(sec: Column) -> dict[str, Column]:
    ts = F.timestamp_seconds(sec)
    return {
        "month_": F.date_format(ts, "yyyyMM"),
        "day_": F.date_format(ts, "dd"),
        "hour_": F.date_format(ts, "HH"),
        "minute_": F.date_format(ts, "mm"),
    }


def day_label(sec: Column) -> Column:
    return F.date_format(F.timestamp_seconds(sec), "yyyyMMdd")


def day_hour_label(sec: Column) -> Column:
    return F.date_format(F.timestamp_seconds(sec), "yyyyMMddHH")


def is_late(arrival_sec: Column, sec: Column, allowance: int = LATE_SECONDS) -> Column:
    """A row of unknown arrival is on time."""
    return F.coalesce(arrival_sec > sec + allowance, F.lit(False))


def lt_seconds(lt: Column) -> Column:
    """Nanosecond-like ``lt`` double to epoch seconds."""
    return (lt / 1e9).cast("bigint")
