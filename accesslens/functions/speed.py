"""Download speed, hit type and the flags derived from them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from accesslens.constants import (
    FAST_FLAG_KBPS,
    HIT,
    MISS_OTHER,
    PARENT_HIT,
    PARENT_MISS,
    SLOW_FLAG_KBPS,
    SOURCE,
    SPEED_MAX_KBPS,
    SPEED_MIN_KBPS,
)


def int_div(a: Column, b: Column | int) -> Column:
    """Integer division; a zero divisor gives null."""
    divisor = F.lit(b) if isinstance(b, int) else F.nullif(b, F.lit(0).cast("bigint"))
    return F.call_function("div", a, divisor)


def speed_kbps(es: Column, cs: Column) -> Column:
    """KB/s by integer steps: cs div 1024 div es * 1000; out of range is 0."""
    raw = int_div(int_div(cs, 1024), es.cast("bigint")) * 1000
    return F.when(raw.between(SPEED_MIN_KBPS, SPEED_MAX_KBPS), raw).otherwise(
        F.lit(0).cast("bigint")
    )


def zero_speed(speed: Column) -> Column:
    return F.when(speed == 0, 1).otherwise(0).cast("bigint")


def first_word_has_hit(fv: Column) -> Column:
    return F.when(fv.contains("HIT"), 1).otherwise(0)


def hit_type(hit: Column, up: Column, fv_hit: Column, up_is_parent: Column) -> Column:
    low = F.lower(hit)
    return (
        F.when(low.contains("hit"), HIT)
        .when(
            low.contains("miss"),
            F.when((F.length(up) == 1) | ~up_is_parent, SOURCE)
            .when(fv_hit == 1, PARENT_HIT)
            .otherwise(PARENT_MISS),
        )
        .otherwise(MISS_OTHER)
    )


def shown_hit_type(kind: Column) -> Column:
    return F.when(kind == PARENT_MISS, PARENT_HIT).otherwise(kind)


def fast_flag(es: Column, cs: Column) -> Column:
    """``0`` when bytes were sent slower than the limit, else ``1``."""
    rate = F.try_divide(int_div(cs, 1024).cast("double"), es) * 1000
    return F.when((cs != 0) & (rate < FAST_FLAG_KBPS), "0").otherwise("1")


def slow_flag(es: Column, cs: Column) -> Column:
    rate = F.try_divide(cs.cast("double"), es.cast("double")) * 1000 / 1024
    return F.when(rate < SLOW_FLAG_KBPS, 1).otherwise(0)


def large_file_speed(es: Column, cs: Column) -> Column:
    return F.try_divide(cs.cast("double"), es)


def speed_bucket(speed: Column) -> Column:
    """Bucket 0-9 of a speed, ten equal steps up to the upper limit."""
    return F.least(int_div(speed, SPEED_MAX_KBPS // 10), F.lit(9).cast("bigint"))
