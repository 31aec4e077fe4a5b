"""IP, URL and envelope expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from accesslens.constants import (
    ENVELOPE_MARK,
    SUFFIXES_EDGE,
)

IP_PARTS = 4


def ip_to_long(ip: Column) -> Column:
    """Dotted text to bigint; anything but four numeric parts is null.

    Parts are folded without a range check, so ``1.2.3.300`` has a value.
    """
    return parts_to_long(F.split(ip, r"\."))


def parts_to_long(parts: Column) -> Column:
    """The same from split text.  All terms are always evaluated, so the split
    is done once per row."""
    total = F.lit(0).cast("bigint")
    for i in range(IP_PARTS):
        total = total * 256 + F.get(parts, F.lit(i)).try_cast("bigint")
    return total + F.when(F.get(parts, F.lit(IP_PARTS)).isNull(), 0)


def long_to_ip(n: Column) -> Column:
    parts = [F.shiftright(n, 8 * i).bitwiseAND(255).cast("string") for i in (3, 2, 1, 0)]
    return F.concat_ws(".", *parts)


SCHEME_END = "://"


def _after_scheme(url: Column) -> Column:
    return F.substr(url, F.instr(url, SCHEME_END) + len(SCHEME_END))


# Plain string functions instead of patterns: these run on every log line.
def url_host(url: Column) -> Column:
    """Text between ``://`` and the next ``/``; port kept, '' if no scheme."""
    host = F.substring_index(_after_scheme(url), "/", 1)
    return F.when(url.contains(SCHEME_END), host).when(url.isNotNull(), "")


def url_path(url: Column) -> Column:
    """URL without scheme and query."""
    return F.when(url.contains(SCHEME_END), F.substring_index(_after_scheme(url), "?", 1)).when(
        url.isNotNull(), ""
    )


def drop_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def suffix_class(url: Column, words=SUFFIXES_EDGE, fold_case: bool = True) -> Column:
    """Text after the last dot if it is a known suffix, else ``other``."""
    last = F.substring_index(url, ".", -1)
    if fold_case:
        last = F.lower(last)
        return F.when(url.contains(".") & last.isin(*words), last).otherwise("other")
    return F.when(last.isin(*words), last).otherwise("other")


def parent_domain(host: Column) -> Column:
    """Name after the first dot; a name without a dot is its own parent."""
    return F.substr(host, F.instr(host, ".") + 1)


def refer_host(refer: Column) -> Column:
    return F.when(refer == "-", refer).otherwise(url_host(refer))


def dir_parts(path: Column) -> tuple[Column, Column]:
    """First two directories of a scheme-less URL.

    A part counts only when another ``/`` follows it; otherwise ``-``.
    """
    parts = F.split(path, "/")

    def part(i: int) -> Column:
        return F.when(F.size(parts) > i + 1, F.get(parts, F.lit(i))).otherwise("-")

    return part(1), part(2)


def first_dir(url: Column) -> Column:
    """``/`` + part 1, or part 3 when the URL starts with ``http:``; else null.

    Empty parts at the end do not count, hence the trim.
    """
    parts = F.split(F.regexp_replace(url, "/+$", ""), "/")
    part = F.when(F.get(parts, F.lit(0)) == "http:", F.get(parts, F.lit(3))).otherwise(
        F.get(parts, F.lit(1))
    )
    return F.concat(F.lit("/"), part)


def machine_ip(machine: Column) -> Column:
    """Address in a machine name: parts 2-5 of a ``-`` split, as bigint."""
    parts = F.split(machine, "-")
    dotted = F.concat_ws(".", *[F.get(parts, F.lit(i)) for i in range(2, 6)])
    return F.when(F.size(parts) >= 6, ip_to_long(dotted))


def last_word(line: Column) -> Column:
    return F.substring_index(line, " ", -1)


def after_last_mark(ip: Column) -> Column:
    """Client address behind an envelope prefix."""
    return F.when(
        ip.startswith(ENVELOPE_MARK), F.substring_index(ip, ENVELOPE_MARK, -1)
    ).otherwise(ip)


def envelope_platform(tag: Column) -> Column:
    """Text between the first two marks of the first token, else ``-``."""
    parts = F.split(tag, r"@\|@", 3)
    enveloped = tag.startswith(ENVELOPE_MARK) & (F.size(parts) == 3)
    return F.when(enveloped, F.get(parts, F.lit(1))).otherwise("-")


def strip_envelope(line: Column) -> Column:
    """Six-mark envelope: text after mark 4 up to mark 5, then after mark 6.

    Lines without a leading mark are unchanged; fewer than six marks give null.
    """
    parts = F.split(line, r"@\|@", 7)
    inner = F.concat(F.get(parts, F.lit(4)), F.get(parts, F.lit(6)))
    return F.when(line.startswith(ENVELOPE_MARK), inner).otherwise(line)


def is_loopback(ip: Column, rule: str = "prefix127") -> Column:
    """Loopback test; the log families use different rules."""
    if rule == "prefix127":
        return ip.startswith("127")
    if rule == "prefix127.0.0":
        return ip.startswith("127.0.0")
    if rule == "equals":
        return ip == "127.0.0.1"
    raise ValueError(f"unknown loopback rule {rule!r}")
