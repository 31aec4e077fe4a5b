"""Raw lines -> typed rows, as column expressions.

A parse cuts the line into tokens first and builds the fields from the tokens.
``_once`` stands between the two: a filter on the fields is not pushed below it,
so no line is cut a second time to test it.

Each parser returns the input columns plus the fields and ``_state``:

* ``ok``      well formed;
* ``drop``    well formed but unwanted (loopback client, slow-rate rules);
* ``reject``  malformed.

``accepted`` and ``rejected`` split that frame.  A row whose domain no owner
claims is rejected too.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from accesslens.constants import (
    ENVELOPE_MARK,
    FORMAT_FIELDS,
    FORMAT_SHIFT,
    FORMAT_SHIFT_FIELD,
    HASH_SEPARATOR,
    JSON_FAILURE_MARK,
    MEDIA_WORD,
    NO_HIT_TEXT,
    POWZA_WORD,
    SLOW_DOMAINS,
    SLOW_MIN_BYTES,
    SUFFIXES_BASE,
)
from accesslens.functions import agent, net, speed, timing
from accesslens.operators import enrich
from accesslens.schemas import ACCESS_LOG, BILLING, JSON_LINE, JSON_LOG, MACHINE
from accesslens.sources.dims import Dims

Fields = dict[str, Column]


# ---------------------------------------------------------------- helpers
#: Columns a parse may add before the lookups; all others came with the lines.
_CUT = {
    "value", "_state", "machine", "ip", "ip_text", "ts_sec", "host", "url", "suffix", "status", "cs",
    "refer", "ua", "es", "hit", "dd", "rk", "up", "Fa", "Fv", "platform", "node", "fv_hit",
    "request_url", "is_https", "timestmp",
}


def _given(df: DataFrame, made: set[str] = _CUT) -> list[str]:
    """Columns that came with the lines, such as an arrival time."""
    return [c for c in df.columns if c not in made and not c.startswith("_")]


def _once(df: DataFrame, given: list[str], made: Fields) -> DataFrame:
    """``given`` columns plus ``made`` ones, each computed once per row.

    A one-element ``inline`` keeps its input as it is, but the optimizer does not
    push filters through it by repeating the expressions.
    """
    return df.select(*given, F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


def _words(text: Column) -> Column:
    """Words between runs of spaces; no pattern needed."""
    return F.array_remove(F.split(text, " "), "")


def _at(array: Column, i: int) -> Column:
    return F.get(array, F.lit(i))


def _or_dash(value: Column) -> Column:
    return F.coalesce(value, F.lit("-"))


def _all(*conds: Column) -> Column:
    """Conjunction that treats unknown as false."""
    return F.coalesce(reduce(lambda a, b: a & b, conds), F.lit(False))


def _state(well_formed: Column, dropped: Column) -> Column:
    return F.when(_all(dropped), "drop").when(well_formed, "ok").otherwise("reject")


def _dash_to_zero(text: Column) -> Column:
    return F.when(text == "-", F.lit(0.0)).otherwise(text.try_cast("double"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter((F.col("_state") == "ok") & F.col("domain").isNotNull())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(is_rejected()).select("value")


def is_rejected() -> Column:
    return (F.col("_state") == "reject") | ((F.col("_state") == "ok") & F.col("domain").isNull())


# ------------------------------------------------------- edge / powza / media
# All three have words, a bracketed time and a rest:
#   edge   tag machine ip es - [time] "METHOD url PROTO" status cs "refer" "agent" hit ... node
#   powza  tag machine epoch ip - - [time] status cs domain_url es METHOD url "agent" ... node
#   media  tag machine x y [time] id domain_url x x ip x x x x x cs ... node
# so one set of expressions cuts them, with places picked by the kind of line.
EDGE, POWZA, MEDIA = "edge", "powza", "media"


class _Spaced:
    """Tokens of spaced lines, cut stage by stage."""

    def __init__(self, lines: DataFrame, kinds: tuple[str, ...], kind: Column | None):
        self.base, self.kinds = lines.columns, kinds
        self.df = lines.withColumn("_kind", kind) if len(kinds) > 1 else lines

    def pick(self, **by_kind: Column) -> Column:
        """The expression of a line's kind; no test when there is one kind."""
        if len(self.kinds) == 1:
            return by_kind[self.kinds[0]]
        return F.coalesce(*[F.when(F.col("_kind") == k, by_kind[k]) for k in self.kinds])

    def stage(self, **made: Column) -> None:
        self.df = self.df.withColumns({f"_{n}": c for n, c in made.items()})

    def cut(self) -> None:
        value, w, a, q = F.col("value"), F.col("_w"), F.col("_a"), F.col("_q")
        inside = F.substr(value, F.instr(value, " [") + 2)
        self.stage(
            w=_words(F.substring_index(value, "[", 1)),
            time=F.when(value.contains(" ["), F.substring_index(inside, "] ", 1)),
            after=F.when(value.contains("] "), F.substr(value, F.instr(value, "] ") + 2)),
        )
        self.stage(q=F.split("_after", '"', 7))
        words = self.pick(edge=_at(q, 2), powza=_at(q, 0), media=F.col("_after"))
        self.stage(a=_words(words), edge_url=_at(F.split(_at(q, 1), " "), 1))
        ip_text = net.after_last_mark(self.pick(edge=_at(w, 2), powza=_at(w, 3), media=_at(a, 4)))
        self.stage(
            ip_text=ip_text,
            ip_parts=F.split(ip_text, r"\."),
            node_parts=F.split(net.last_word(value), r"\."),
            sec=timing.log_time(F.col("_time")),
            host=net.url_host(self.pick(edge=F.col("_edge_url"), powza=_at(a, 2), media=_at(a, 1))),
            cs=self.pick(edge=_at(a, 1), powza=_at(a, 1), media=_at(a, 10)).try_cast("bigint"),
        )
        self.stage(
            ip=net.parts_to_long(F.col("_ip_parts")),
            node=net.parts_to_long(F.col("_node_parts")),
        )

    def cut_wide(self) -> None:
        q = F.col("_q")
        self.stage(
            path=net.url_path(self.pick(edge=F.col("_edge_url"), powza=_at(F.col("_a"), 5))),
            ua_low=F.lower(self.pick(edge=_at(q, 5), powza=_at(q, 1))),
            tail=self.pick(edge=_words(_at(q, 6)), powza=F.array().cast("array<string>")),
        )

    def basics(self) -> Fields:
        return {"ip": F.col("_ip"), "ts_sec": F.col("_sec"), "host": F.col("_host"), "cs": F.col("_cs")}

    def basics_ok(self) -> Column:
        """Words before the time, time, host, bytes and address."""
        n = self.pick(edge=F.lit(5), powza=F.lit(6), media=F.lit(4))
        return _all(
            F.size("_w") == n,
            F.col("_sec").isNotNull(),
            F.col("_host") != "",
            F.col("_cs").isNotNull(),
            F.col("_ip").isNotNull(),
        )

    def build(self, fields: Fields) -> DataFrame:
        return self.df.select(*self.base, *[c.alias(n) for n, c in fields.items()])

    def judge(self, ok: Column) -> Column:
        """Fix tokens and state; the fields are built above and pruned by need."""
        self.stage(verdict=_state(ok, net.is_loopback(F.col("_ip_text"))))
        self.df = _once(self.df, self.base, {c: F.col(c) for c in self.df.columns if c not in self.base})
        return F.col("_verdict")


def _one_space_end(text: Column) -> Column:
    return text.endswith(" ") & ~text.endswith("  ")


def _wide(lines: DataFrame, kinds: tuple[str, ...], kind: Column | None = None) -> DataFrame:
    """Wide rows.  After the agent an edge line is cut at plain spaces, quotes or not."""
    cut = _Spaced(lines, kinds, kind)
    cut.cut()
    cut.cut_wide()
    q, w, a, tail = F.col("_q"), F.col("_w"), F.col("_a"), F.col("_tail")
    mid = _at(q, 2)
    cut.stage(es=cut.pick(edge=_dash_to_zero(_at(w, 3)), powza=F.lit(0.0)))
    edge_ok = _all(
        _at(q, 0) == "",
        F.size(q) >= 6,
        F.size(a) == 2,
        mid.startswith(" ") & _one_space_end(mid),
        _at(q, 3) != "",
        _at(q, 4) == " ",
        F.col("_es").isNotNull(),
    )
    powza_ok = _all(F.size(a) == 6, _one_space_end(_at(q, 0)))
    ok = _all(cut.basics_ok(), F.col("_ua_low") != "", cut.pick(edge=edge_ok, powza=powza_ok))
    state = cut.judge(ok)
    edge_hit = (
        F.when(F.size(q) < 7, NO_HIT_TEXT).when(F.size(tail) == 0, "-").otherwise(_at(tail, 0))
    )
    fields = {
        "machine": _at(w, 1),
        **cut.basics(),
        "url": F.col("_path"),
        "suffix": net.suffix_class(F.col("_path")),
        "status": _at(a, 0),
        "refer": cut.pick(edge=net.refer_host(_at(q, 3)), powza=F.lit("-")),
        "ua": agent.keyword_of(F.col("_ua_low")),
        "es": F.col("_es"),
        "hit": cut.pick(edge=edge_hit, powza=F.lit(NO_HIT_TEXT)),
        "dd": F.coalesce(F.when(F.size(tail) > 11, _at(tail, 10).try_cast("int")), F.lit(0)),
        "rk": _or_dash(_at(tail, 11)),
        "up": _or_dash(_at(tail, 12)),
        "Fa": _or_dash(_at(tail, 13)),
        "Fv": _or_dash(_at(tail, 14)),
        "platform": cut.pick(edge=net.envelope_platform(_at(w, 0)), powza=F.lit("-")),
        "node": F.coalesce(F.col("_node").cast("string"), F.lit("0")),
        "_state": state,
        "_raw_ip": _at(w, 2),
    }
    return cut.build(fields)


def _billing(lines: DataFrame, kinds: tuple[str, ...], kind: Column | None = None) -> DataFrame:
    """Billing rows: nothing after the byte count matters, but for the node."""
    cut = _Spaced(lines, kinds, kind)
    cut.cut()
    q, w, a = F.col("_q"), F.col("_w"), F.col("_a")
    edge_ok = _all(_at(q, 0) == "", _at(q, 2).startswith(" "))
    state = cut.judge(
        _all(cut.basics_ok(), cut.pick(edge=edge_ok, powza=F.lit(True), media=F.lit(True)))
    )
    es_text = cut.pick(edge=_at(w, 3), powza=_at(a, 3), media=F.lit("0"))
    return cut.build(
        {
            **cut.basics(),
            "status": cut.pick(edge=_at(a, 0), powza=_at(a, 0), media=F.lit("0")),
            "es": F.coalesce(es_text.try_cast("double"), F.lit(0.0)),
            "node": F.coalesce("_node", F.lit(0).cast("bigint")),
            "_state": state,
        }
    )


def _machine_cut(lines: DataFrame) -> DataFrame:
    """Machine rows: the client must be a bare address, only 127.0.0.1 is dropped."""
    wide = _wide(lines, (EDGE,))
    bare = ~F.col("_raw_ip").startswith(ENVELOPE_MARK)
    ok = _all(F.col("_state") != "reject", bare, F.col("ip").isNotNull())
    return wide.withColumns(
        {
            "fv_hit": speed.first_word_has_hit(F.col("Fv")),
            "_state": _state(ok, net.is_loopback(F.col("_raw_ip"), "equals")),
        }
    )


def line_kind(value: Column, media: bool) -> Column:
    """Format by the first word; a line without a space has no format."""
    word = F.upper(F.substring_index(value, " ", 1))
    kind = F.when(~value.contains(" "), F.lit(None)).when(word.contains(POWZA_WORD), POWZA)
    if media:
        kind = kind.when(word.contains(MEDIA_WORD), MEDIA)
    return kind.otherwise(EDGE)


def _mark_unknown(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("_state", F.coalesce("_state", F.lit("reject")))


# ------------------------------------------------------------ row families
def to_access(parsed: DataFrame, dims: Dims) -> DataFrame:
    """Look up owner, isp and province of a cut wide line."""
    given = _given(parsed)
    df = enrich.locate(enrich.map_domain(parsed, dims.domains), dims)
    df = df.withColumn("timestmp", timing.stamp(F.col("ts_sec")))
    return df.select("value", "_state", "ts_sec", *given, *ACCESS_LOG.names)


def to_billing(parsed: DataFrame, dims: Dims) -> DataFrame:
    df = enrich.locate(enrich.map_domain(parsed, dims.domains), dims, enrich.PLACE)
    df = df.withColumns({"platform": F.lit("-"), "pop_id": F.lit(0)})
    return df.select("value", "_state", *_given(parsed), *BILLING.names)


def with_speed(df: DataFrame) -> DataFrame:
    """Speed and its zero mark, of rows that carry es and cs; no lookup."""
    df = df.withColumn("speed", speed.speed_kbps(F.col("es"), F.col("cs")))
    return df.withColumns(
        {"zero_speed": speed.zero_speed(F.col("speed")), "speed_interval": F.lit("0"), "req_num": F.lit(1)}
    )


def with_hit_type(df: DataFrame, parents: DataFrame) -> DataFrame:
    """Hit type of rows that carry hit, up and fv_hit; looks up the parents."""
    df = enrich.flag_parent(df, parents)
    kind = speed.hit_type(F.col("hit"), F.col("up"), F.col("fv_hit"), F.col("up_is_parent"))
    return df.withColumn("hit_type", kind)


def to_machine(parsed: DataFrame, dims: Dims) -> DataFrame:
    df = enrich.locate(enrich.map_domain(parsed, dims.domains), dims)
    df = with_hit_type(enrich.with_machine(with_speed(df), dims.machines), dims.parents)
    return df.select("value", "_state", *_given(parsed), *MACHINE.names)


def edge(lines: DataFrame, dims: Dims) -> DataFrame:
    return to_access(_wide(lines, (EDGE,)), dims)


def powza(lines: DataFrame, dims: Dims) -> DataFrame:
    return to_access(_wide(lines, (POWZA,)), dims)


def edge_billing(lines: DataFrame, dims: Dims) -> DataFrame:
    return to_billing(_billing(lines, (EDGE,)), dims)


def powza_billing(lines: DataFrame, dims: Dims) -> DataFrame:
    return to_billing(_billing(lines, (POWZA,)), dims)


def media_billing(lines: DataFrame, dims: Dims) -> DataFrame:
    return to_billing(_billing(lines, (MEDIA,)), dims)


def machine(lines: DataFrame, dims: Dims) -> DataFrame:
    return to_machine(_machine_cut(lines), dims)


def dispatch_access(lines: DataFrame, dims: Dims) -> DataFrame:
    """Mixed lines -> wide rows (powza, else edge), one pass, one set of lookups."""
    cut = _wide(lines, (EDGE, POWZA), line_kind(F.col("value"), media=False))
    return to_access(_mark_unknown(cut), dims)


def dispatch_billing(lines: DataFrame, dims: Dims) -> DataFrame:
    """Mixed lines -> billing rows (powza, media, else edge)."""
    cut = _billing(lines, (EDGE, POWZA, MEDIA), line_kind(F.col("value"), media=True))
    return to_billing(_mark_unknown(cut), dims)


# ------------------------------------------------------------------ #_# lines
def _hash_split(lines: DataFrame, strip: bool) -> DataFrame:
    text = net.strip_envelope(F.col("value")) if strip else F.col("value")
    df = lines.withColumn("_f", F.split(text, HASH_SEPARATOR))
    f = F.col("_f")
    bracketed = _at(f, 3)
    made = {
        "_f": f,
        "_h": F.split(_at(f, 0), " "),
        "_sec": timing.log_time(F.substring(bracketed, 2, F.length(bracketed) - 2)),
        "_ip": net.ip_to_long(_at(f, 1)),
        "_url": _at(F.split(_at(f, 4), " "), 1),
        "_cs": F.substring_index(_at(f, 14), " ", 1).try_cast("bigint"),
    }
    return _once(df, lines.columns, made)


def _hash_common() -> Fields:
    f = F.col("_f")
    name = _at(F.col("_h"), 1)
    return {
        "machine": name,
        "ip_text": _at(f, 1),
        "ip": F.col("_ip"),
        "ts_sec": F.col("_sec"),
        "request_url": F.col("_url"),
        "status": _at(f, 5),
        "cs": F.col("_cs"),
        "refer": _at(f, 7),
        "ua": agent.ua_device(_at(f, 8)),
        "hit": F.substring_index(_at(f, 12), " ", 1),
        "dd": F.lit(0),
        **{c: F.lit("-") for c in ("rk", "up", "Fa", "Fv", "platform")},
        "node": F.coalesce(net.machine_ip(name).cast("string"), F.lit("0")),
    }


def _hash_ok(f: Fields, *more: Column) -> Column:
    return _all(
        f["machine"].isNotNull(),
        f["ip"].isNotNull(),
        f["ts_sec"].isNotNull(),
        f["request_url"].isNotNull(),
        f["cs"].isNotNull(),
        F.size(F.split(f["machine"], "-")) >= 6,
        *more,
    )


def hash_v1(lines: DataFrame, dims: Dims) -> DataFrame:
    """``#_#`` line, domain from the request URL."""
    df = _hash_split(lines, strip=False)
    f = _hash_common()
    url = f["request_url"]
    path = net.url_path(url)
    f |= {
        "host": net.url_host(url),
        "url": path,
        "suffix": net.suffix_class(path, SUFFIXES_BASE),
        "es": _at(F.col("_f"), 9).try_cast("double"),
    }
    f["_state"] = F.when(_hash_ok(f, f["es"].isNotNull(), f["host"] != ""), "ok").otherwise("reject")
    return to_access(df.select("value", *_given(lines), *[c.alias(n) for n, c in f.items()]), dims)


def hash_v2(lines: DataFrame, dims: Dims) -> DataFrame:
    """``#_#`` line, enveloped or not, domain from word 3 of field 0.

    Loopback lines are rejects here.  The owner is looked up by the plain
    domain; ``https_`` is put in front afterwards.
    """
    df = _hash_split(lines, strip=True)
    f = _hash_common()
    path = net.drop_query(f["request_url"])
    f |= {
        "host": _at(F.col("_h"), 2),
        "url": path,
        "suffix": net.suffix_class(path, SUFFIXES_BASE),
        "es": F.coalesce(_at(F.col("_f"), 9).try_cast("double"), F.lit(0.0)),
        "is_https": _all(F.size("_f") == 16, _at(F.col("_f"), 15).startswith("https")),
    }
    ok = _hash_ok(f, ~net.is_loopback(f["ip_text"], "equals"), f["host"].isNotNull())
    f["_state"] = F.when(ok, "ok").otherwise("reject")
    cut = df.select("value", *_given(lines), *[c.alias(n) for n, c in f.items()])
    looked_up = enrich.map_domain(cut, dims.domains)
    looked_up = enrich.locate(looked_up, dims)
    secure = F.when(F.col("is_https"), F.concat(F.lit("https_"), "domain")).otherwise(F.col("domain"))
    return looked_up.withColumns(
        {"timestmp": timing.stamp(F.col("ts_sec")), "domain": secure}
    ).select("value", "_state", "ts_sec", *_given(lines), *ACCESS_LOG.names)


def hash_dir(lines: DataFrame) -> DataFrame:
    """``#_#`` line -> (domain, dir, timestamp, flow_size, https_flag)."""
    df = _hash_split(lines.filter(F.col("value").contains(HASH_SEPARATOR)), strip=True)
    f = _hash_common()
    enveloped = F.col("value").startswith("@|@")
    loop = F.when(enveloped, net.is_loopback(f["ip_text"], "prefix127.0.0")).otherwise(
        net.is_loopback(f["ip_text"], "equals")
    )
    last = F.element_at("_f", -1)
    sec = f["ts_sec"]
    first = net.first_dir(f["request_url"])
    domain = _at(F.col("_h"), 2)
    ok = _all(
        domain.isNotNull(), first.isNotNull(), f["cs"].isNotNull(), sec.isNotNull(), f["ip_text"].isNotNull()
    )
    return df.select(
        "value",
        *_given(lines),
        _state(ok, loop).alias("_state"),
        domain.alias("domain"),
        first.alias("dir"),
        timing.five_label(sec).alias("timestamp"),
        f["cs"].alias("flow_size"),
        F.when(last.startswith("https"), "https").otherwise("http").alias("https_flag"),
    )


# ----------------------------------------------------------------- JSON lines
#: The numbers of a line as such: quoted text is none here, whatever it holds.
JSON_NUMBERS = "es double, tl struct<value: double>, lt double, cs double, Fs double"


def _json_rows(lines: DataFrame, strict: bool) -> DataFrame:
    """Fields of a line; an absent number is 0, one that is no number of its kind rejects the line.

    The strict form reads whole numbers through doubles, so it takes ``5.0`` and cuts ``5.7``.
    """
    df = _once(lines, lines.columns, {"_j": F.from_json("value", JSON_LINE), "_n": F.from_json("value", JSON_NUMBERS)})
    j = {c: F.col(f"_j.{c}") for c in JSON_LINE.names if c != "tl"} | {"tl": F.col("_j.tl.value")}
    doubles = {c: j[c].try_cast("double") for c in ("es", "tl", "lt")}
    if strict:
        whole = {c: j[c].try_cast("double").cast("bigint") for c in ("cs", "Fs")}
        given = _all(*[c.isNotNull() for c in j.values()])
    else:
        whole = {"cs": j["cs"].try_cast("bigint")}
        given = F.lit(True)
    numbers = doubles | whole
    bare = {c: F.col("_n.tl.value" if c == "tl" else f"_n.{c}") for c in numbers}
    right = _all(*[j[c].isNull() | (x.isNotNull() & bare[c].isNotNull()) for c, x in numbers.items()])
    j |= {c: F.coalesce(x, F.lit(0.0)) for c, x in doubles.items()}
    j |= {c: F.coalesce(x, F.lit(0).cast("bigint")) for c, x in whole.items()}
    if not strict:
        j |= {c: F.coalesce(j[c], F.lit("")) for c in ("rm", "st", "hostname", "ru", "ua", "rv", "rf", "a", "Fs")}
    ok = _all(given, right, F.col("_j").isNotNull(), net.ip_to_long(j["a"]).isNotNull())
    failed = F.col("value").contains(JSON_FAILURE_MARK)
    return df.select(
        "value",
        *_given(lines),
        F.when(ok & ~failed, "ok").otherwise("reject").alias("_state"),
        F.regexp_extract(j["ru"], "^http://([^/]*)/", 1).alias("host"),
        net.ip_to_long(j["a"]).alias("ip"),
        timing.lt_seconds(j["lt"]).alias("timestampLong"),
        net.suffix_class(j["ru"], SUFFIXES_BASE, fold_case=False).alias("suffix"),
        agent.ua_device(j["ua"]).alias("ua"),
        F.lit("").alias("refer"),
        F.lit(0).alias("dd"),
        j["Fs"].cast("string").alias("Fs"),
        *[j[c].alias(c) for c in ("hostname", "ru", "cs", "es", "st", "tl", "rm", "rv", "rf", "a")],
    )


def _json(lines: DataFrame, dims: Dims, strict: bool) -> DataFrame:
    df = enrich.locate(enrich.map_domain(_json_rows(lines, strict), dims.domains), dims)
    df = df.withColumn("timestamp", timing.stamp(F.col("timestampLong")))
    return df.select("value", "_state", *_given(lines), *JSON_LOG.names)


def json(lines: DataFrame, dims: Dims) -> DataFrame:
    """JSON line; absent keys become '' or 0."""
    return _json(lines, dims, strict=False)


def json_strict(lines: DataFrame, dims: Dims) -> DataFrame:
    """JSON line with every key required."""
    return _json(lines, dims, strict=True)


# ----------------------------------------------------- directory and slow rate
def directories(lines: DataFrame, dims: Dims) -> DataFrame:
    """Mixed line -> (domain, dir1, dir2, timestmp to the minute, cs, pno, isp, prv)."""
    named = lines.filter(F.col("value").rlike("://[^/]*/"))
    rows = dispatch_access(named, dims)
    dir1, dir2 = net.dir_parts(F.col("url"))
    return rows.select(
        "value",
        "_state",
        *_given(lines),
        "domain",
        dir1.alias("dir1"),
        dir2.alias("dir2"),
        F.substring("timestmp", 1, 12).alias("timestmp"),
        "cs",
        F.lit("").alias("pno"),
        "isp",
        "prv",
    )


def slow_rate(
    lines: DataFrame, named: DataFrame, domains: list[str] | DataFrame = SLOW_DOMAINS
) -> DataFrame:
    """Slow-rate row; unwanted lines are dropped in the order of the checks.

    ``domains`` is a list, or a table with a ``domain`` column.
    """
    df = lines.withColumn("_line", net.strip_envelope(F.trim("value")))
    df = df.withColumns({"_q": F.split("_line", '"', 3), "_w": F.split("_line", " ", 5)})
    q, w = F.col("_q"), F.col("_w")
    made = {
        "_request": _at(q, 1),
        "_w": w,
        "_s": F.split(_at(q, 2), " ", 4),
        "_sec": timing.log_time(F.regexp_extract(_at(q, 0), r"\[([^\]]*)\]", 1)),
        "_ip": net.ip_to_long(_at(w, 2)),
        "_host_ip": net.ip_to_long(net.last_word(F.col("_line"))),
        "_domain": net.url_host(_at(q, 1)),
    }
    df = _once(df, lines.columns, made)
    s, sec, host_ip, domain = F.col("_s"), F.col("_sec"), F.col("_host_ip"), F.col("_domain")
    ip_text, es_text, cs_text, status = _at(w, 2), _at(w, 3), _at(s, 2), _at(s, 1)
    es, cs = es_text.try_cast("float"), cs_text.try_cast("float")
    if isinstance(domains, DataFrame):
        names = domains.select(F.col("domain").alias("_listed")).distinct()
        df = df.join(names, domain == F.col("_listed"), "left")
        listed = F.col("_listed").isNotNull()
    else:
        listed = domain.isin(*domains)

    def absent(c: Column) -> Column:
        return c.isNull()

    state = (
        F.when(absent(ip_text) | absent(es_text), "reject")
        .when(net.is_loopback(ip_text, "equals"), "drop")
        .when(F.trim(es_text) == "-", "drop")
        .when(absent(es), "reject")
        .when(es < 0, "drop")
        .when(absent(sec) | absent(F.col("_request")), "reject")
        .when(~listed, "drop")
        .when(F.size(s) < 4, "reject")
        .when(status.startswith("4") | status.startswith("5"), "drop")
        .when(F.trim(cs_text) == "-", "drop")
        .when(absent(cs), "reject")
        .when(cs < SLOW_MIN_BYTES, "drop")
        .when(absent(F.col("_ip")) | absent(host_ip), "reject")
        .otherwise("ok")
    )
    rows = df.select(
        "value",
        *_given(lines),
        state.alias("_state"),
        domain.alias("domain"),
        _at(w, 1).alias("host"),
        F.col("_ip").alias("ip"),
        host_ip.alias("host_ip"),
        timing.five_label(sec).alias("time"),
        speed.slow_flag(es, cs).alias("ifSlow"),
    )
    return enrich.client_host_isp(rows, named).select(
        "value", "_state", *_given(lines), "domain", "host", "isp", "province", "time", "ifSlow"
    )


# ------------------------------------------------------------ line rewriting
def trim_request_host(lines: DataFrame) -> DataFrame:
    """Cut ``scheme://host`` out of the request of a ``#_#`` line.

    Lines without ``]#_#`` are dropped; a request without ``://`` is unchanged;
    one with no ``/`` after the host is dropped.
    """
    head, request, rest = (
        F.regexp_extract("value", r"^(.*?\]#_#)(.*?)(#_#.*)$", i) for i in (1, 2, 3)
    )
    df = lines.withColumns({"_head": head, "_req": request, "_rest": rest})
    bare = F.regexp_replace("_req", "^([^ ]* )[^/]*://[^/]*", "$1")
    has_path = F.col("_req").rlike("://[^/]*/")
    out = F.when(F.col("_head") == "", F.lit(None)).when(~F.col("_req").contains("://"), F.col("value"))
    out = out.when(has_path, F.concat("_head", bare, "_rest"))
    df = df.withColumn("value", out).filter(F.col("value").isNotNull())
    return df.select(*lines.columns)


def extract_original(lines: DataFrame, raw: bool = False) -> DataFrame:
    """Original line out of a JSON wrapper; ``raw`` keeps the escapes."""
    if raw:
        found = F.nullif(F.regexp_extract("value", r'ori":"(.*?)","', 1), F.lit(""))
    else:
        found = F.get_json_object("value", "$.ori")
    return lines.withColumn("value", found).filter(F.col("value").isNotNull())


# ------------------------------------------------------ format-string parsing
_TOKEN = r'\[[^\]]*\]|"(?:[^"]|"(?=[^ ]))*"|\S+'


def format_positions(fmt: str) -> dict[str, int]:
    """Output column -> 1-based token place, for an access-log format string.

    The timing field stands for nine tokens: it and all later fields move by 8.
    """
    places: dict[str, int] = {}
    shift = 0
    for place, token in enumerate(re.findall(_TOKEN, fmt.replace("\\", "")), start=1):
        token = token[1:-1] if token[0] in '["' else token
        if token == FORMAT_SHIFT_FIELD:
            shift = FORMAT_SHIFT
        if token in FORMAT_FIELDS:
            places[FORMAT_FIELDS[token]] = place + shift
    return places


def by_format(lines: DataFrame, fmt: str) -> DataFrame:
    """Lines -> one text column per field of the format string."""
    df = _once(lines, lines.columns, {"_t": F.regexp_extract_all("value", F.lit(_TOKEN), F.lit(0))})

    def token(place: int) -> Column:
        t = _at(F.col("_t"), place - 1)
        wrapped = t.startswith("[") | t.startswith('"')
        return F.when(wrapped, F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)

    return df.select(*lines.columns, *[token(p).alias(c) for c, p in format_positions(fmt).items()])
