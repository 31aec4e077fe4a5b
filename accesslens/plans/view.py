"""Access log and dimensions derived from the given tables.

One log row per event; hosts come from the page URLs, machines from suppliers,
ranges and areas from nations.  ``oracle_view`` states the same view in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from accesslens.constants import LOG_TIME_FORMAT
from accesslens.functions import net, speed
from accesslens.operators import enrich, filters, parse
from accesslens.schemas import BILLING, TABLES
from accesslens.sources.dims import Dims, KeptDims
from accesslens.sources.dimstore import DimStore

EPOCH0 = 1704067200  # 2024-01-01 00:00:00 UTC
SPAN = 7200
IP_BASE = 16777216
IP_SPAN = 3690987520
RANGE_STEP = 147639500
RANGE_WIDTH = 140000000
PRV_SHIFT = 30000000


def event_seconds(ts: Column) -> Column:
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", zero, ts)


class LogView:
    """Lazily built frames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.store = DimStore(spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------- log rows
    @cached_property
    def n_pages(self) -> int:
        return self._count("pages")

    @cached_property
    def n_suppliers(self) -> int:
        return self._count("supplier")

    def events(self, events: DataFrame | None = None) -> DataFrame:
        """Log columns that need no other table."""
        e = self.table("events") if events is None else events
        k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("bigint")
        e = e.withColumn("k", k)
        sec = F.lit(EPOCH0) + (event_seconds(F.col("ts")) - EPOCH0) % SPAN
        mixed = (F.col("user_id") * 7919 + F.col("event_id") * 104729) * 2557
        kinds = {"view": "200", "click": "206", "purchase": "304", "signup": "404", "error": "504"}
        status = F.coalesce(*[F.when(F.col("event_type") == kind, code) for kind, code in kinds.items()])
        agents = F.array(
            *[F.lit(a) for a in (
                "Mozilla/5.0 (Linux; Android 5.1.1; Mobile Safari)",
                "Mozilla/5.0 (iPhone; CPU iPhone OS 9_3_4)",
                "MIUI/7 Android 4.4 Browser",
                "Mozilla/5.0 (Windows NT 6.1) Chrome/50.0",
                "Mozilla/5.0 (X11; Linux x86_64) Firefox/43.0",
                "curl/7.19.7",
            )]
        )
        return e.select(
            "event_id",
            "user_id",
            "k",
            sec.alias("ts_sec"),
            (F.col("event_id") % self.n_pages).alias("page_id"),
            (F.lit(IP_BASE) + mixed % IP_SPAN).alias("ip"),
            (F.col("event_id") % (self.n_suppliers + 1)).alias("node"),
            F.floor(F.col("value") * 65536).alias("cs"),
            ((F.col("event_id") * 37) % 20011).cast("double").alias("es"),
            status.alias("status"),
            F.when(F.col("k") % 3 == 0, "FCACHE_HIT_MEM").when(F.col("k") % 3 == 1, "FCACHE_MISS").otherwise("-").alias("hit"),
            F.when(F.col("k") % 5 == 0, "-").otherwise(F.concat(F.lit("10.0.0."), (F.col("k") % 20).cast("string"))).alias("up"),
            F.when(F.col("k") % 7 == 0, "-").otherwise(F.concat(F.lit("10.1.0."), (F.col("k") % 20).cast("string"))).alias("Fa"),
            F.when(F.col("k") % 2 == 0, "HIT").otherwise("MISS").alias("fv"),
            F.get(agents, (F.col("user_id") % 6).cast("int")).alias("agent"),
            (sec + (F.col("event_id") * 13) % 1200).alias("arrival_sec"),
        )

    @cached_property
    def page_hosts(self) -> DataFrame:
        url = F.col("url")
        return self.table("pages").select(
            "page_id", "url", net.url_host(url).alias("host"), net.url_path(url).alias("path")
        )

    def log(self, pages: bool = True, machine: bool = False, events: DataFrame | None = None) -> DataFrame:
        """The access log; joins only the tables the caller needs."""
        df = self.events(events)
        if pages:
            df = df.join(self.page_hosts, "page_id")
        if machine:
            names = self.table("supplier").select((F.col("s_suppkey") + 1).alias("node"), F.col("s_name").alias("machine"))
            df = df.join(names, "node", "left").withColumn("machine", F.coalesce("machine", F.lit("-")))
        return df

    # ----------------------------------------------------------- dimensions
    @cached_property
    def hosts(self) -> DataFrame:
        pages = self.page_hosts.groupBy("host").agg(F.min("page_id").alias("p"))
        dots = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit("")))
        return pages.withColumn("dots", dots)

    @cached_property
    def domains(self) -> DataFrame:
        user = (F.col("p") % 20).cast("string").alias("userid")
        exact = self.hosts.filter("p % 2 = 0").select(F.col("host").alias("name"), F.lit(False).alias("wildcard"), user)
        wild = (
            self.hosts.filter("p % 2 = 1 and dots >= 3 and p % 3 = 0")
            .groupBy(net.parent_domain(F.col("host")).alias("name"))
            .agg(F.min("p").alias("p"))
            .select("name", F.lit(True).alias("wildcard"), user)
        )
        return exact.unionByName(wild)

    @cached_property
    def ranges(self) -> DataFrame:
        n = F.col("n_nationkey").cast("bigint")
        lo = F.lit(IP_BASE) + n * RANGE_STEP
        return self.table("nation").select(
            lo.alias("lo"), (lo + RANGE_WIDTH).alias("hi"), "n_nationkey", "n_name", "n_regionkey"
        )

    @cached_property
    def isp_ranges(self) -> DataFrame:
        return self.ranges.select("lo", "hi", (F.lit(11) + F.col("n_nationkey") % 9).cast("int").alias("code"))

    @cached_property
    def prv_ranges(self) -> DataFrame:
        """Unlike the isp ranges: begins PRV_SHIFT addresses later, and ends as much earlier."""
        lo, hi = F.col("lo") + PRV_SHIFT, F.col("hi") - PRV_SHIFT
        return self.ranges.select(lo.alias("lo"), hi.alias("hi"), F.col("n_nationkey").alias("code"))

    @cached_property
    def named_ranges(self) -> DataFrame:
        isp = (F.lit(11) + F.col("n_nationkey") % 9).cast("int")
        return self.ranges.select(
            "lo",
            "hi",
            isp.alias("isp"),
            F.concat(F.lit("ISP_"), isp.cast("string")).alias("isp_name"),
            F.col("n_nationkey").alias("prv"),
            F.col("n_name").alias("prv_name"),
        )

    @cached_property
    def area(self) -> DataFrame:
        return self.table("nation").filter("n_nationkey % 7 <> 6").select(
            F.col("n_nationkey").cast("string").alias("area_id"),
            F.col("n_regionkey").cast("string").alias("area_pid"),
            F.when(F.col("n_nationkey") % 2 == 0, "10").otherwise("20").alias("area_cid"),
        )

    @cached_property
    def machines(self) -> DataFrame:
        s, n, r = self.table("supplier"), self.table("nation"), self.table("region")
        joined = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(
            r, F.col("n_regionkey") == F.col("r_regionkey")
        )
        return joined.select(
            F.col("s_name").alias("host"),
            F.col("r_name").alias("machine_isp"),
            (F.col("r_regionkey") + 10).alias("machine_isp_code"),
            F.col("n_name").alias("machine_prv"),
            (F.col("n_nationkey") + 8600).alias("machine_prv_code"),
            F.concat(F.lit("c0"), F.col("r_regionkey").cast("string")).alias("platform"),
            net.long_to_ip(F.lit(167772160) + F.col("s_suppkey")).alias("machine_ip"),
            F.col("s_suppkey").cast("int").alias("pop_id"),
        )

    @cached_property
    def parents(self) -> DataFrame:
        """10.0.0.0 to 10.0.0.9, one per region and half."""
        r = F.col("r_regionkey")
        return self.table("region").select(
            F.explode(F.array(r * 2, r * 2 + 1)).alias("i")
        ).select(F.concat(F.lit("10.0.0."), F.col("i").cast("string")).alias("ip"))

    # Lookup tables are kept by the store: written once for each version of the files, read by path from then on.
    def files(self, *names: str) -> list[str]:
        return [f"{self.sf_dir}/{n}.parquet" for n in names]

    @cached_property
    def dims(self) -> KeptDims:
        nation, pages = self.files("nation"), self.files("pages")
        sources = dict(domains=pages, isp=nation, prv=nation, area=nation, named=nation, places=nation)
        sources |= dict(machines=self.files("supplier", "nation", "region"), parents=self.files("region"))
        return KeptDims(lambda name: self._given.made(name), self.store, sources)

    @cached_property
    def _given(self) -> Dims:
        return Dims(
            domains=self.domains,
            isp=self.isp_ranges,
            prv=self.prv_ranges,
            area=self.area,
            machines=self.machines,
            parents=self.parents,
            named=self.named_ranges,
        )

    @property
    def owners(self) -> DataFrame:
        return self.dims.domains

    @cached_property
    def codes(self) -> DataFrame:
        """Isp and province by address."""
        return self.store.table("codes", lambda: enrich.place_table(self.isp_ranges, self.prv_ranges), self.files("nation"))

    def _count(self, name: str) -> int:
        count = lambda: self.table(name).agg(F.count(F.lit(1)).alias("n"))
        return self.store.first(f"n_{name}", count, self.files(name))["n"]

    # -------------------------------------------------------- row families
    # Each has the lookups its roll-ups name, and no others.
    def owned(self, machine: bool = False) -> DataFrame:
        """Log rows of owned domains."""
        return filters.known_domain(enrich.map_domain(self.log(machine=machine), self.owners))

    def located(self, rows: DataFrame, columns: tuple[str, ...] = ("isp", "prv")) -> DataFrame:
        area = any(c.startswith("area") for c in columns)
        return enrich.with_place(rows, self.dims.places if area else self.codes, columns)

    def billing(self) -> DataFrame:
        """Billing rows of owned domains."""
        rows = self.located(self.owned(), enrich.PLACE)
        return rows.withColumns({"platform": F.lit("-"), "pop_id": F.lit(0)}).select(*BILLING.names)

    def _hits(self, rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("fv_hit", speed.first_word_has_hit(F.col("fv")))
        return parse.with_hit_type(rows, self.dims.parents)

    def hit_rows(self) -> DataFrame:
        """Owner, isp, province, hit type and speed; nothing of the machine."""
        return self._hits(parse.with_speed(self.located(self.owned())))

    def speed_rows(self) -> DataFrame:
        """Owner and speed."""
        return parse.with_speed(self.owned())

    def machine_rows(self, hits: bool = False, columns: tuple[str, ...] = ()) -> DataFrame:
        """Owner, machine and speed; hit type and place columns on request."""
        rows = enrich.with_machine(parse.with_speed(self.owned(machine=True)), self.dims.machines)
        rows = self._hits(rows) if hits else rows
        return self.located(rows, columns) if columns else rows

    # ------------------------------------------------------------ raw lines
    # The rows of ``log(machine=True)`` as text; lines with id 7 mod 100 are
    # damaged (no bracketed time) and must come back as rejects.

    @staticmethod
    def _damaged() -> Column:
        return F.col("event_id") % 100 == 7

    def _time(self) -> Column:
        text = F.date_format(F.timestamp_seconds("ts_sec"), LOG_TIME_FORMAT)
        return F.when(self._damaged(), "-").otherwise(F.concat(F.lit("["), text, F.lit("]")))

    @staticmethod
    def _ip(c: str) -> Column:
        return net.long_to_ip(F.col(c))

    @staticmethod
    def _whole(c: str) -> Column:
        return F.col(c).cast("bigint").cast("string")

    @staticmethod
    def _quoted(*parts: Column) -> Column:
        return F.concat(F.lit('"'), *parts, F.lit('"'))

    def edge_text(self) -> Column:
        refer = F.when(F.col("k") % 4 == 0, "-").otherwise("http://ref.example.com/x")
        return F.concat_ws(
            " ",
            F.when(F.col("k") % 2 == 0, "@|@c06.i06@|@LOG").otherwise("LOG_edge"),
            "machine",
            self._ip("ip"),
            self._whole("es"),
            F.lit("-"),
            self._time(),
            self._quoted(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1")),
            "status",
            self._whole("cs"),
            self._quoted(refer),
            self._quoted(F.col("agent")),
            F.col("hit"),
            F.lit(" 0.000 0.000 - - - - 0.000 0.174 0.174"),
            (F.col("k") % 2).cast("string"),
            F.lit("-"),
            F.col("up"),
            F.col("Fa"),
            F.concat(F.col("fv"), F.lit(" from cache")),
            self._ip("node"),
        )

    def powza_text(self) -> Column:
        return F.concat_ws(
            " ",
            F.lit("LOG_POWZA_cache"),
            "machine",
            F.concat(F.col("ts_sec").cast("string"), F.lit(".000")),
            self._ip("ip"),
            F.lit("- -"),
            self._time(),
            "status",
            self._whole("cs"),
            F.concat(F.lit("http://"), "host", F.lit("/")),
            self._whole("es"),
            F.lit("GET"),
            "url",
            self._quoted(F.col("agent")),
            F.lit('"-" -'),
            self._quoted(F.col("url")),
            self._ip("node"),
        )

    def media_text(self) -> Column:
        return F.concat_ws(
            " ",
            F.lit("LOG_MEDIA_cache"),
            "machine",
            F.lit("live rtmp"),
            self._time(),
            F.concat(F.lit("13071_"), F.col("event_id").cast("string")),
            F.concat(F.lit("rtmp://"), "host", F.lit("/")),
            F.lit("app stream"),
            self._ip("ip"),
            self._ip("node"),
            F.lit('play "rtmp://x/y" "" 0'),
            self._whole("cs"),
            F.lit('5 11 "streaming:status" "" "WIN 22,0,0,168" - - - - - (3m 1s)'),
            self._ip("node"),
        )

    def hash_text(self, bare_path: bool) -> Column:
        """``#_#`` line; k 0 mod 5 is https, id 3 mod 50 a loopback client, and
        with ``bare_path`` k 0 mod 4 asks for a path without a host."""
        node = F.col("node")
        name = F.format_string("cnc-tj-010-000-%03d-%03d", F.shiftright(node, 8), node.bitwiseAND(255))
        url = F.col("url")
        if bare_path:
            url = F.when(F.col("k") % 4 == 0, F.regexp_replace("url", "^[a-z]*://[^/]*", "")).otherwise(url)
        fields = F.concat_ws(
            "#_#",
            "host",
            F.when(F.col("event_id") % 50 == 3, "127.0.0.1").otherwise(self._ip("ip")),
            F.lit("-"),
            self._time(),
            F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1")),
            "status",
            self._whole("cs"),
            F.lit("-"),
            "agent",
            self._whole("es"),
            F.lit("0.000"),
            F.lit("10.0.0.1"),
            F.concat("hit", F.lit(" -")),
            F.lit("agent"),
            F.concat(self._whole("cs"), F.lit(" x")),
            F.concat(F.when(F.col("k") % 5 == 0, "https ").otherwise("http "), self._ip("node")),
        )
        return self._wrap(name, fields)

    @staticmethod
    def _wrap(name: Column, rest: Column) -> Column:
        """Odd k gets the six-mark envelope."""
        plain = F.concat(F.lit("LOG "), name, F.lit(" "), rest)
        wrapped = F.concat(F.lit("@|@c06@|@68@|@POP_1@|@LOG "), name, F.lit(" @|@00000000@|@"), rest)
        return F.when(F.col("k") % 2 == 1, wrapped).otherwise(plain)

    def slow_text(self) -> Column:
        """Edge line with the server address last; a third shares the client's."""
        server = F.when(F.col("k") % 3 == 0, F.col("ip")).otherwise(
            F.lit(IP_BASE) + F.col("event_id") * 7919 * 1003 % IP_SPAN
        )
        rest = F.concat_ws(
            " ",
            F.when(F.col("event_id") % 50 == 3, "127.0.0.1").otherwise(self._ip("ip")),
            F.when(F.col("event_id") % 50 == 4, "-").otherwise(self._whole("es")),
            F.lit("0"),
            self._time(),
            self._quoted(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1")),
            "status",
            self._whole("cs"),
            F.lit('"-" "agent" mem 0.000 0.000'),
            net.long_to_ip(server),
        )
        return self._wrap(F.col("machine"), rest)

    def json_text(self) -> Column:
        """JSON line; the byte count is absent for id 4 mod 10 and spoilt for some ids mod 40: text, 5.7, a ``.0``, text for es.

        Ids 16 mod 40 have their status quoted, ids 17 mod 40 a quoted ``value`` under a key of their own.
        """
        failure = F.when(self._damaged(), F.lit(" _jsonparsefailure")).otherwise("")
        line = F.to_json(
            F.struct(
                "es",
                F.struct(F.lit(8.047).alias("value"), F.lit("s").alias("representation")).alias("tl"),
                F.lit("GET").alias("rm"),
                F.col("status").cast("bigint").alias("Fs"),
                F.concat(F.lit('line "'), F.col("event_id").cast("string"), F.lit('"')).alias("ori"),
                F.col("hit").alias("st"),
                F.col("machine").alias("hostname"),
                F.col("url").alias("ru"),
                F.col("agent").alias("ua"),
                F.lit("HTTP/1.1").alias("rv"),
                F.lit("-").alias("rf"),
                F.concat(self._ip("ip"), failure).alias("a"),
                F.when(F.col("event_id") % 10 != 4, F.col("cs")).alias("cs"),
                (F.col("ts_sec").cast("double") * 1e9).alias("lt"),
            )
        )
        odd = F.col("event_id") % 40
        cs = r'"cs":(\d+)'
        return (
            F.when(odd == 11, F.regexp_replace(line, cs, '"cs":"abc"'))
            .when(odd == 12, F.regexp_replace(line, cs, '"cs":5.7'))
            .when(odd == 13, F.regexp_replace(line, cs, '"cs":$1.0'))
            .when(odd == 15, F.regexp_replace(line, r'"es":[^,]*', '"es":"x"'))
            .when(odd == 16, F.regexp_replace(line, r'"Fs":(\d+)', '"Fs":"$1"'))
            .when(odd == 17, F.regexp_replace(line, r"^\{", r'{"extra":{"value":"x"},'))
            .otherwise(line)
        )

    def mixed_text(self) -> Column:
        """Every event as edge, powza or media line, by its id."""
        kind = F.col("event_id") % 3
        return F.when(kind == 0, self.edge_text()).when(kind == 1, self.powza_text()).otherwise(self.media_text())

    def lines(self, text: Column) -> DataFrame:
        return self.log(machine=True).select("event_id", "arrival_sec", text.alias("value"))
