"""Scalar expressions against plain Python, over generated values."""

import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from accesslens.functions import agent, net, speed, timing

SMALL = settings(max_examples=3, deadline=None)


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", expr(F.col("v"))).orderBy("i").collect()]


@SMALL
@given(st.lists(st.lists(st.integers(0, 999), min_size=4, max_size=4), min_size=1, max_size=40))
def test_ip_is_folded_without_range_check(spark, parts):
    texts = [".".join(map(str, p)) for p in parts]
    want = [((p[0] * 256 + p[1]) * 256 + p[2]) * 256 + p[3] for p in parts]
    assert column(spark, texts, "string", net.ip_to_long) == want


def test_ip_needs_four_numeric_parts(spark):
    bad = ["1.2.3", "1.2.3.4.5", "1.2.x.4", "", "-", "1..2.3", None, '113.107.250.15"']
    assert column(spark, bad, "string", net.ip_to_long) == [None] * len(bad)


@SMALL
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**11)), min_size=1, max_size=60))
def test_speed_divides_in_order(spark, pairs):
    df = spark.createDataFrame([(i, float(es), cs) for i, (es, cs) in enumerate(pairs)], "i int, es double, cs bigint")
    got = [r[1] for r in df.select("i", speed.speed_kbps(F.col("es"), F.col("cs"))).orderBy("i").collect()]

    def rule(es, cs):
        kbps = cs // 1024 // es * 1000 if es and cs else 0
        return kbps if 5 <= kbps <= 10240 else 0

    assert got == [rule(es, cs) for es, cs in pairs]


def test_speed_of_a_fraction_of_a_millisecond_is_zero(spark):
    assert column(spark, [0.5], "double", lambda es: speed.speed_kbps(es, F.lit(10**9))) == [0]


def test_labels(spark):
    secs = [0, 1, 59, 60, 299, 300, 301, 3599, 3600, 1478000000 + random.Random(1).randrange(10**6)]
    assert column(spark, secs, "bigint", timing.five_label) == [t // 300 * 300 + 300 for t in secs]
    assert column(spark, secs, "bigint", timing.minute_label) == [t // 60 * 60 for t in secs]
    assert column(spark, secs, "bigint", timing.hour_label) == [t // 3600 * 3600 for t in secs]
    assert timing.rollup_label("five", 0, 1234) == 1200
    assert timing.rollup_label("hour", 7201, 9999) == 7200
    assert timing.rollup_label("day", 7201, 9999) == 0


def test_log_time_reads_the_offset(spark):
    texts = ["01/Nov/2016:09:49:34 +0800", "01/Nov/2016:01:49:34 +0000", "01/Xxx/2016:01:49:34 +0000", "-"]
    assert column(spark, texts, "string", timing.log_time) == [1477964974, 1477964974, None, None]


def test_minute_text(spark):
    assert column(spark, ["201611010149", "", "x", None], "string", timing.minute_text_to_sec) == [1477964940, 0, 0, 0]


def test_urls(spark):
    urls = ["http://a.b:80/x/y.JPG?q=1.gif", "rtmp://live/", "no-scheme/x", "http://host"]
    assert column(spark, urls, "string", net.url_host) == ["a.b:80", "live", "", "host"]
    assert column(spark, urls, "string", net.url_path) == ["a.b:80/x/y.JPG", "live/", "", "host"]
    assert column(spark, ["h/x.JPG", "h/x", "a.b/c.unknown", "h/ts"], "string", net.suffix_class) == [
        "jpg", "other", "other", "other",
    ]
    assert column(spark, ["a.b.c", "b", "a."], "string", net.parent_domain) == ["b.c", "b", ""]


def test_directories(spark):
    paths = ["h/a/b/c", "h/a/b", "h/a", "h", "h//x/"]
    assert column(spark, paths, "string", lambda c: net.dir_parts(c)[0]) == ["a", "a", "-", "-", ""]
    assert column(spark, paths, "string", lambda c: net.dir_parts(c)[1]) == ["b", "-", "-", "-", "x"]
    urls = ["/vip/a.7z", "http://h/icons/x", "https://h/icons/x", "/", "http://h/", "http://h"]
    assert column(spark, urls, "string", net.first_dir) == ["/vip", "/icons", "/", None, None, None]


def test_envelopes(spark):
    lines = ["@|@c@|@68@|@P@|@TAG host @|@000@|@rest @|@x", "TAG plain", "@|@a@|@b"]
    assert column(spark, lines, "string", net.strip_envelope) == ["TAG host rest @|@x", "TAG plain", None]
    assert column(spark, ["@|@c06@|@TAG", "TAG", "@|@c06"], "string", net.envelope_platform) == ["c06", "-", "-"]
    assert column(spark, ["@|@Q@|@1.2.3.4", "1.2.3.4"], "string", net.after_last_mark) == ["1.2.3.4"] * 2


def test_machine_ip(spark):
    names = ["cnc-tj-111-161-119-063", "short-name", "cnc-tj-a-b-c-d"]
    assert column(spark, names, "string", net.machine_ip) == [1872852799, None, None]


def test_agents(spark):
    agents = ["Mozilla (Linux; ANDROID 5)", "Windows Chrome", "curl", "MIUI Android"]
    assert column(spark, agents, "string", agent.ua_keyword) == ["android", "chrome", "other", "android"]
    assert column(spark, agents, "string", agent.ua_device) == ["mobile", "pc", "other", "tv"]


def test_hit_types(spark):
    rows = [
        ("TCP_HIT", "-", 0, False, 0), ("MISS", "-", 1, False, 2), ("MISS", "9.9.9.9", 1, False, 2),
        ("MISS", "10.9.9.9", 1, True, 1), ("MISS", "10.9.9.9", 0, True, 3), ("-", "-", 0, False, 4),
    ]
    df = spark.createDataFrame(rows, "hit string, up string, fv int, par boolean, want int")
    got = df.select(speed.hit_type(F.col("hit"), F.col("up"), F.col("fv"), F.col("par")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_flags_without_elapsed_time(spark):
    df = spark.createDataFrame([(0.0, 500), (1000.0, 1024), (1000.0, 10**9), (5.0, 0)], "es double, cs bigint")
    got = df.select(speed.fast_flag(F.col("es"), F.col("cs")), speed.slow_flag(F.col("es"), F.col("cs"))).collect()
    assert [tuple(r) for r in got] == [("1", 0), ("0", 1), ("1", 0), ("1", 1)]
