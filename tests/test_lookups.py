"""Range edges, wildcard domains, duplicate dimension lines."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from accesslens.operators import enrich, filters
from accesslens.sources import dims as loads


def pairs(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def lines(spark, *texts):
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, pos int")


def test_range_edges(spark):
    ranges = spark.createDataFrame([(100, 70000, 1), (70001, 70001, 2), (200000, 5000000, 3)], "lo bigint, hi bigint, code int")
    ips = {99: "0", 100: "1", 65536: "1", 70000: "1", 70001: "2", 70002: "0", 199999: "0", 200000: "3", 5000000: "3", 5000001: "0", 10**10: "0"}
    df = spark.createDataFrame([(i,) for i in ips], "ip bigint")
    assert pairs(enrich.with_code(df, ranges, "code"), "ip", "code") == sorted(ips.items())


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_lookup_is_the_same_broadcast_or_shuffled(spark, dims, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = spark.createDataFrame([(16777216 + i * 1000003,) for i in range(500)] + [(None,)], "ip bigint")
        got = enrich.with_code(df, dims.isp, "isp").collect()
        assert len(got) == 501
        for r in got:
            inside = r.ip is not None and 16777216 <= r.ip <= 33554431
            assert r.isp == ("11" if inside else "0")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_overlaps_are_refused(spark):
    good = spark.createDataFrame([(1, 10, 1), (11, 200000, 2)], "lo bigint, hi bigint, code int")
    bad = spark.createDataFrame([(1, 100000, 1), (100000, 200000, 2)], "lo bigint, hi bigint, code int")
    assert loads.require_disjoint(good) is good
    with pytest.raises(ValueError):
        loads.require_disjoint(bad)


def test_overlaps_fail_every_lookup_and_never_multiply_rows(spark, dims):
    bad = spark.createDataFrame([(1, 100000, 1), (100000, 200000, 2)], "lo bigint, hi bigint, code int")
    row = spark.createDataFrame([("img.example.com", 100000)], "host string, ip bigint")
    for d in (replace(dims, isp=bad), replace(dims, prv=bad), replace(dims, isp=bad).measured):
        with pytest.raises(Exception, match="ranges of one table overlap"):
            enrich.locate(row, d() if callable(d) else d).collect()
    with pytest.raises(Exception, match="ranges of one table overlap"):
        enrich.with_code(row, bad, "code").collect()


def test_bad_range_lines_are_dropped(spark):
    text = lines(spark, "0 9000000000000000000 2", "50 40 3", "-5 10 4", "100 200 5", "100 150 6", "1 2", "x 2 3", "300 4294967296 7")
    assert pairs(loads.load_ranges(text), "lo", "hi", "code") == [(100, 150, 6)]
    wild = spark.createDataFrame([(0, 9 * 10**18, 1), (9, 3, 2), (5, 6, 3)], "lo bigint, hi bigint, code int")
    ips = spark.createDataFrame([(5,), (7,)], "ip bigint")
    assert pairs(enrich.with_code(ips, wild, "code"), "ip", "code") == [(5, "3"), (7, "0")]


def test_places_are_the_two_lookups_and_the_area(spark):
    rnd = random.Random(5)

    def table():
        cuts = sorted(rnd.sample(range(0, 1 << 32, 1 << 12), 60))
        return [(a, b - rnd.choice([1, 1, 5000]), i) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if rnd.random() < 0.7 and b - a > 6000]

    isp, prv = table(), table()
    names = "lo bigint, hi bigint, code int"
    area = spark.createDataFrame([(str(i), f"p{i}", f"c{i}") for i in range(0, 60, 2)], "area_id string, area_pid string, area_cid string")
    ips = {0, (1 << 32) - 1, 1 << 32, -1, None} | {x + d for t in (isp, prv) for a, b, _ in t for x in (a, b) for d in (-1, 0, 1)}

    def find(rows, ip):
        return next((str(c) for a, b, c in rows if ip is not None and a <= ip <= b), "0")

    df = spark.createDataFrame([(x,) for x in ips], "ip bigint")
    got = enrich.with_place(df, enrich.place_table(spark.createDataFrame(isp, names), spark.createDataFrame(prv, names), area), enrich.PLACE)
    rows = got.collect()
    assert len(rows) == len(ips)
    for r in rows:
        p = find(prv, r.ip)
        inside = r.ip is not None and 0 <= r.ip < 1 << 32
        want = (f"p{p}", f"c{p}") if inside and int(p) % 2 == 0 else ("0", "0")
        assert (r.isp, r.prv, r.area_pid, r.area_cid) == (find(isp, r.ip), p, *want)


def test_domains(spark, dims):
    df = spark.createDataFrame([("img.example.com",), ("a.cdn.example.org",), ("cdn.example.org",), ("x.y",), (None,)], "host string")
    got = {r.host: (r.domain, r.userid) for r in enrich.map_domain(df, dims.domains).collect()}
    assert got == {
        "img.example.com": ("img.example.com", "7"),
        "a.cdn.example.org": ("ext.cdn.example.org", "9"),
        "cdn.example.org": (None, None),
        "x.y": (None, None),
        None: (None, None),
    }


def test_owner_of_canonical_domain(spark, dims):
    df = spark.createDataFrame([("img.example.com",), ("ext.cdn.example.org",), ("nobody",)], "domain string")
    got = {r.domain: r.userid for r in enrich.domain_owner(df, dims.domains).collect()}
    assert got == {"img.example.com": "7", "ext.cdn.example.org": "9", "nobody": ""}


def test_a_repeated_host_keeps_its_last_line(spark):
    csv = lines(spark, "h1,OLD,1,P,2,c,1.1.1.1,5,1", "h2,X,bad,P,2,c,1.1.1.1,5", "h1,NEW,1,P,2,c,1.1.1.1,6,1", "short")
    got = pairs(loads.load_machines(csv), "host", "machine_isp", "pop_id")
    assert got == [("-", "-", 0), ("h1", "NEW", 6)]


def test_file_order_decides_which_line_is_last(spark, folder):
    with open(f"{folder}/list", "w") as f:
        f.write("a.com,b.com\nc.com,d.com\n")
    got = loads.load_monitor_domains(loads.read_lines(spark, f"{folder}/list"))
    assert pairs(got, "domain") == [("c.com",), ("d.com",)]


def test_unknown_machine_gets_defaults(spark, dims):
    df = spark.createDataFrame([("host-1",), ("other",)], "machine string")
    assert pairs(enrich.with_machine(df, dims.machines), "machine", "machine_isp", "pop_id") == [
        ("host-1", "CNC", 203), ("other", "-", 0),
    ]


def test_client_and_host_isp(spark, dims):
    df = spark.createDataFrame([(16777300, 16777400), (16777300, 3000000001), (5, 6)], "ip bigint, host_ip bigint")
    got = pairs(enrich.client_host_isp(df, dims.named), "ip", "host_ip", "isp", "province")
    assert got == [(5, 6, "NULL", "NULL"), (16777300, 16777400, "ONE", "P1"), (16777300, 3000000001, "other", "other")]


def test_line_filters(spark):
    df = spark.createDataFrame([("t m a.com#_#1.2.3.4#_#-",), ("t m b.com#_#x",), ("no separator",)], "value string")
    listed = spark.createDataFrame([("a.com",)], "domain string")
    assert filters.lines_of_hash_domains(df, listed).count() == 1
    urls = spark.createDataFrame([("GET http://a.com/x",), ("GET http://a.com",), ("GET http://b.com/",)], "value string")
    assert filters.lines_of_url_domains(urls, listed).count() == 1
    assert filters.lines_of_fixed_domains(urls, ["b.com"]).count() == 1
    assert filters.keep(urls, lambda d: F.length(d["value"]) == 16).count() == 1


def test_dimensions_are_broadcast_only_within_the_measured_bound(spark, dims):
    df = spark.createDataFrame([("img.example.com", 16777300)], "host string, ip bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bound, broadcasts in ((loads.BROADCAST_BYTES, 3), (1, 0)):
            d = dims.measured(bound)
            out = enrich.locate(enrich.map_domain(df, d.domains), d)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert plan.count("BroadcastHashJoin") == broadcasts
            assert [(r.domain, r.isp) for r in out.collect()] == [("img.example.com", "11")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_bytes_are_those_of_the_rows(spark):
    small = spark.createDataFrame([("a", 1)], "s string, n bigint")
    large = spark.createDataFrame([("a" * 5000, 1)] * 3, "s string, n bigint")
    assert loads.measured_bytes(small) < 100 < 15000 < loads.measured_bytes(large) < 16000
