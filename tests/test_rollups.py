"""Median rule, pre-aggregated owner lookup, histogram, stored ranges, merge batches."""

import json
import random

from pyspark.sql import functions as F

from accesslens.functions import timing
from accesslens.operators import enrich, filters, median, merge, rollups
from accesslens.sources import scans, sinks, staging


def rule(values):
    return sorted(values, reverse=True)[len(values) // 2]


def test_median_is_the_lower_middle_for_every_size(spark):
    rnd = random.Random(7)
    groups = {n: [rnd.choice([rnd.uniform(1e-6, 1e9), 1.0, 2.5]) for _ in range(n)] for n in range(1, 40)}
    df = spark.createDataFrame([(n, x) for n, xs in groups.items() for x in xs], "n int, x double")
    want = {n: rule(xs) for n, xs in groups.items()}
    for way in (median.discrete_median, median.median_by_rank):
        assert {r.n: r.x for r in way(df, ["n"], "x").collect()} == want


def test_median_of_a_hot_group_with_close_values(spark):
    values = [1000.0 + i * 1e-9 for i in range(20000)] + [5.0] * 7
    df = spark.createDataFrame([("hot", v) for v in values] + [("cold", 3.0)], "k string, x double")
    got = {r.k: r.x for r in median.discrete_median(df, ["k"], "x").collect()}
    assert got == {"hot": rule(values), "cold": 3.0}


def test_sums_come_with_the_median_from_one_shuffle(spark):
    rows = [("a", 10, 2.0), ("a", 30, 3.0), ("a", 50, 5.0), ("b", 7, 1.0)]
    df = spark.createDataFrame(rows, "k string, cs bigint, es double").withColumn("speed", F.col("cs") / F.col("es"))
    out = median.sums_and_median(df, ["k"], "speed", ["cs", "es"])
    got = {r.k: (r.cs, r.es, r["count"], r.speed) for r in out.collect()}
    assert got == {"a": (90, 10.0, 3, 10.0), "b": (7, 1.0, 1, 7.0)}


def hosts(spark):
    rows = [("img.example.com", i * 7, i) for i in range(400)]
    rows += [("x.cdn.example.org", i * 11, 5) for i in range(100)] + [("nobody", 1, 1)]
    return spark.createDataFrame(rows, "host string, ts_sec bigint, cs bigint")


def test_summing_before_the_lookup_changes_nothing(spark, dims):
    label = timing.five_label(F.col("ts_sec"))
    early = rollups.traffic_by_domain(hosts(spark), dims.domains, [], label)
    late = rollups.domain_traffic_5m(filters.known_domain(enrich.map_domain(hosts(spark), dims.domains)))
    columns = ["domain", "userid", "timestamp", "flow_size", "req_count"]
    assert sorted(early.select(*columns).collect()) == sorted(late.select(*columns).collect())


def test_histogram_decodes_text_and_falls_back_to_speed(spark):
    rows = [("d", "u", 10, 1, 0, "0:3,9:4,x:1,12:5,0:2"), ("d", "u", 10, 1, 2048, "0"), ("d", "u", 10, 1, 10240, "0")]
    df = spark.createDataFrame(rows, "domain string, userid string, ts_sec bigint, cs bigint, speed bigint, speed_interval string")
    r = rollups.speed_histogram(df.withColumn("req_num", F.lit(1))).collect()[0]
    assert [r[f"speed{i}"] for i in range(10)] == [2, 0, 1, 0, 0, 0, 0, 0, 0, 5]


def test_stored_range_is_half_open_and_prunes_hours(spark):
    df = spark.createDataFrame([(t, 1) for t in range(0, 14400, 300)], "timestamp bigint, n int")
    path = staging.write_once(scans.with_hour(df), "range", ("hour",))
    read = scans.rollup_range(spark, path, 3600, 7200)
    assert sorted(r.timestamp for r in read.collect()) == list(range(3600, 7200, 300))
    assert scans.rollup_range(spark, path, 3600, 7200, inclusive=True).count() == read.count() + 1
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cast(hour" in plan
    assert scans.range_hours(3600, 7200) == ["1970010101", "1970010102"]
    assert scans.range_hours(3600, 14400 - 1) == ["1970010101", "1970010102", "1970010103", "1970010104"]


def test_recomputed_speed_uses_the_sums(spark):
    row = ("d", "1", "2", "3", "4", 0, "u", 900, 2048000, 2, 0, 100.0)
    names = "domain string, isp string, city string, prv string, country string, hit_type int, userid string," \
        "speed_size int, flow_size bigint, req_count bigint, zeroSpeedReqNum bigint, es double"
    r = rollups.hit_traffic_rollup(spark.createDataFrame([row, row], names), 3600).collect()[0]
    assert (r.speed_size, r.speed_size_recomputed, r.timestamp) == (1800, 0, 3600)


def test_payload_batches_hold_everything_once(spark):
    rows = [(f"d{i}.com", str(i % 2)) for i in range(1000)]
    out = merge.payloads(spark.createDataFrame(rows, "domain string, dir_flag string"), "202401010000", fcname="x").collect()
    bodies = [json.loads(r.payload) for r in sorted(out, key=lambda r: r.batch)]
    assert [len(b["domain"]) for b in bodies] == [300, 300, 300, 100]
    assert sorted(e for b in bodies for e in b["domain"]) == sorted(f"{d} {f}" for d, f in rows)
    assert bodies[0]["time"] == "202401010000" and bodies[0]["fcname"] == "x"


def test_merge_config_prefers_the_parent(spark):
    config = spark.createDataFrame([("b.com", "1", "0"), ("a.b.com", "0", "5"), ("solo", "0", "2")], "domain string, merge_flag string, dir_flag string")
    domains = spark.createDataFrame([("a.b.com",), ("solo",), ("none.org",)], "domain string")
    saved = spark.createDataFrame([("solo",)], "domain string")
    got = sorted((r.action, r.domain, r.dir_flag) for r in merge.schedule_hourly(domains, config, saved).collect())
    assert got == [("post", "a.b.com", "0")]
    assert [tuple(r) for r in merge.schedule_daily(saved, config).collect()] == [("solo", "1")]


def test_output_sizes_add_all_files(spark, folder):
    df = spark.createDataFrame([("a.com", f"line {i}") for i in range(100)] + [("b.com", "x")], "domain string, value string")
    sinks.write_by_domain(df, f"{folder}/out")
    sinks.write_by_domain(df, f"{folder}/out")
    files = sinks.domain_files(spark, f"{folder}/out")
    want = {}
    for f in files.collect():
        want[f.domain] = want.get(f.domain, 0) + f.size
    got = {r.domain: r.status for r in merge.output_sizes(files).collect()}
    assert got == {d: f"{d} 0 {n}" for d, n in want.items()} and set(got) == {"a.com", "b.com"}


def test_kafka_options_and_records(spark):
    options = scans.kafka_options("b:9092", "t1,t2", 80000)
    assert options["subscribe"] == "t1,t2" and options["maxOffsetsPerTrigger"] == "80000"
    rows = sinks.kafka_records(spark.createDataFrame([("x",)] * 50, "value string")).collect()
    assert len({r.key for r in rows}) > 1 and all(str(int(r.key)) == r.key for r in rows)


def test_new_partitions_become_visible_one_by_one(spark, folder):
    def put(minute):
        df = spark.createDataFrame([(minute,)], "ts_sec bigint")
        sinks.write_rows(df, f"{folder}/t", F.col("ts_sec"))

    put(0)
    table = "rows_one_by_one"
    sinks.register_table(spark, table, f"{folder}/t", "ts_sec bigint, month_ string, day_ string, hour_ string, minute_ string", sinks.MINUTE_PARTITIONS)
    put(3660)
    assert spark.table(table).count() == 1
    for _ in range(2):
        sinks.add_partition(spark, table, month_="197001", day_="01", hour_="01", minute_="01")
    assert sorted(r.ts_sec for r in spark.table(table).collect()) == [0, 3660]


def test_a_row_of_unknown_arrival_is_on_time(spark):
    df = spark.createDataFrame([(1, None), (1, 602), (1, 601)], "ts_sec bigint, arrival_sec bigint")
    assert filters.on_time(df).count() == 2 and filters.late(df).count() == 1
