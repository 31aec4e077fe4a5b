"""Kept dimensions: written once for each version, counted, read without a job; loads by time."""

import os

import pytest

import __spark_entry__ as entry
from accesslens.operators import enrich, filters, rollups
from accesslens.plans import rollup_queries
from accesslens.plans.registry import QUERIES
from accesslens.plans.view import LogView
from accesslens.sources import dims as loads
from accesslens.sources import staging
from accesslens.sources.dims import Dims, TimedDims
from accesslens.sources.dimstore import DimStore, content_version, measured_bytes
from accesslens.streaming import jobs

SF = "/root/testdata/sf0.001"


def jobs_started(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def of_module(module):
    return sorted(n for n, build in QUERIES.items() if build.__module__ == module.__name__)


def test_no_roll_up_starts_a_job_while_it_is_built(spark):
    names = of_module(rollup_queries)
    assert len(names) > 20
    view = LogView(spark, SF)
    for name in ("machine_hit_1m", "client_speed_flag", "status_traffic_1s"):  # all lookups there are
        QUERIES[name](view)
    before = jobs_started(spark)
    for name in names:
        entry.queries()[name](spark, SF)
    for name in ("join_ip_isp", "join_ip_named", "join_client_host_isp", "parse_json", "parse_dispatch", "parse_machine"):
        entry.queries()[name](spark, SF)
    before = jobs_started(spark)
    for name in [*names, "join_ip_isp", "join_ip_named", "join_client_host_isp", "parse_json", "parse_dispatch", "parse_machine"]:
        entry.queries()[name](spark, SF)
    assert jobs_started(spark) == before


@pytest.mark.parametrize("name", ["join_ip_isp", "join_ip_prv", "join_ip_named", "join_client_host_isp", "parse_slow_rate", "client_speed_flag"])
def test_range_lookups_join_on_the_block_alone(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "_block" in line]
    assert joins and not any("<=" in line or ">=" in line for line in joins)


def lines_file(folder, text):
    path = f"{folder}/list.csv"
    with open(path, "w") as f:
        f.write(text)
    return path


def domain_file(folder, user):
    return lines_file(folder, f"img.example.com,x,1,a,b,c,{user}\n")


def test_a_version_is_written_once_and_a_changed_file_again(spark, folder):
    store = DimStore(spark)
    path = domain_file(folder, "7")
    load = lambda: loads.load_domains(loads.read_lines(spark, path))
    first = store.keep("domains", load())
    before = jobs_started(spark)
    assert store.keep("domains", load()) == first and DimStore(spark).keep("domains", load()) == first
    assert jobs_started(spark) == before
    assert (first.rows, first.bytes) == (1, measured_bytes(load()))
    domain_file(folder, "long-user-9")
    os.utime(path, (1, 1))
    second = store.keep("domains", load())
    assert second.path != first.path
    assert [r.userid for r in store.table("domains", load()).collect()] == ["long-user-9"]
    assert spark.read.parquet(first.path).count() == 1  # who still reads the old one can


def test_a_cleared_folder_is_written_again(spark, folder):
    store, path = DimStore(spark), domain_file(folder, "3")
    recipe = lambda: loads.load_domains(loads.read_lines(spark, path))
    for sources in ([path], []):
        first = store.keep("cleared", recipe, sources)
        staging.remove(spark, first.path)
        again = store.keep("cleared", recipe, sources)
        assert again.path != first.path and store.read(again).count() == 1


def test_versions_follow_the_plan_and_the_files(spark, folder):
    path = domain_file(folder, "7")
    read = spark.read.text(path)
    assert content_version(read) == content_version(spark.read.text(path))
    assert content_version(read) != content_version(read.filter("value > 'a'"))
    assert content_version(read.filter("value > 'b'")) != content_version(read.filter("value > 'a'"))
    assert content_version(spark.createDataFrame([(1,)], "n int")) is None


def test_first_values_come_from_the_manifest(spark, folder):
    path = domain_file(folder, "7")
    store = DimStore(spark)
    count = lambda: spark.read.text(path).groupBy().count()
    assert store.first("lines", count()) == {"count": 1}
    before = jobs_started(spark)
    assert store.first("lines", count()) == {"count": 1}
    assert jobs_started(spark) == before


def test_a_manifest_is_replaced_whole(spark, folder):
    path = f"{folder}/mark"
    assert staging.read_text(spark, path) is None
    for text in ("one", "two, longer ü"):
        staging.replace_text(spark, path, text)
        assert staging.read_text(spark, path) == text


def test_large_dimensions_are_left_to_the_planner(spark, folder):
    path = domain_file(folder, "7")
    lines = loads.load_domains(loads.read_lines(spark, path))
    row = spark.createDataFrame([("img.example.com",)], "host string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bound, n in ((1 << 20, 2), (1, 0)):
            joined = enrich.map_domain(row, DimStore(spark, bound).table("domains", lines))
            assert plan_of(joined).count("BroadcastHashJoin") == n
            assert joined.first().userid == "7"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_bytes_of_arrays_count_what_they_hold(spark):
    df = spark.createDataFrame([([1, 2, 3], ["ab", None], [("x" * 100, 1)])], "a array<int>, b array<string>, c array<struct<s:string,n:int>>")
    assert measured_bytes(df) == 16 + (24 + 16) + (2 + 16 + 16 + 16) + (16 + 100 + 16 + 8 + 16)


def test_a_block_with_many_pieces_is_searched_in_the_row(spark):
    ranges = spark.range(20000).selectExpr("id * 3 as lo", "id * 3 + 1 as hi", "cast(id as int) as code")
    ips = spark.range(0, 60010, 7).selectExpr("id as ip").unionByName(spark.createDataFrame([(1 << 31,), (None,)], "ip bigint"))
    table = enrich.code_table(ranges)
    assert table.count() == 1
    for given in (ranges, table):
        got = {r.ip: r.c for r in enrich.with_code(ips, given, "c").collect()}
        assert got == {ip: (str(ip // 3) if ip is not None and ip < 60000 and ip % 3 < 2 else "0") for ip in got}


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now


def test_three_batches_within_the_hour_load_once_and_later_ones_again(spark, folder):
    clock, users, started = Clock(), iter(["old", "new"]), []

    def load(session):
        domain_file(folder, next(users))
        return Dims(domains=loads.load_domains(loads.read_lines(session, f"{folder}/list.csv")))

    timed = TimedDims(load, loads.HOURLY, clock)

    def own(batch, d):
        clock.now += 1500  # batches at 0, 1500, 3000, 4500 seconds
        before = jobs_started(spark)
        rows = filters.known_domain(enrich.map_domain(batch.selectExpr("'img.example.com' as host", "value as ts_sec", "value as cs"), d.domains))
        started.append(jobs_started(spark) - before)
        return rows

    for i in range(4):
        spark.range(i * 10, i * 10 + 10).selectExpr("id as value").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema("value bigint").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    five = {"five": lambda rows, _: rollups.domain_traffic_5m(rows)}
    jobs.rollup_batches(stream, own, five, f"{folder}/out", f"{folder}/cp", timed).awaitTermination()
    assert timed.loads == 2
    assert started[0] > 0 and started[1:3] == [0, 0] and started[3] > 0
    by_batch = {r.batch: r.userid for r in jobs.read_partials(spark, f"{folder}/out", "five").collect()}
    assert by_batch == {0: "old", 1: "old", 2: "old", 3: "new"}


def test_a_failed_load_leaves_the_old_lookups_in_use(spark, folder):
    clock, calls = Clock(), []

    def load(session):
        calls.append(1)
        if len(calls) in (2, 3):
            raise OSError("source away")
        return Dims(domains=session.createDataFrame([("a", False, str(len(calls)))], "name string, wildcard boolean, userid string"))

    timed = TimedDims(load, 10, clock)
    first = timed(spark)
    clock.now = 10
    assert timed(spark) is first and isinstance(timed.failed, OSError)
    clock.now = 11
    assert timed(spark) is first and len(calls) == 3
    assert timed(spark).domains.first().userid == "4" and timed.failed is None
    with pytest.raises(OSError):
        TimedDims(lambda _: (_ for _ in ()).throw(OSError()), 10, clock)(spark)
