"""The same operators over streams: totals, restarts, late rows, refreshed dimensions."""

import os
import re

import pytest
from pyspark.sql import functions as F

from accesslens.functions import timing
from accesslens.operators import enrich, filters, parse, rollups
from accesslens.schemas import struct
from accesslens.sources import scans, sinks
from accesslens.streaming import jobs

ROWS = struct("domain string, userid string, ts_sec bigint, arrival_sec bigint, cs bigint")
KEYS = ["domain", "userid"]


def put(spark, path, start, n=200):
    rows = [(f"d{i % 3}", "u", start + i * 5, start + i * 5 + (900 if i % 4 == 0 else 10), i) for i in range(n)]
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(path)


def five(rows, _=None):
    return rollups.domain_traffic_5m(rows)


def run(spark, folder, outputs):
    query = jobs.rollup_batches(stream(spark, f"{folder}/in"), lambda b, _: b, outputs, f"{folder}/out", f"{folder}/cp")
    query.awaitTermination()


def table(df):
    columns = ["domain", "userid", "timestamp", "flow_size", "req_count"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


def merged(spark, folder, name):
    return jobs.merged(jobs.read_partials(spark, f"{folder}/out", name), [*KEYS, "timestamp"], ["flow_size", "req_count"])


def test_partials_merge_to_the_batch_result_and_restart_loses_nothing(spark, folder):
    for start in (0, 500, 1000):
        put(spark, f"{folder}/in", start)
    run(spark, folder, {"five": five})
    put(spark, f"{folder}/in", 1500)
    run(spark, folder, {"five": five})
    run(spark, folder, {"five": five})
    assert {r.batch for r in jobs.read_partials(spark, f"{folder}/out", "five").select("batch").collect()} == {0, 1, 2, 3}
    some = jobs.read_partials(spark, f"{folder}/out", "five", 600, 1500)
    assert {r.timestamp for r in some.collect()} == {600, 900, 1200}
    assert re.search(r"PartitionFilters: \[[^]]*hour", some._jdf.queryExecution().executedPlan().toString())
    assert table(merged(spark, folder, "five")) == table(five(spark.read.parquet(f"{folder}/in")))


def test_a_batch_run_twice_leaves_no_repeats(spark, folder):
    put(spark, f"{folder}/in", 0)
    for _ in range(2):  # a new checkpoint repeats batch 0 from the start
        query = jobs.rollup_batches(
            stream(spark, f"{folder}/in"), lambda b, _: b, {"five": five}, f"{folder}/out", f"{folder}/cp{_}"
        )
        query.awaitTermination()
    assert table(merged(spark, folder, "five")) == table(five(spark.read.parquet(f"{folder}/in")))


def test_late_rows_go_to_their_own_output(spark, folder):
    put(spark, f"{folder}/in", 0)
    put(spark, f"{folder}/in", 100)
    outputs = {
        "on_time": lambda r, _: rollups.traffic(filters.on_time(r), KEYS, timing.minute_label(F.col("ts_sec"))),
        "late": lambda r, _: rollups.traffic(filters.late(r), KEYS, timing.hour_label(F.col("ts_sec"))),
    }
    run(spark, folder, outputs)
    whole = spark.read.parquet(f"{folder}/in")
    for name, roll in outputs.items():
        assert table(merged(spark, folder, name)) == table(roll(whole, None))
    assert sum(r[4] for n in outputs for r in table(merged(spark, folder, n))) == 400


def test_dimensions_are_read_again_for_every_batch(spark, folder, dims):
    seen = []

    def load(session):
        seen.append(1)
        user = "old" if len(seen) == 1 else "new"
        return type(dims)(domains=session.createDataFrame([("d0", False, user)], "name string, wildcard boolean, userid string"))

    put(spark, f"{folder}/in", 0, 30)
    put(spark, f"{folder}/in", 0, 30)

    def own(batch, d):
        hosts = batch.withColumnRenamed("domain", "host").drop("userid")
        return filters.known_domain(enrich.map_domain(hosts, d.domains))

    query = jobs.rollup_batches(stream(spark, f"{folder}/in"), own, {"five": five}, f"{folder}/out", f"{folder}/cp", load)
    query.awaitTermination()
    users = {r.userid for r in jobs.read_partials(spark, f"{folder}/out", "five").collect()}
    assert users == {"old", "new"}


def final(spark, folder):
    jobs.final_batches(stream(spark, f"{folder}/in"), lambda b, _: b, KEYS, f"{folder}/out", f"{folder}/cp").awaitTermination()


def test_final_rows_are_written_once_and_late_rows_kept(spark, folder):
    put(spark, f"{folder}/in", 0)
    put(spark, f"{folder}/in", 600)
    final(spark, folder)
    put(spark, f"{folder}/in", 100000, 1)
    final(spark, folder)
    put(spark, f"{folder}/in", 0, 7)  # windows long closed
    final(spark, folder)
    whole = table(five(spark.read.parquet(f"{folder}/in")))
    closed = table(jobs.read_final(spark, f"{folder}/out", KEYS, open_too=False))
    assert len({r[:3] for r in closed}) == len(closed) and {r[2] for r in whole if r[2] < 50000} == {r[2] for r in closed}
    late = jobs.read_late(spark, f"{folder}/out", KEYS)
    assert sum(r.req_count for r in late.collect()) == 7
    both = jobs.read_final(spark, f"{folder}/out", KEYS).unionByName(late)
    assert table(jobs.merged(both, [*KEYS, "timestamp"], jobs.SUMS)) == whole


def test_no_row_of_six_files_is_lost(spark, folder):
    import time

    sizes = [(0, 200), (1000, 200), (5000, 204), (100, 100), (2000, 100), (200, 100)]  # the last three are late
    for start, n in sizes:
        put(spark, f"{folder}/in", start, n)
        time.sleep(1.1)  # files are taken in the order of their times
    final(spark, folder)
    late = sum(r.req_count for r in jobs.read_late(spark, f"{folder}/out", KEYS).collect())
    kept = sum(r.req_count for r in jobs.read_final(spark, f"{folder}/out", KEYS).collect())
    assert late > 100 and late + kept == 904


def test_streams_read_a_folder_of_files(spark, folder):
    import shutil

    from accesslens.plans import io_queries, registry
    from accesslens.plans.view import LogView

    small = "/root/testdata/sf0.001"
    for name in os.listdir(small):
        if name != "events.parquet":
            shutil.copy(f"{small}/{name}", folder)
    spark.read.parquet(f"{small}/events.parquet").repartition(3).write.parquet(f"{folder}/events.parquet")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name in ("stream_domain_traffic_5m", "stream_final_traffic", "stream_late_split"):
        got = getattr(io_queries, name)(LogView(spark, folder), files=1)
        want = registry.QUERIES["domain_traffic_5m" if "late" not in name else name](LogView(spark, small))
        columns = sorted(want.columns)
        assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    counts = io_queries.batch_counts(LogView(spark, folder), files=1).collect()
    assert len(counts) == 3 and sum(r.records for r in counts) == spark.read.parquet(f"{small}/events.parquet").count()
    os.makedirs(f"{folder}/none/events.parquet")
    with pytest.raises(FileNotFoundError):
        io_queries.event_stream(LogView(spark, f"{folder}/none"))


def test_a_path_with_marks_of_a_pattern_is_a_path(spark, folder):
    from accesslens.plans import io_queries
    from accesslens.plans.view import LogView

    odd = f"{folder}/a{{b}}[c]"
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    os.makedirs(odd)
    events.write.parquet(f"{folder}/plain")
    os.rename(f"{folder}/plain", f"{odd}/events.parquet")
    view = LogView(spark, odd)
    view.table = lambda _: events
    path = f"{folder}/got"
    write = lambda b, i: b.write.mode("append").parquet(path)
    jobs.start(io_queries.event_stream(view), write, f"{folder}/cp").awaitTermination()
    assert spark.read.parquet(path).count() == events.count()


LINE = (
    'LOG_edge host-1 1.2.3.4 5 - [01/Nov/2016:09:49:34 +0800] "GET http://img.example.com/a.gif HTTP/1.1" 200 {} "-" '
    '"Android" HIT 0 0 0 0 0 0 0 0 0 0 - - - - 5.6.7.8'
)


@pytest.fixture()
def text(folder):
    os.makedirs(f"{folder}/lines")
    for part in range(3):
        with open(f"{folder}/lines/{part}.log", "w") as f:
            f.writelines(LINE.format(part * 10 + i) + "\n" for i in range(10))
            f.write("damaged line\n")
    return f"{folder}/lines"


def test_ingest_splits_rows_and_rejects(spark, folder, dims, text):
    spark.sql("DROP TABLE IF EXISTS ingested_rows")
    parts = "month_ string, day_ string, hour_ string, minute_ string, batch string"
    os.makedirs(f"{folder}/rows")
    sinks.register_table(spark, "ingested_rows", f"{folder}/rows", f"cs bigint, {parts}", (*sinks.MINUTE_PARTITIONS, "batch"))
    for _ in range(2):
        jobs.ingest(
            scans.file_lines(spark, text, max_files=1), parse.dispatch_access, f"{folder}/rows", f"{folder}/cp",
            F.unix_timestamp("arrival"), lambda _: dims, rejects=folder, table="ingested_rows",
        ).awaitTermination()
    rows = spark.read.parquet(f"{folder}/rows")
    assert sorted(r.cs for r in rows.collect()) == list(range(30))
    assert {"month_", "day_", "hour_", "minute_", "batch"} <= set(rows.columns)
    assert spark.table("ingested_rows").count() == 30  # partitions were added batch by batch
    assert [r.value for r in spark.read.text(f"{folder}/rejects").select("value").collect()] == ["damaged line"] * 3


def test_user_sql_over_a_stream(spark, folder, dims, text):
    jobs.sql_batches(
        scans.file_lines(spark, text), lambda b, d: parse.accepted(parse.edge(b, d)),
        "SELECT domain, ua, Fv, sum(cs) AS bytes FROM loginfo GROUP BY domain, ua, Fv", folder, f"{folder}/cp", lambda _: dims,
    ).awaitTermination()
    found = [r.value for r in spark.read.text(f"{folder}/documents").collect()]
    assert found == ['{"domain":"img.example.com","ua":"android","Fv":"-","bytes":435}']


def test_counts_per_batch_skip_empty_ones(spark, folder, text):
    stream_ = scans.file_lines(spark, text, max_files=1, predicate=lambda df: df["value"].contains(" 200 2"))
    write = lambda b, i: b.write.mode("overwrite").parquet(jobs.batch_folder(folder, "data", i))
    jobs.count_batches(stream_, write, folder, f"{folder}/cp").awaitTermination()
    counts = [r.records for r in spark.read.parquet(f"{folder}/counts").collect()]
    assert sorted(counts) == [1, 10] and spark.read.parquet(f"{folder}/data").count() == 11
