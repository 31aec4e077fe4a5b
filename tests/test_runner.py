"""Stops, interval triggers, paced batches, batches seen whole, and final windows that do not grow."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_streams import KEYS, ROWS, five, merged, put, stream, table

from accesslens.operators import rollups
from accesslens.sources import staging
from accesslens.streaming import jobs, runner


def start(spark, folder, control, every=None, each=None, files=1):
    rows = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", files).parquet(f"{folder}/in")
    return jobs.rollup_batches(rows, each or (lambda b, _: b), {"five": five}, f"{folder}/out", f"{folder}/cp", every=every, control=control)


def whole(spark, folder):
    return table(five(spark.read.parquet(f"{folder}/in")))


def test_a_stop_in_the_middle_loses_and_repeats_nothing(spark, folder):
    for i in range(5):
        put(spark, f"{folder}/in", i * 100, 40)
    control = runner.Control(spark, f"{folder}/stop")

    def each(batch, _):
        if len(control.done) == 1:  # asked for from outside, while the second batch runs
            control.ask("maintenance")
        return batch

    runner.run_until_asked(start(spark, folder, control, each=each), control)
    assert [b.batch_id for b in control.done] == [0, 1] and jobs.committed(spark, f"{folder}/out") == 1
    assert 0 < len(table(merged(spark, folder, "five"))) < len(whole(spark, folder))
    control.clear()
    again = runner.Control(spark, f"{folder}/stop")
    runner.run_until_asked(start(spark, folder, again), again)
    assert [b.batch_id for b in again.done] == [2, 3, 4]
    assert table(merged(spark, folder, "five")) == whole(spark, folder)


def test_an_idle_interval_trigger_stops_when_asked_and_takes_what_comes(spark, folder):
    put(spark, f"{folder}/in", 0, 40)
    control = runner.Control(spark, f"{folder}/stop")
    query = start(spark, folder, control, every="200 milliseconds")
    while not control.done:
        assert not query.awaitTermination(0.2)
    put(spark, f"{folder}/in", 1000, 40)
    runner.run_through(query, control, quiet_sec=3)
    assert not query.isActive and len(control.done) == 2
    assert table(merged(spark, folder, "five")) == whole(spark, folder)


def test_other_failures_are_raised(spark, folder):
    put(spark, f"{folder}/in", 0, 10)
    control = runner.Control(spark, f"{folder}/stop")

    def broken(batch, _):
        raise ValueError("broken step")

    with pytest.raises(StreamingQueryException, match="broken step"):
        runner.run_until_asked(start(spark, folder, control, each=broken), control)


def test_limits_follow_the_time():
    assert runner.next_limit(10, 8, 8) == 10 and runner.next_limit(10, 11, 8) == 10
    assert runner.next_limit(10, 80, 8) == 1 and runner.next_limit(10, 20, 8) == 4
    assert runner.next_limit(10, 0.001, 8) == 20 and runner.next_limit(10, 0.001, 8, most=12) == 12
    assert runner.next_limit(1, 100, 8) == 1


def test_batches_grow_until_they_take_their_time(spark, folder):
    for i in range(9):
        put(spark, f"{folder}/in", i * 100, 20)
    control = runner.Control(spark, f"{folder}/stop")
    limits = runner.paced(lambda n, c: start(spark, folder, c, files=n), control, 1, 1e6)
    assert limits == [1, 2, 4, 8, 16] and [b.batch_id for b in control.done] == [0, 1, 2, 3, 4]  # of 1, 1, 2, 4 and 1 files
    assert table(merged(spark, folder, "five")) == whole(spark, folder)


def test_a_batch_cut_off_between_two_outputs_is_seen_in_neither(spark, folder):
    put(spark, f"{folder}/in", 0, 40)
    put(spark, f"{folder}/in", 1000, 40)
    broken = [True]

    def second(rows, _):
        if broken[0] and rows.agg(F.min("ts_sec")).first()[0] >= 1000:
            raise RuntimeError("cut off")
        return rollups.domain_traffic_5m(rows)

    def run():
        outputs = {"first": five, "second": second}
        jobs.rollup_batches(stream(spark, f"{folder}/in"), lambda b, _: b, outputs, f"{folder}/out", f"{folder}/cp").awaitTermination()

    with pytest.raises(StreamingQueryException, match="cut off"):
        run()
    written = spark.read.parquet(f"{folder}/out/first")
    assert {r.batch for r in written.select("batch").collect()} == {0, 1}
    for name in ("first", "second"):
        assert {r.batch for r in jobs.read_partials(spark, f"{folder}/out", name).collect()} == {0}
    broken[0] = False
    run()
    for name in ("first", "second"):
        assert table(merged(spark, folder, name)) == whole(spark, folder)


def test_what_a_batch_lists_does_not_grow_over_200_batches(spark, folder):
    path, rows = f"{folder}/out", pa.table({"domain": ["d"], "userid": ["u"], "timestamp": [0], "flow_size": [1], "req_count": [1]})
    zone = spark.conf.get("spark.sql.session.timeZone")
    assert zone == "UTC"
    listed = []
    for batch in range(200):
        newest = batch * 1200
        at = f"{path}/{jobs.PARTS}/{jobs._hour(spark, newest)}/batch={batch}"
        os.makedirs(at)
        pq.write_table(rows.set_column(2, "timestamp", pa.array([newest // 300 * 300 + 300])), f"{at}/part-0.parquet")
        closed = jobs._mark(spark, path, batch)
        now = newest - 600
        parts = jobs._parts(spark, path, batch + 1, closed, now)
        listed.append((len(staging.folders(spark, f"{path}/{jobs.PARTS}")), len(parts.inputFiles()) if parts else 0, len(os.listdir(path))))
        staging.replace_text(spark, f"{path}/{jobs.MARK}", jobs.json.dumps({"batch": batch, "closed": now, "before": closed}))
        assert jobs._mark(spark, path, batch) == closed and jobs._mark(spark, path, batch + 1) == now
        if closed is not None:
            jobs._retire(spark, path, closed - jobs.KEEP_SEC)
    late = listed[20:]
    assert {x[2] for x in late} <= {2, 3}  # parts, mark, and its checksum on a local disk
    assert max(x[0] for x in late) <= 4 and max(x[1] for x in late) <= 7
    assert max(x[:2] for x in late[-20:]) <= max(x[:2] for x in late[:20])


def test_retired_parts_are_in_the_final_output(spark, folder):
    for i in range(6):
        put(spark, f"{folder}/in", i * 7200, 100)
    query = jobs.final_batches(stream(spark, f"{folder}/in"), lambda b, _: b, KEYS, f"{folder}/out", f"{folder}/cp", keep_sec=0)
    query.awaitTermination()
    assert len(staging.folders(spark, f"{folder}/out/{jobs.PARTS}")) <= 3
    assert table(jobs.read_final(spark, f"{folder}/out", KEYS)) == whole(spark, folder)


def test_a_clock_far_ahead_closes_nothing(spark, folder):
    put(spark, f"{folder}/in", 0, 50)
    rows = [("d0", "u", 10**9, 260, 1)]  # arrives at 260 and says it is years later
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    put(spark, f"{folder}/in", 100, 50)
    jobs.final_batches(stream(spark, f"{folder}/in"), lambda b, _: b, KEYS, f"{folder}/out", f"{folder}/cp").awaitTermination()
    assert jobs.read_late(spark, f"{folder}/out", KEYS).count() == 0
    assert table(jobs.read_final(spark, f"{folder}/out", KEYS)) == whole(spark, folder)


def test_user_sql_leaves_the_session_as_it_was(spark):
    spark.range(3).createOrReplaceTempView("loginfo")
    got = jobs.run_sql(spark.range(5), "SELECT count(*) AS n FROM loginfo")
    assert got.first().n == 5 and spark.table("loginfo").count() == 3
    spark.catalog.dropTempView("loginfo")
    assert jobs.run_sql(spark.range(5), "SELECT count(*) AS n FROM loginfo").first().n == 5
    assert "loginfo" not in {t.name for t in spark.catalog.listTables()}


def test_a_listener_notes_every_batch_of_any_job(spark, folder):
    for i, n in enumerate((30, 20, 50)):
        put(spark, f"{folder}/in", i * 1000, n)
    assert runner.read_log(spark, f"{folder}/log").collect() == []
    with runner.batch_log(spark, f"{folder}/log"):
        outputs = {"one": five, "two": five}
        rows = stream(spark, f"{folder}/in")
        jobs.rollup_batches(rows, lambda b, _: b, outputs, f"{folder}/out", f"{folder}/cp").awaitTermination()
    with runner.batch_log(spark, f"{folder}/final-log"):
        jobs.final_batches(stream(spark, f"{folder}/in"), lambda b, _: b, KEYS, f"{folder}/f", f"{folder}/f/cp").awaitTermination()
    for log in ("log", "final-log"):
        notes = runner.read_log(spark, f"{folder}/{log}").orderBy("batch_id").collect()
        assert [(r.batch_id, r.records) for r in notes] == [(0, 30), (1, 20), (2, 50)]
        assert all(r.seconds > 0 for r in notes)
