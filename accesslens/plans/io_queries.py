"""Registered stored roll-ups, sinks, merge scheduling, ad-hoc SQL and streams.

These write to fresh folders under the shared checkpoint folder and read back.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from accesslens.constants import STORED_MINUTE_REACH
from accesslens.functions import agent, net, timing
from accesslens.operators import enrich, filters, merge, parse, rollups
from accesslens.plans.oracle_view import five, host, minute, parent, part, speed, sql, stamp, ua_keyword
from accesslens.plans.parse_queries import DAMAGED, EDGE_SQL, GOOD
from accesslens.plans.registry import ORACLES, register
from accesslens.plans.rollup_queries import FLOW_SQL, LATE, ON_TIME, hit_sql, machine_speed_sql
from accesslens.schemas import ACCESS_LOG, EVENTS
from accesslens.sources import scans, sinks, staging
from accesslens.sources.dims import Dims
from accesslens.streaming import jobs, runner

START, STOP = 1704069000, 1704072600
HOUR_LABEL = START // 3600 * 3600
IN_RANGE = f"timestamp >= {START} AND timestamp < {STOP}"


def stored(v, df: DataFrame, name: str) -> DataFrame:
    """Write a roll-up by hour and read the range back."""
    path = staging.write_once(scans.with_hour(df), name, ("hour",))
    return scans.rollup_range(v.spark, path, START, STOP)


# ---------------------------------------------------------- stored roll-ups
@register("scan_rollup_range", f"SELECT * FROM ({hit_sql(ON_TIME, minute('ts_sec'))}) WHERE {IN_RANGE}")
def scan_rollup_range(v):
    return stored(v, rollups.hit_traffic_1m(v.hit_rows(), v.dims.area), "hits").drop("hour")


@register(
    "hit_traffic_rollup",
    f"""SELECT domain, isp, city, prv, country, hit_type, userid, {HOUR_LABEL}::bigint AS timestamp, speed_size, flow_size,
    req_count, "zeroSpeedReqNum", {speed('es', 'flow_size')} AS speed_size_recomputed FROM (
      SELECT domain, isp, city, prv, country, hit_type, userid, sum(speed_size)::bigint AS speed_size,
      sum(flow_size)::bigint AS flow_size, sum(req_count)::bigint AS req_count,
      sum("zeroSpeedReqNum")::bigint AS "zeroSpeedReqNum", sum(es) AS es
      FROM ({hit_sql(ON_TIME, minute('ts_sec'))}) WHERE {IN_RANGE} GROUP BY ALL)""",
)
def hit_traffic_rollup(v):
    read = stored(v, rollups.hit_traffic_1m(v.hit_rows(), v.dims.area), "hits")
    return rollups.hit_traffic_rollup(read, timing.rollup_label("hour", START, STOP))


@register(
    "status_rollup",
    sql(
        "mach",
        f"""SELECT domain, isp, prv AS city, area_pid AS prv, area_cid AS country, status AS status_code, userid,
        {FLOW_SQL}, {STOP // 300 * 300}::bigint AS timestamp FROM mach
        WHERE {IN_RANGE.replace('timestamp', 'ts_sec')} GROUP BY ALL""",
    ),
)
def status_rollup(v):
    read = stored(v, rollups.status_traffic_1s(v.located(v.owned()), v.dims.area), "status")
    return rollups.status_rollup(read, timing.rollup_label("five", START, STOP))


@register(
    "ua_rollup",
    sql(
        "mach",
        f"""SELECT domain, userid, ua, {FLOW_SQL}, 0::bigint AS timestamp FROM mach
        WHERE {IN_RANGE.replace('timestamp', 'ts_sec')} GROUP BY ALL""",
    ),
)
def ua_rollup(v):
    rows = v.owned().withColumn("ua", agent.ua_keyword(F.col("agent")))
    return rollups.ua_rollup(stored(v, rollups.ua_traffic(rows), "ua"), timing.rollup_label("day", START, STOP))


@register(
    "machine_speed_rollup",
    sql(
        "mach",
        f"""SELECT "machineName", domain, "hitType", "machineIsp", "machinePrv", sum("reqCount")::bigint AS "reqCount",
        sum(speed)::bigint AS speed, max(platform) AS platform, max("popId") AS "popId", {HOUR_LABEL}::bigint AS timestamp
        FROM ({machine_speed_sql(ON_TIME)}) WHERE {IN_RANGE} GROUP BY ALL""",
    ),
)
def machine_speed_rollup(v):
    read = stored(v, rollups.machine_speed_1m(v.machine_rows(hits=True)), "speed")
    return rollups.machine_speed_rollup(read, timing.rollup_label("hour", START, STOP))


@register(
    "pno_traffic_5m",
    sql(
        "owned",
        f"""SELECT domain, (user_id % 50)::varchar AS pno, {five('ts_sec')} AS timestamp, sum(cs)::bigint AS cs,
        '{'2024010100'}' AS write_time FROM owned GROUP BY ALL""",
    ),
)
def pno_traffic_5m(v):
    rows = v.owned().withColumn("pno", (F.col("user_id") % 50).cast("string"))
    minutes = rows.groupBy("domain", "pno", timing.minute_label(F.col("ts_sec")).alias("timestamp")).agg(
        F.sum("cs").alias("cs")
    )
    far = minutes.withColumn("timestamp", F.col("timestamp") - 2 * STORED_MINUTE_REACH)  # beyond the reach
    path = staging.write_once(scans.with_hour(minutes.unionByName(far)), "pno", ("hour",))
    return rollups.pno_traffic_5m(v.spark.read.parquet(path), START, "2024010100")


# -------------------------------------------------------------------- sinks
ACCESS_SQL = sql("located", f"SELECT {EDGE_SQL} FROM located WHERE {GOOD}")


def edge_rows(v) -> DataFrame:
    return parse.accepted(parse.edge(v.lines(v.edge_text()), v.dims)).select("event_id", "ts_sec", *ACCESS_LOG.names)


@register(
    "sink_parquet_rows",
    sql(
        "located",
        f"""SELECT event_id, domain, cs, {stamp('ts_sec - 300', '%Y%m')}::int AS month_, {stamp('ts_sec - 300', '%d')}::int AS day_,
        {stamp('ts_sec - 300', '%H')}::int AS hour_, {stamp('ts_sec - 300', '%M')}::int AS minute_, 1 + event_id % 2 AS source
        FROM located WHERE {GOOD}""",
    ),
)
def sink_parquet_rows(v):
    """Parsed rows of two sources under the minute five minutes earlier, parsed and written once."""
    path = staging.fresh_path(v.spark, "rows")
    source = (F.col("event_id") % 2 + 1).cast("string")
    sinks.write_rows(edge_rows(v), path, F.col("ts_sec"), source=source, shift_sec=300)
    read = v.spark.read.parquet(path).select("event_id", "domain", "cs", *sinks.MINUTE_PARTITIONS, "source")
    return read.withColumn("source", F.col("source").cast("bigint"))


@register("sink_catalog_partitions", sql("located", f"SELECT event_id, domain, cs FROM located WHERE {GOOD}"))
def sink_catalog_partitions(v):
    """The same folders seen through the table catalog."""
    path = staging.fresh_path(v.spark, "cataloged")
    sinks.write_rows(edge_rows(v).select("event_id", "ts_sec", "domain", "cs"), path, F.col("ts_sec"))
    table = "rows_" + path.rsplit("-", 1)[1]  # a name of the run: runs that share a catalog do not meet
    parts = ", ".join(f"{p} string" for p in sinks.MINUTE_PARTITIONS)
    schema = f"event_id bigint, domain string, cs bigint, {parts}"
    sinks.register_table(v.spark, table, path, schema, sinks.MINUTE_PARTITIONS)
    return v.spark.table(table).select("event_id", "domain", "cs")


@register(
    "sink_text_minutes",
    sql("log", "SELECT ts_sec // 60 * 60 AS minute, count(*) AS lines FROM log GROUP BY 1"),
)
def sink_text_minutes(v):
    path = staging.fresh_path(v.spark, "text")
    lines = v.log(machine=True).select("ts_sec", v.edge_text().alias("value"))
    sinks.write_lines(lines, path, F.col("ts_sec"))
    read = v.spark.read.text(path)
    label = F.concat(*[F.lpad(F.col(c).cast("string"), n, "0") for c, n in (("y", 4), ("m", 2), ("d", 2), ("h", 2), ("mi", 2))])
    return read.groupBy(timing.minute_text_to_sec(label).alias("minute")).agg(F.count(F.lit(1)).alias("lines"))


@register(
    "sink_rejects",
    sql("mapped", "SELECT event_id FROM mapped WHERE NOT (event_id % 100 <> 7 AND event_id % 50 <> 3 AND domain IS NOT NULL)"),
)
def sink_rejects(v):
    """Rejected lines as text; the id comes back from their fields by a join."""
    lines = v.lines(v.hash_text(bare_path=True))
    path = staging.fresh_path(v.spark, "rejects")
    sinks.write_rejects(parse.rejected(parse.hash_v2(lines, v.dims)), path)
    found = v.spark.read.text(path)
    return lines.join(found, "value", "left_semi").select("event_id")


@register("sink_documents", f"{ORACLES['domain_traffic_5m']}")
def sink_documents(v):
    path = staging.fresh_path(v.spark, "documents")
    rolled = rollups.traffic_by_domain(v.log(), v.owners, [], timing.five_label(F.col("ts_sec")))
    sinks.write_documents(rolled.withColumn("index", timing.day_hour_label(F.col("timestamp"))), path, "index")
    return v.spark.read.parquet(path).drop("index")


@register(
    "sink_json",
    f"""SELECT '{{"domain":"' || domain || '","userid":"' || userid || '","timestamp":' || timestamp::varchar ||
    ',"flow_size":' || flow_size::varchar || ',"req_count":' || req_count::varchar || '}}' AS value
    FROM ({ORACLES['domain_traffic_5m']})""",
)
def sink_json(v):
    rolled = rollups.traffic_by_domain(v.log(), v.owners, [], timing.five_label(F.col("ts_sec")))
    path = staging.fresh_path(v.spark, "json")
    columns = ["domain", "userid", "timestamp", "flow_size", "req_count"]
    sinks.json_documents(rolled.select(*columns)).write.text(path)
    return v.spark.read.text(path)


@register("sink_kafka_records", sql("log", "SELECT event_id, true AS integer_key FROM log"))
def sink_kafka_records(v):
    """Records as the Kafka writer gets them; the id is read back from the URL line."""
    lines = v.events().select(F.concat(F.lit("line "), F.col("event_id").cast("string")).alias("value"))
    records = sinks.kafka_records(lines)
    return records.select(
        F.substring_index("value", " ", -1).cast("bigint").alias("event_id"),
        F.col("key").try_cast("int").isNotNull().alias("integer_key"),
    )


def domain_lines(v) -> DataFrame:
    return v.owned().select("domain", F.concat_ws(" ", F.col("event_id").cast("string"), "url").alias("value"))


@register("sink_domain_gzip", sql("owned", "SELECT domain, event_id::varchar || ' ' || url AS value FROM owned"))
def sink_domain_gzip(v):
    path = staging.fresh_path(v.spark, "gzip")
    sinks.write_by_domain(domain_lines(v), path)
    return v.spark.read.text(path).select("domain", "value")


@register(
    "output_sizes",
    sql("owned", "SELECT domain || ' 0 ' || sum(strlen(event_id::varchar || ' ' || url) + 1)::varchar AS status, domain FROM owned GROUP BY domain"),
)
def output_sizes(v):
    """Bytes per domain folder, of text that is not compressed: a line and its end."""
    path = staging.fresh_path(v.spark, "plain")
    sinks.write_by_domain(domain_lines(v), path, compression="none")
    return merge.output_sizes(sinks.domain_files(v.spark, path))


@register("output_size_domains", sql("owned", "SELECT DISTINCT domain, '0' AS flag, true AS has_bytes FROM owned"))
def output_size_domains(v):
    words = F.split("status", " ")
    path = staging.fresh_path(v.spark, "gzip")
    sinks.write_by_domain(domain_lines(v), path)
    return merge.output_sizes(sinks.domain_files(v.spark, path)).select(
        "domain", F.get(words, F.lit(1)).alias("flag"), (F.get(words, F.lit(2)).cast("bigint") > 0).alias("has_bytes")
    )


@register(
    "sink_two_outputs",
    f"SELECT *, unnest(['a', 'b']) AS output FROM ({ORACLES['hash_traffic_5m']})",
)
def sink_two_outputs(v):
    rows = parse.accepted(parse.hash_dir(v.lines(v.hash_text(bare_path=True))))
    first, second = staging.fresh_path(v.spark, "first"), staging.fresh_path(v.spark, "second")
    sinks.write_twice(rollups.hash_traffic_5m(rows), first, second)
    a = v.spark.read.parquet(first).withColumn("output", F.lit("a"))
    return a.unionByName(v.spark.read.parquet(second).withColumn("output", F.lit("b")))


# ---------------------------------------------------------- merge scheduling
part(
    "merge_config",
    "hosts_",
    f"""SELECT domain, (min(p) // 2 % 2)::varchar AS merge_flag, (min(p) % 3)::varchar AS dir_flag FROM (
      SELECT host AS domain, p FROM hosts_ WHERE p % 3 <> 1
      UNION ALL SELECT {parent('host')}, p FROM hosts_ WHERE p % 3 = 1) GROUP BY 1""",
)
part(
    "merge_known",
    "hosts_ merge_config",
    f"""SELECT h.host AS domain, h.p, CASE WHEN a.domain IS NOT NULL THEN a.merge_flag ELSE b.merge_flag END AS merge_flag,
    CASE WHEN CASE WHEN a.domain IS NOT NULL THEN a.dir_flag ELSE b.dir_flag END = '0' THEN '0' ELSE '1' END AS dir_flag
    FROM hosts_ h LEFT JOIN merge_config a ON a.domain = {parent('h.host')} LEFT JOIN merge_config b ON b.domain = h.host""",
)


def merge_config(v) -> DataFrame:
    own = v.hosts.filter("p % 3 <> 1").select(F.col("host").alias("domain"), "p")
    above = v.hosts.filter("p % 3 = 1").select(net.parent_domain(F.col("host")).alias("domain"), "p")
    flags = own.unionByName(above).groupBy("domain").agg(F.min("p").alias("p"))
    half = F.floor(F.col("p") / 2) % 2
    return flags.select("domain", half.cast("string").alias("merge_flag"), (F.col("p") % 3).cast("string").alias("dir_flag"))


def saved_domains(v) -> DataFrame:
    return v.hosts.filter("p % 5 = 0").select(F.col("host").alias("domain"))


@register(
    "merge_schedule_hourly",
    sql(
        "merge_known",
        """SELECT 'post' AS action, domain, dir_flag FROM merge_known WHERE merge_flag = '1'
        UNION ALL SELECT 'save', domain, NULL FROM merge_known WHERE merge_flag = '0' AND p % 5 <> 0""",
    ),
)
def merge_schedule_hourly(v):
    domains = v.hosts.select(F.col("host").alias("domain"))
    return merge.schedule_hourly(domains, merge_config(v), saved_domains(v))


@register(
    "merge_schedule_daily",
    sql("merge_known", "SELECT domain, dir_flag FROM merge_known WHERE merge_flag = '0' AND p % 5 = 0"),
)
def merge_schedule_daily(v):
    return merge.schedule_daily(saved_domains(v), merge_config(v))


@register(
    "merge_payload",
    """SELECT batch, '{"time":"202401010000","domain":[' || string_agg('"' || e || '"', ',' ORDER BY place)
      || '],"fcname":"merge"}' AS payload FROM (
      SELECT e, place, place // 300 AS batch FROM (
        SELECT d || ' ' || f AS e, row_number() OVER (ORDER BY substr(md5(d), 1, 3), d) - 1 AS place FROM (
          SELECT 'p' || p_partkey::varchar || '.example.com' AS d, (p_partkey % 2)::varchar AS f FROM part))) GROUP BY batch""",
)
def merge_payload(v):
    key = F.col("p_partkey")
    scheduled = v.table("part").select(
        F.concat(F.lit("p"), key.cast("string"), F.lit(".example.com")).alias("domain"),
        (key % 2).cast("string").alias("dir_flag"),
    )
    return merge.payloads(scheduled, "202401010000", fcname="merge")


# ------------------------------------------------------------------ user SQL
USER_SQL = "SELECT domain, status, count(*) AS n, sum(cs) AS bytes FROM loginfo WHERE ua = 'android' GROUP BY domain, status"
USER_ORACLE = sql(
    "located",
    f"""SELECT domain, status, count(*) AS n, sum(cs)::bigint AS bytes FROM located
    WHERE {GOOD} AND {ua_keyword('agent')} = 'android' GROUP BY 1, 2""",
)


@register("adhoc_sql", USER_ORACLE)
def adhoc_sql(v):
    return jobs.run_sql(edge_rows(v), USER_SQL)


# ------------------------------------------------------------------- streams
def event_stream(v, files: int | None = None) -> DataFrame:
    """The events table as a stream, one file or a folder of files.

    The last letter as a pattern makes the source take either, marks of a pattern in the path are escaped; a table
    without files is an error, as in a batch read, and not an empty stream.
    """
    path = f"{v.sf_dir}/events.parquet"
    if not v.table("events").inputFiles():
        raise FileNotFoundError(f"no files in {path}")
    reader = v.spark.readStream.schema(EVENTS)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(re.sub(r"([\\*?{}\[\]])", r"\\\1", path[:-1]) + f"[{path[-1]}]")


BATCHES = 3


def in_batches(v, df: DataFrame, write) -> int:
    """Write a third of the events after another, as many files each as the table has; returns that number.

    A stream of so many files a trigger takes one third a batch, in this order.
    """
    files = max(1, len(v.table("events").inputFiles()))
    for i in range(BATCHES):
        write(df.filter(F.col("event_id") % BATCHES == i).repartition(files))
    return files


def batched_events(v) -> DataFrame:
    """The events as a stream of three batches."""
    path = staging.fresh_path(v.spark, "events")
    files = in_batches(v, v.table("events"), lambda df: df.write.mode("append").parquet(path))
    return v.spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path)


def line_stream(v) -> DataFrame:
    """Edge lines of the events as a text file stream."""
    path = staging.fresh_path(v.spark, "lines")
    v.lines(v.edge_text()).select("value").write.text(path)
    return scans.file_lines(v.spark, path)


def finished(query) -> None:
    query.awaitTermination()


@register("stream_domain_traffic_5m", ORACLES["domain_traffic_5m"])
def stream_domain_traffic_5m(v, files: int | None = None):
    """Partial rows per micro-batch, merged when read."""
    path = staging.fresh_path(v.spark, "stream")
    roll = lambda rows, _: rollups.traffic_by_domain(rows, v.owners, [], timing.five_label(F.col("ts_sec")))
    rows = v.log(events=event_stream(v, files))
    finished(jobs.rollup_batches(rows, lambda b, _: b, {"traffic": roll}, path, f"{path}/checkpoint"))
    partials = jobs.read_partials(v.spark, path, "traffic")
    return jobs.merged(partials, ["domain", "userid", "timestamp"], ["flow_size", "req_count"])


@register("stream_interval_traffic", ORACLES["domain_traffic_5m"])
def stream_interval_traffic(v):
    """The same under an interval trigger, over three batches; it is asked to stop when nothing new comes."""
    path = staging.fresh_path(v.spark, "interval")
    control = runner.Control(v.spark, f"{path}/stop")
    roll = lambda rows, _: rollups.traffic_by_domain(rows, v.owners, [], timing.five_label(F.col("ts_sec")))
    query = jobs.rollup_batches(
        v.log(events=batched_events(v)), lambda b, _: b, {"traffic": roll}, path, f"{path}/checkpoint", every="500 milliseconds", control=control
    )
    runner.run_through(query, control)
    return jobs.merged(jobs.read_partials(v.spark, path, "traffic"), ["domain", "userid", "timestamp"], jobs.SUMS)


@register(
    "stream_restart_traffic",
    sql(
        "owned",
        f"""SELECT domain, CASE WHEN event_id % {BATCHES} = {BATCHES - 1} THEN userid || '0' ELSE userid END AS userid,
        {five('ts_sec')} AS timestamp, {FLOW_SQL} FROM owned GROUP BY 1, 2, 3""",
    ),
)
def stream_restart_traffic(v):
    """Stopped behind its second batch and started again from the checkpoint, with owners that changed in between."""
    path = staging.fresh_path(v.spark, "restart")
    rows = v.log(events=batched_events(v))

    def roll(batch, d):
        return rollups.traffic_by_domain(batch, d.domains, [], timing.five_label(F.col("ts_sec")))

    for after, users in ((BATCHES - 1, F.col("userid")), (None, F.concat("userid", F.lit("0")))):
        control = runner.Control(v.spark, f"{path}/stop", after)
        load = lambda _, users=users: Dims(domains=v.domains.withColumn("userid", users))
        query = jobs.rollup_batches(rows, lambda b, _: b, {"traffic": roll}, path, f"{path}/checkpoint", load, control=control)
        runner.run_until_asked(query, control)
    return jobs.merged(jobs.read_partials(v.spark, path, "traffic"), ["domain", "userid", "timestamp"], jobs.SUMS)


@register(
    "stream_late_split",
    sql(
        "owned",
        f"""SELECT 'on_time' AS route, domain, userid, {minute('ts_sec')} AS timestamp, {FLOW_SQL} FROM owned WHERE {ON_TIME} GROUP BY ALL
        UNION ALL SELECT 'late', domain, userid, ts_sec // 3600 * 3600, {FLOW_SQL} FROM owned WHERE {LATE} GROUP BY ALL""",
    ),
)
def stream_late_split(v, files: int | None = None):
    """On-time rows by minute and late rows by hour, two outputs of one batch."""
    path = staging.fresh_path(v.spark, "stream")
    keys = ["domain", "userid"]
    outputs = {
        "on_time": lambda r, _: rollups.traffic(filters.on_time(r), keys, timing.minute_label(F.col("ts_sec"))),
        "late": lambda r, _: rollups.traffic(filters.late(r), keys, timing.hour_label(F.col("ts_sec"))),
    }
    own = lambda b, _: filters.known_domain(enrich.map_domain(b, v.owners))
    finished(jobs.rollup_batches(v.log(events=event_stream(v, files)), own, outputs, path, f"{path}/checkpoint"))
    parts = []
    for name in outputs:
        rows = jobs.merged(jobs.read_partials(v.spark, path, name), [*keys, "timestamp"], ["flow_size", "req_count"])
        parts.append(rows.withColumn("route", F.lit(name)))
    return parts[0].unionByName(parts[1])


@register("stream_ingest", sql("located", f"SELECT domain, cs, userid, status FROM located WHERE {GOOD}"))
def stream_ingest(v):
    """Raw lines to the partitioned table, rejects beside it."""
    path = staging.fresh_path(v.spark, "ingest")
    query = jobs.ingest(
        line_stream(v), lambda b, d: parse.dispatch_access(b, d), f"{path}/rows", f"{path}/checkpoint",
        F.unix_timestamp("arrival"), lambda _: v.dims, rejects=path,
    )
    finished(query)
    return v.spark.read.parquet(f"{path}/rows").select("domain", "cs", "userid", "status")


@register("stream_adhoc_sql", USER_ORACLE)
def stream_adhoc_sql(v):
    """The user's SQL over each batch; the batches' documents are added up."""
    path = staging.fresh_path(v.spark, "sql")
    query = jobs.sql_batches(
        line_stream(v), lambda b, d: parse.accepted(parse.edge(b, d)), USER_SQL, path, f"{path}/checkpoint", lambda _: v.dims
    )
    finished(query)
    documents = v.spark.read.text(f"{path}/documents")
    doc = F.from_json("value", "domain string, status string, n bigint, bytes bigint")
    rows = documents.select(doc.alias("d")).select("d.*")
    return rows.groupBy("domain", "status").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))


@register("batch_counts", "SELECT 0::bigint AS batch_id, count(*) AS records FROM events")
def batch_counts(v, files: int | None = None):
    """Records of each batch, noted while the batch is written; one batch unless ``files`` bounds it."""
    path = staging.fresh_path(v.spark, "counts")
    write = lambda b, i: b.write.mode("overwrite").parquet(jobs.batch_folder(path, "data", i))
    finished(jobs.count_batches(event_stream(v, files), write, path, f"{path}/checkpoint"))
    return v.spark.read.parquet(f"{path}/counts").select("batch_id", "records")


@register("batch_counts_files", f"SELECT event_id % {BATCHES} AS batch_id, count(*) AS records FROM events GROUP BY 1")
def batch_counts_files(v):
    """Records of each of three batches of a roll-up job, noted by a listener."""
    path = staging.fresh_path(v.spark, "noted")
    outputs = {n: lambda rows, _: rows.groupBy("event_type").count() for n in ("first", "second")}
    with runner.batch_log(v.spark, f"{path}/log"):
        finished(jobs.rollup_batches(batched_events(v), lambda b, _: b, outputs, path, f"{path}/checkpoint"))
    return runner.read_log(v.spark, f"{path}/log").select("batch_id", "records")


@register("scan_text_files", sql("located", f"SELECT domain, cs, userid, status FROM located WHERE {GOOD}"))
def scan_text_files(v):
    """Raw lines from text files, three times as many as the events have."""
    path = staging.fresh_path(v.spark, "text")
    in_batches(v, v.lines(v.edge_text()), lambda df: df.select("value").write.mode("append").text(path))
    return parse.accepted(parse.edge(scans.text_lines(v.spark, path), v.dims)).select("domain", "cs", "userid", "status")


@register(
    "stream_final_traffic",
    sql("owned", f"SELECT domain, userid, {five('ts_sec')} AS timestamp, {FLOW_SQL} FROM owned GROUP BY 1, 2, 3"),
)
def stream_final_traffic(v, files: int | None = None):
    """Final rows of closed windows, rows of those still open at the end, and late rows, added up."""
    path = staging.fresh_path(v.spark, "final")
    keys = ["domain", "userid"]
    own = lambda b, _: filters.known_domain(enrich.map_domain(b, v.owners))
    finished(jobs.final_batches(v.log(events=event_stream(v, files)), own, keys, path, f"{path}/checkpoint"))
    whole = jobs.read_final(v.spark, path, keys).unionByName(jobs.read_late(v.spark, path, keys))
    return jobs.merged(whole, [*keys, "timestamp"], ["flow_size", "req_count"])
