"""Stream jobs.

A job is a stream of lines (or rows), one step that turns a micro-batch into
rows, and named outputs computed from those rows.  The operators are the batch
ones.  Every output of a batch goes to a folder named by the batch id and is
overwritten there, so a batch that runs again after a failure leaves no
repeats.  A manifest, written when all outputs of a batch are there, says how far readers may look: they see a batch in
all outputs or in none.  Dimensions are loaded again for every batch, or by time (``dims.TimedDims``).

Late rows are split off and written to outputs of their own; nothing drops them.
``final_batches`` closes windows behind the newest event time and writes each
once; rows that come for a closed window go to its late output.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from accesslens.functions import timing
from accesslens.sources import scans, sinks, staging
from accesslens.sources.dims import Dims, KeptDims
from accesslens.streaming.runner import Control

LoadDims = Callable[[SparkSession], Dims | KeptDims]
ToRows = Callable[[DataFrame, Dims], DataFrame]
BATCH = "batch"


def no_dims(_: SparkSession) -> Dims:
    return Dims()


def start(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    control: Control | None = None,
) -> StreamingQuery:
    """Run ``each`` per micro-batch: every so often, or once over all there is; ``control`` can stop it between batches."""
    each = control.watched(each) if control else each
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def fresh_dims(load_dims: LoadDims, spark: SparkSession) -> KeptDims:
    """A batch's lookups: those a timed load holds, else loaded again; what has no new version is not written again."""
    given = load_dims(spark)
    return given if isinstance(given, KeptDims) else given.measured()


def batch_folder(path: str, output: str, batch_id: int) -> str:
    return f"{path}/{output}/{BATCH}={batch_id}"


def rollup_batches(
    stream: DataFrame,
    to_rows: ToRows,
    outputs: dict[str, ToRows],
    path: str,
    checkpoint: str,
    load_dims: LoadDims = no_dims,
    every: str | None = None,
    control: Control | None = None,
) -> StreamingQuery:
    """Partial roll-ups per micro-batch, rows computed once for all outputs, seen by readers all at once."""

    def each(batch: DataFrame, batch_id: int) -> None:
        dims = fresh_dims(load_dims, batch.sparkSession)
        rows = to_rows(batch, dims)
        if len(outputs) > 1:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, roll in outputs.items():
                write_partial(roll(rows, dims), path, name, batch_id)
            commit(batch.sparkSession, path, batch_id)
        finally:
            if len(outputs) > 1:
                rows.unpersist()

    return start(stream, each, checkpoint, every, control)


COMMITTED = "committed.json"


def commit(spark: SparkSession, path: str, batch_id: int) -> None:
    """Let readers see the outputs of a batch.  Batches end in order, so one small file, replaced, says it for all."""
    if batch_id > committed(spark, path):
        staging.replace_text(spark, f"{path}/{COMMITTED}", json.dumps({"through": batch_id}))


def committed(spark: SparkSession, path: str) -> int:
    """The last batch whose outputs are all there; -1 before the first."""
    found = staging.read_text(spark, f"{path}/{COMMITTED}")
    return json.loads(found)["through"] if found else -1


def write_partial(df: DataFrame, path: str, output: str, batch_id: int) -> None:
    """A batch's part of a roll-up, under the hour of its label (``all`` without one) and the batch.

    A batch that runs again replaces its own folders.
    """
    hourly = scans.with_hour(df) if "timestamp" in df.columns else df.withColumn("hour", F.lit("all"))
    labelled = hourly.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    writer = labelled.hint("rebalance", "hour").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("hour", BATCH).parquet(f"{path}/{output}")


def read_partials(
    spark: SparkSession, path: str, output: str, start_sec: int | None = None, stop_sec: int | None = None
) -> DataFrame:
    """Partial rows of all committed batches; with both times only labels from start to before stop, and their hours."""
    if start_sec is None or stop_sec is None:
        rows = spark.read.parquet(f"{path}/{output}")
    else:
        rows = scans.rollup_range(spark, f"{path}/{output}", start_sec, stop_sec)
    return rows.filter(F.col(BATCH) <= committed(spark, path))


def merged(partials: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Whole rows of a partial roll-up: sums over the batches of a key."""
    return partials.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])


FINAL, LATE, MARK, PARTS = "final", "late", "mark.json", "parts"
SUMS = ["flow_size", "req_count"]
#: Seconds an event may be ahead of its arrival: clocks differ.  One further ahead does not move the mark.
AHEAD_SEC = 300
#: Seconds behind the mark that parts of closed hours are kept.
KEEP_SEC = 3600


def _mark(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """Windows up to this label were closed before the batch; None before the first.

    The one mark file holds the newest batch's mark and the one before it, so the newest batch may run again.
    """
    found = staging.read_text(spark, f"{path}/{MARK}")
    if found is None:
        return None
    mark = json.loads(found)
    return mark["closed"] if mark["batch"] < batch_id else mark["before"]


def final_batches(
    stream: DataFrame,
    to_rows: ToRows,
    keys: list[str],
    path: str,
    checkpoint: str,
    lateness_sec: int = 600,
    load_dims: LoadDims = no_dims,
    every: str | None = None,
    control: Control | None = None,
    keep_sec: int = KEEP_SEC,
) -> StreamingQuery:
    """Traffic per keys and five minutes, a window's rows written once, when it closes.

    A window closes when an event ``lateness_sec`` newer than its end was seen; an event counts as no newer than its
    ``arrival_sec`` (or the clock, without that column) and ``AHEAD_SEC``, so that one wrong clock closes nothing.
    Parts of open windows lie under their hour; closing reads the hours between the old mark and the new one alone, and
    hours that are ``keep_sec`` behind the mark are deleted: what a batch lists and reads does not grow with the age of
    the stream.  Rows for a window that closed in an earlier batch are summed into the late output.  The mark of a batch
    depends on earlier ones only, so a batch may run again.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        label = timing.five_label(F.col("ts_sec"))
        rows = to_rows(batch, fresh_dims(load_dims, spark))
        arrived = F.col("arrival_sec") if "arrival_sec" in rows.columns else F.unix_timestamp(F.current_timestamp())
        sums = rows.groupBy(*keys, label.alias("timestamp")).agg(
            F.sum("cs").alias("flow_size"), F.count(F.lit(1)).alias("req_count"),
            F.max(F.least(F.col("ts_sec"), arrived + AHEAD_SEC)).alias("newest"),
        )
        sums = sums.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            closed = _mark(spark, path, batch_id)
            newest = sums.agg(F.max("newest")).first()[0]
            if newest is None:
                return
            on_time = F.lit(True) if closed is None else F.col("timestamp") > closed
            write_partial(sums.filter(on_time).drop("newest"), path, PARTS, batch_id)
            write_partial(sums.filter(~on_time).drop("newest"), path, LATE, batch_id)
            now = max(newest - lateness_sec, closed if closed is not None else newest - lateness_sec)
            parts = _parts(spark, path, batch_id + 1, closed, now)
            if parts is not None:
                write_partial(merged(parts, [*keys, "timestamp"], SUMS), path, FINAL, batch_id)
            staging.replace_text(spark, f"{path}/{MARK}", json.dumps({"batch": batch_id, "closed": now, "before": closed}))
            if closed is not None:
                _retire(spark, path, closed - keep_sec)
        finally:
            sums.unpersist()

    return start(stream, each, checkpoint, every, control)


def _hour(spark: SparkSession, sec: int) -> str:
    """Name of the folder of a label's hour."""
    return f"hour={scans.hour_of(sec, spark.conf.get('spark.sql.session.timeZone'))}"


def _parts(spark: SparkSession, path: str, before: int, after: int | None = None, upto: int | None = None) -> DataFrame | None:
    """Parts of batches before one, for labels after one time and up to another, from the folders of their hours; None without any."""
    hours = staging.folders(spark, f"{path}/{PARTS}")
    if after is not None:
        hours = [h for h in hours if h >= _hour(spark, after)]
    if upto is not None:
        hours = [h for h in hours if h <= _hour(spark, upto)]
    if not hours:
        return None
    parts = spark.read.option("basePath", f"{path}/{PARTS}").parquet(*[f"{path}/{PARTS}/{h}" for h in hours])
    parts = parts.filter(F.col(BATCH) < before)
    parts = parts if after is None else parts.filter(F.col("timestamp") > after)
    return parts if upto is None else parts.filter(F.col("timestamp") <= upto)


def _retire(spark: SparkSession, path: str, behind: int) -> None:
    """Delete the parts of hours that ended before a time: their windows are in the final output."""
    last = _hour(spark, behind)
    for hour in staging.folders(spark, f"{path}/{PARTS}"):
        if hour < last:
            staging.remove(spark, f"{path}/{PARTS}/{hour}")


def _rows(spark: SparkSession, path: str, output: str, keys: list[str]) -> DataFrame:
    """Rows of an output that may have none yet; keys are text."""
    columns = [*keys, "timestamp", *SUMS]
    if staging.has_files(spark, f"{path}/{output}"):
        return spark.read.parquet(f"{path}/{output}").select(*columns)
    schema = ", ".join([f"{k} string" for k in keys] + [f"{c} bigint" for c in columns[len(keys) :]])
    return spark.createDataFrame([], schema)


def read_final(spark: SparkSession, path: str, keys: list[str], open_too: bool = True) -> DataFrame:
    """Rows of closed windows; with ``open_too`` those of windows still open as they stand, for the end of a bounded run."""
    final = _rows(spark, path, FINAL, keys)
    closed = _mark(spark, path, 1 << 62)
    still = _parts(spark, path, 1 << 62, closed) if open_too and closed is not None else None
    if still is None:
        return final
    return final.unionByName(merged(still.select(*keys, "timestamp", *SUMS), [*keys, "timestamp"], SUMS))


def read_late(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Rows that came for windows already closed, summed per batch."""
    return _rows(spark, path, LATE, keys)


def ingest(
    stream: DataFrame,
    to_rows: ToRows,
    path: str,
    checkpoint: str,
    label_sec: Column,
    load_dims: LoadDims = no_dims,
    rejects: str | None = None,
    every: str | None = None,
    table: str | None = None,
    control: Control | None = None,
) -> StreamingQuery:
    """Rows to a Parquet table by minute and batch, rejects to text.

    ``to_rows`` returns a parse result; it is computed once and split.  With a catalog ``table`` over the path each
    batch adds its own partitions, which costs the same however many there are.
    """
    from accesslens.operators import parse

    def each(batch: DataFrame, batch_id: int) -> None:
        parsed = to_rows(batch, fresh_dims(load_dims, batch.sparkSession)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = parse.accepted(parsed).drop("value", "_state")
            labelled = sinks.with_minute_labels(good, label_sec).withColumn(BATCH, F.lit(batch_id))
            by = (*sinks.MINUTE_PARTITIONS, BATCH)
            labelled.hint("rebalance", *by).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(*by).parquet(path)
            if table:
                for r in labelled.select(*by).distinct().collect():  # the minutes of one batch
                    sinks.add_partition(batch.sparkSession, table, **{c: str(r[c]) for c in by})
            if rejects:
                sinks.write_rejects(parse.rejected(parsed), batch_folder(rejects, "rejects", batch_id), "overwrite")
        finally:
            parsed.unpersist()

    return start(stream, each, checkpoint, every, control)


def count_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    path: str,
    checkpoint: str,
    every: str | None = None,
    control: Control | None = None,
) -> StreamingQuery:
    """Write each batch and note how many records it held; empty batches leave no note.

    The count is observed while the batch is written, without a second pass.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        write(batch.observe(seen, F.count(F.lit(1)).alias("n")), batch_id)
        n = seen.get["n"]
        if n:
            note = batch.sparkSession.range(1).select(
                F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(n).cast("bigint").alias("records")
            )
            note.write.mode("overwrite").parquet(batch_folder(path, "counts", batch_id))

    return start(stream, each, checkpoint, every, control)


def run_sql(rows: DataFrame, query: str, view: str = "loginfo") -> DataFrame:
    """A user's SQL over the rows, under the name the query uses; a view of that name that the session has stays as it is."""
    spark = rows.sparkSession
    held = spark.table(view) if spark._jsparkSession.sessionState().catalog().getTempView(view).isDefined() else None
    rows.createOrReplaceTempView(view)
    try:
        return spark.sql(query)
    finally:
        if held is None:
            spark.catalog.dropTempView(view)
        else:
            held.createOrReplaceTempView(view)


def sql_batches(
    stream: DataFrame,
    to_rows: ToRows,
    query: str,
    path: str,
    checkpoint: str,
    load_dims: LoadDims = no_dims,
    view: str = "loginfo",
    every: str | None = None,
    control: Control | None = None,
) -> StreamingQuery:
    """A user's SQL over every micro-batch, results as JSON documents."""

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = to_rows(batch, fresh_dims(load_dims, batch.sparkSession))
        found = sinks.json_documents(run_sql(rows, query, view))
        found.write.mode("overwrite").text(batch_folder(path, "documents", batch_id))

    return start(stream, each, checkpoint, every, control)
