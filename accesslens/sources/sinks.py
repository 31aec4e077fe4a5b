"""Sinks: partitioned Parquet, text, JSON documents, Kafka records."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from accesslens.functions import timing

MINUTE_PARTITIONS = ("month_", "day_", "hour_", "minute_")


def _rebalanced(df: DataFrame, *by: str) -> DataFrame:
    """Few large files per partition value; AQE splits a hot value over tasks."""
    return df.hint("rebalance", *by)


def with_minute_labels(df: DataFrame, label_sec: Column, source: str | Column | None = None) -> DataFrame:
    """Add month / day / hour / minute partition columns of a label time.

    ``source`` separates jobs that write one table, or the sources of one job's rows.
    """
    out = df.withColumns(timing.partition_labels(label_sec))
    return out.withColumn("source", F.lit(source)) if source is not None else out


def write_rows(
    df: DataFrame, path: str, label_sec: Column, source: str | Column | None = None, shift_sec: int = 0,
    mode: str = "append",
) -> None:
    """Append rows to a Parquet table partitioned by the minute of a label time, and by source if there is one."""
    by = MINUTE_PARTITIONS + (("source",) if source is not None else ())
    labelled = with_minute_labels(df, label_sec - shift_sec, source)
    _rebalanced(labelled, *by).write.mode(mode).partitionBy(*by).parquet(path)


def register_table(spark: SparkSession, table: str, path: str, schema: str, by: tuple[str, ...]) -> None:
    """Table over partition folders, with the partitions that exist already."""
    keys = ", ".join(by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet PARTITIONED BY ({keys}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {table}")


def add_partition(spark: SparkSession, table: str, **values: str) -> None:
    """Make one new partition visible; known ones are left alone.

    Costs the same however many partitions the table has.
    """
    spec = ", ".join(f"{k} = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")


def write_lines(lines: DataFrame, path: str, label_sec: Column, mode: str = "append") -> None:
    """Text lines under year / month / day / hour / minute folders."""
    ts = F.timestamp_seconds(label_sec)
    parts = {"y": "yyyy", "m": "MM", "d": "dd", "h": "HH", "mi": "mm"}
    labelled = lines.select("value", *[F.date_format(ts, f).alias(k) for k, f in parts.items()])
    _rebalanced(labelled, *parts).write.mode(mode).partitionBy(*parts).text(path)


def write_rejects(rejects: DataFrame, path: str, mode: str = "append") -> None:
    """Reject lines of one batch.  Small batches make one file; AQE keeps
    several when the rejects are many, so no task has to write them all."""
    _rebalanced(rejects.select("value")).write.mode(mode).text(path)


def write_documents(df: DataFrame, path: str, label: str, mode: str = "append") -> None:
    """Roll-up rows as Parquet, one folder per index label."""
    _rebalanced(df, label).write.mode(mode).partitionBy(label).parquet(path)


def json_documents(df: DataFrame) -> DataFrame:
    """One JSON string per row."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def kafka_records(lines: DataFrame) -> DataFrame:
    """``(key, value)`` with a random integer key, spreading lines over partitions."""
    key = F.floor(F.rand() * 4294967296 - 2147483648).cast("int").cast("string")
    return lines.select(key.alias("key"), F.col("value").cast("string").alias("value"))


def write_kafka(lines: DataFrame, brokers: str, topic: str) -> None:
    """Needs the Spark Kafka connector on the class path."""
    kafka_records(lines).write.format("kafka").option("kafka.bootstrap.servers", brokers).option(
        "topic", topic
    ).save()


def write_by_domain(lines: DataFrame, path: str, mode: str = "append", compression: str = "gzip") -> None:
    """Text per domain from ``(domain, value)``, gzip unless told otherwise; the key is not written.

    A hot domain gets several files, split by AQE.
    """
    _rebalanced(lines.select("domain", "value"), "domain").write.mode(mode).partitionBy("domain").option(
        "compression", compression
    ).text(path)


def domain_files(spark: SparkSession, path: str) -> DataFrame:
    """(domain, path, size) of every file a by-domain write left."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*"
    ).load(path)
    domain = F.url_decode(F.regexp_extract("path", "/domain=([^/]*)/", 1))
    return files.select(domain.alias("domain"), "path", F.col("length").alias("size"))


def write_twice(df: DataFrame, first: str, second: str, mode: str = "append") -> None:
    """One result into two outputs, computed once."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for path in (first, second):
            kept.write.mode(mode).parquet(path)
    finally:
        kept.unpersist()
