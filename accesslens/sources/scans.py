"""Scans: Kafka and file streams, text, and stored roll-ups by time range."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, functions as F

from accesslens.constants import STOP_SLACK_SECONDS
from accesslens.functions import timing
from accesslens.operators import filters
from accesslens.schemas import LINES


def kafka_options(brokers: str, topics: str, max_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the Kafka source; offsets live in the query checkpoint."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topics,
        "startingOffsets": "latest",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_lines(
    spark: SparkSession,
    brokers: str,
    topics: str,
    max_per_trigger: int | None = None,
    predicate: filters.Predicate | None = None,
) -> DataFrame:
    """Kafka -> ``(value, arrival)``; the predicate runs before any parsing.

    Needs the Spark Kafka connector on the class path.
    """
    raw = spark.readStream.format("kafka").options(**kafka_options(brokers, topics, max_per_trigger)).load()
    lines = raw.select(F.col("value").cast("string"), F.col("timestamp").alias("arrival"))
    return filters.keep(lines, predicate) if predicate else lines


def file_lines(
    spark: SparkSession, path: str, max_files: int | None = None, predicate: filters.Predicate | None = None
) -> DataFrame:
    """Text files as a stream, with the file time as arrival."""
    reader = spark.readStream.schema(LINES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path).select("value", F.col("_metadata.file_modification_time").alias("arrival"))
    return filters.keep(lines, predicate) if predicate else lines


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def hour_of(sec: int, zone: str = "UTC") -> str:
    """Label of the hour a time is in."""
    return datetime.fromtimestamp(sec, ZoneInfo(zone)).strftime("%Y%m%d%H")


def range_hours(start_sec: int, stop_sec: int, zone: str = "UTC") -> list[str]:
    """Hour partitions a range reads: start, and stop plus the slack.

    Runs cover at most an hour, so the two ends are all the hours there are; a
    longer range also gets every hour between.
    """
    last = stop_sec + STOP_SLACK_SECONDS
    times = [*range(start_sec, last, 3600), last]
    return sorted({hour_of(t, zone) for t in times})


def with_hour(stored: DataFrame, label: str = "timestamp") -> DataFrame:
    """Add the ``hour`` partition column stored roll-ups are written by."""
    return stored.withColumn("hour", timing.day_hour_label(F.col(label)))


def rollup_range(
    spark: SparkSession, path: str, start_sec: int, stop_sec: int, inclusive: bool = False
) -> DataFrame:
    """Stored roll-up between two times: partitions by hour, rows by label.

    Half-open by default, so adjacent runs do not count a boundary row twice.
    """
    t = F.col("timestamp")
    upper = t <= stop_sec if inclusive else t < stop_sec
    hours = range_hours(start_sec, stop_sec, spark.conf.get("spark.sql.session.timeZone"))
    stored = spark.read.parquet(path)
    return stored.filter(F.col("hour").cast("string").isin(*hours) & (t >= start_sec) & upper)
