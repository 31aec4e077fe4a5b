"""Running stream jobs: interval triggers that end, graceful stops, and batches sized by time.

A stop is asked for by a marker file, which any process that reaches the shared folder can write.  The batch at hand
is finished and committed; the next one is refused before it does any work, and runs whole after a restart from
the checkpoint.  Nothing is cut off, lost or repeated.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from accesslens.sources import staging

_REFUSED = "stream job stopped on request before batch"


@dataclass
class Batch:
    """One finished batch: its number, and seconds it took."""

    batch_id: int
    seconds: float


@dataclass
class Control:
    """What a job and its runner share: the marker, and the batches finished so far.

    ``after`` asks for a stop by itself once so many batches of this run are finished.
    """

    spark: SparkSession
    marker: str
    after: int | None = None
    done: list[Batch] = field(default_factory=list)

    def ask(self, why: str = "") -> None:
        staging.replace_text(self.spark, self.marker, json.dumps({"why": why}))

    def clear(self) -> None:
        staging.remove(self.spark, self.marker)

    def asked(self) -> bool:
        return (self.after is not None and len(self.done) >= self.after) or staging.read_text(self.spark, self.marker) is not None

    def watched(self, each: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """``each``, refused once a stop is asked for, and timed."""

        def run(batch: DataFrame, batch_id: int) -> None:
            if self.asked():
                raise RuntimeError(f"{_REFUSED} {batch_id}")
            began = time.monotonic()
            each(batch, batch_id)
            self.done.append(Batch(batch_id, time.monotonic() - began))

        return run


def run_until_asked(query: StreamingQuery, control: Control, poll_sec: float = 0.2) -> bool:
    """Wait for a job to end by its own trigger or by a stop that was asked for, and say if it was the latter.

    Other failures are raised.  A job without new data is stopped between two triggers.
    """
    while True:
        try:
            if query.awaitTermination(poll_sec):
                return False
        except StreamingQueryException as e:
            if _REFUSED not in str(e):
                raise
            return True
        status = query.status
        if control.asked() and not status["isTriggerActive"] and not status["isDataAvailable"]:
            query.stop()
            return True


def run_through(query: StreamingQuery, control: Control, quiet_sec: float = 2.0, poll_sec: float = 0.1) -> None:
    """Run an interval trigger until its source has had nothing new for a while, then ask it to stop."""
    quiet_since, seen = time.monotonic(), 0
    while query.isActive and not control.asked():
        status, done = query.status, len(control.done)
        if done != seen or status["isDataAvailable"] or not query.recentProgress:
            quiet_since, seen = time.monotonic(), done
        if time.monotonic() - quiet_since >= quiet_sec:
            control.ask("nothing new")
        time.sleep(poll_sec)
    run_until_asked(query, control)


#: A batch may take this part of its time more or less before its size is changed.
TOLERANCE = 0.5


def next_limit(limit: int, seconds: float, target_sec: float, least: int = 1, most: int = 1 << 30) -> int:
    """How many files or offsets a batch may hold so that it takes about ``target_sec``; at most doubled at once.

    Within the tolerance the limit stays, so that a steady job is not restarted.
    """
    if abs(seconds - target_sec) <= TOLERANCE * target_sec:
        return limit
    wanted = int(limit * target_sec / max(seconds, 1e-3))
    return max(least, min(wanted, 2 * limit, most))


def paced(
    start: Callable[[int, Control], StreamingQuery], control: Control, limit: int, target_sec: float, least: int = 1, most: int = 1 << 30
) -> list[int]:
    """Run a job with batches sized by their measured time; returns the limits it ran with.

    ``start(limit, control)`` starts the job from its checkpoint with at most ``limit`` files or offsets a batch.
    After a batch that took too long or too short a time, the job ends behind that batch and starts again with the
    next limit; the batch that was refused then runs as it was planned before.  It ends for good when its trigger does or a stop is asked for.
    """
    limits = [limit]
    while True:
        own = _Paced(control, limits[-1], target_sec, least, most)
        stopped = run_until_asked(start(limits[-1], own), own)
        control.done.extend(own.done)
        if not stopped or control.asked():
            return limits
        limits.append(own.wanted)


class _Paced(Control):
    """A run that ends itself behind a batch whose time asks for another limit."""

    def __init__(self, outer: Control, limit: int, target_sec: float, least: int, most: int):
        super().__init__(outer.spark, outer.marker)
        self.outer, self.limit, self.target_sec, self.least, self.most = outer, limit, target_sec, least, most

    @property
    def wanted(self) -> int:
        return next_limit(self.limit, self.done[-1].seconds, self.target_sec, self.least, self.most) if self.done else self.limit

    def asked(self) -> bool:
        return self.wanted != self.limit or self.outer.asked()


NOTES = "run_id string, batch_id bigint, records bigint, seconds double"


class BatchLog(StreamingQueryListener):
    """Notes the records and seconds of every batch that ends, of any job of the session, without touching its code.

    Each job here reads its source once a batch (rows that serve several outputs are kept), so Spark's count of input
    rows is that of the records.  Batches without records leave no note; a batch that runs again replaces its own.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.numInputRows:
            note = {"run_id": str(p.runId), "batch_id": p.batchId, "records": p.numInputRows, "seconds": p.batchDuration / 1000}
            staging.replace_text(self.spark, f"{self.path}/{p.id}-{p.batchId}.json", json.dumps(note))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


@contextmanager
def batch_log(spark: SparkSession, path: str, wait_ms: int = 60_000) -> Iterator[BatchLog]:
    """A log of the batches that end within the block; all its notes are there behind it."""
    log = BatchLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(wait_ms)
    finally:
        spark.streams.removeListener(log)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Notes of a log, one row a batch; none before the first."""
    if not staging.has_files(spark, path):
        return spark.createDataFrame([], NOTES)
    return spark.read.schema(NOTES).option("pathGlobFilter", "*.json").json(path)
