"""Keyed state across runs: the last hash of each document, and a timer for those that are seen no more.

``transformWithState`` keeps a value for each key in RocksDB, so the state is as
large as the disks of all executors and a micro-batch touches only the keys that
it has rows or due timers for.  The checkpoint carries state and timers from run
to run.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What a document is reported as.
NEW, CHANGED, GONE = "new", "changed", "gone"
SCHEMA = "doc string, sha256 string, status string, changes long"


class HashTracker(StatefulProcessor):
    """Reports a document when it is new, when its hash changes, and when it was not seen for ``absent_ms`` of event time."""

    def __init__(self, absent_ms: int):
        self.absent_ms = absent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "sha256 string, changes long, due long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.last.get() if self.last.exists() else None
        sha, changes, due = known or (None, 0, None)
        seen = 0
        for row in sorted(((r["ts_ms"], r["sha256"] or "") for r in rows)):  # one document's rows of a micro-batch
            seen, new = row
            if due is None or new != sha:
                status, changes = (NEW, 0) if due is None else (CHANGED, changes + 1)
                due = due or 0
                yield Row(doc=key[0], sha256=new, status=status, changes=changes)
            sha = new
        if due:
            self.handle.deleteTimer(due)
        due = max(due, seen + self.absent_ms)
        self.handle.registerTimer(due)
        self.last.update((sha, changes, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        sha, changes, _ = self.last.get()
        self.last.clear()
        yield Row(doc=key[0], sha256=sha, status=GONE, changes=changes)

    def close(self) -> None:
        pass


def tracked(stream: DataFrame, *, absent_days: int = 30, delay: str = "1 day") -> DataFrame:
    """doc, sha256, status, changes of a stream (doc, sha256, ts); rows later than ``delay`` are left out.

    A document that comes back after it was gone is new.  A null hash counts as
    empty; a null document is a key like any other; rows of one document in one
    micro-batch count in order of (ts, sha256).
    """
    timed = stream.withWatermark("ts", delay).selectExpr("doc", "sha256", "ts", "unix_millis(ts) as ts_ms")
    return timed.groupBy("doc").transformWithState(HashTracker(absent_days * 86_400_000), SCHEMA, "Append", "EventTime")


@contextmanager
def rocks(spark: SparkSession):
    """The session with state in RocksDB, for queries that start in the block."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def track_files(spark: SparkSession, source: str, *, target: str, checkpoint: str, absent_days: int = 30, delay: str = "1 day") -> None:
    """One run over the Parquet files that are new below ``source``; what it finds is appended to ``target`` once."""
    stream = spark.readStream.schema("doc string, sha256 string, ts timestamp").parquet(source)
    with rocks(spark):
        found = tracked(stream, absent_days=absent_days, delay=delay)
        query = found.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
