"""Incremental processing: files are read once, results are appended once, progress is observed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery, StreamingQueryListener


def ingest(spark: SparkSession, source: str, sink: str, checkpoint: str, schema: str, step: Callable[[DataFrame], DataFrame] = lambda df: df, key: str | None = None, form: str = "json") -> StreamingQuery:
    """Process the files that are new since the last run, and stop. With a key, a row whose key has come before is dropped, across runs too; the state holds every key, and grows with them."""
    rows = spark.readStream.schema(schema).format(form).load(source)
    if key:
        rows = rows.dropDuplicates([key])
    return step(rows).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def windowed_counts(spark: SparkSession, events: DataFrame, width: str = "5 minutes", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums by event type in event-time windows; rows later than the watermark are dropped (a stream frame has event columns ts, event_type, value)."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(window, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


class Progress(StreamingQueryListener):
    """Keeps the last progress of each query for a caller to poll."""

    def __init__(self):
        self.last: dict[str, dict] = {}

    def onQueryStarted(self, event):
        self.last[str(event.id)] = {"rows": 0, "done": False}

    def onQueryProgress(self, event):
        p = event.progress
        self.last[str(p.id)] = {"rows": self.last.get(str(p.id), {}).get("rows", 0) + p.numInputRows, "done": False}

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.last.setdefault(str(event.id), {"rows": 0})["done"] = True


def sessions(events: DataFrame, ttl_minutes: int = 60) -> DataFrame:
    """Keyed sessions that end a fixed time after their first event, whatever comes between (reading doesn't refresh them): user_id, start, n.

    Batch form of a time-to-live state. A gap of ttl between neighbours always starts a session, so a user's events are
    first parted where a whole slot of that length is empty; each part goes through in order, a binary search for every session,
    and only the open one is held. Events without a user or a time are left out.
    """
    width = ttl_minutes * 60_000_000
    rows = events.where("user_id is not null and ts is not null").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    rows = rows.withColumn("slot", F.floor(F.col("at") / width))
    before = F.lag("slot").over(Window.partitionBy("user_id").orderBy("slot"))
    slots = rows.select("user_id", "slot").distinct().withColumn("_new", F.coalesce((F.col("slot") - before > 1).cast("int"), F.lit(0)))
    parts = slots.withColumn("part", F.sum("_new").over(Window.partitionBy("user_id").orderBy("slot"))).drop("_new")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, start, n = None, 0, 0
        for batch in batches:
            users, parts, at = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.concatenate(([0], np.flatnonzero((users[1:] != users[:-1]) | (parts[1:] != parts[:-1])) + 1, [len(at)])) if len(at) else [0]
            out = []
            for a, b in zip(cuts, cuts[1:]):
                if (here := (users[a], parts[a])) != key:
                    if n:
                        out.append((key[0], start, n))
                    key, n = here, 0
                while a < b:
                    if not n:
                        start = at[a]
                    end = a + int(np.searchsorted(at[a:b], start + width))
                    n += end - a
                    if end < b:
                        out.append((key[0], start, n))
                        n = 0
                    a = end
            yield made(out)
        if n:
            yield made([(key[0], start, n)])

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], ["user_id", "start", "n"])

    ordered = rows.join(parts, ["user_id", "slot"]).select("user_id", "part", "at").repartition("user_id", "part").sortWithinPartitions("user_id", "part", "at")
    return ordered.mapInArrow(walk, "user_id long, start long, n long").withColumn("start", F.timestamp_micros("start"))


class _Session(StatefulProcessor):
    """The open session of one user; a timer at its end gives it out, as the watermark passes."""

    def __init__(self, width: int):
        self.width = width

    def init(self, handle) -> None:
        self.handle, self.open = handle, handle.getValueState("open", "start long, n long")

    def handleInputRows(self, key, rows, timerValues):
        start, n = self.open.get() if self.open.exists() else (0, 0)
        out = []
        for at in np.sort(np.concatenate([x["at"].to_numpy() for x in rows])):
            if n and at >= start + self.width:
                out.append((key[0], start, n))
                self.handle.deleteTimer(-(-(start + self.width) // 1000))
                n = 0
            if not n:
                start = int(at)
                self.handle.registerTimer(-(-(start + self.width) // 1000))
            n += 1
        self.open.update((start, n))
        yield pd.DataFrame(out, columns=["user_id", "start", "n"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        start, n = self.open.get() if self.open.exists() else (0, 0)
        if n:
            self.open.clear()
            yield pd.DataFrame([(key[0], start, n)], columns=["user_id", "start", "n"])

    def close(self) -> None:
        pass


def session_stream(events: DataFrame, ttl_minutes: int = 60, late: str = "10 minutes") -> DataFrame:
    """Stream form of sessions: events (user_id, ts) to user_id, start, n, each session given once, when the watermark or a later event of its user passes its end.

    The state of a user is its open session alone, and goes with it. An event that comes after a later one of the same
    session counts in it; the first one that comes starts it. Needs the RocksDB state store.
    """
    rows = events.where("user_id is not null and ts is not null").withWatermark("ts", late).select("user_id", "ts", F.unix_micros("ts").alias("at"))
    out = rows.groupBy("user_id").transformWithStateInPandas(_Session(ttl_minutes * 60_000_000), "user_id long, start long, n long", "append", "EventTime")
    return out.withColumn("start", F.timestamp_micros("start"))


def with_state_store(spark: SparkSession, run: Callable[[], object]) -> object:
    """run() with the RocksDB state store that keyed state needs; the session's own setting is put back."""
    key, own = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key, None)
    spark.conf.set(key, own)
    try:
        return run()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
