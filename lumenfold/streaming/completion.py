"""Jobs that wait for files: completion of a set of chunks as a stream of arrivals, with deadlines."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lumenfold.functions.names import last_number

REPORTS = "job string, status string, arrived long, missing long, at timestamp"


def arrivals(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Stream of (chunk, path, at) of files that appear in a folder; each file counts once (the source's own log)."""
    s = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).load(path)
    return s.select(last_number(F.regexp_extract("path", r"([^/]*)$", 1)).alias("chunk"), "path", F.col("modificationTime").alias("at"))


def progress(stream: DataFrame, key: str = "chunk") -> DataFrame:
    """First arrival of every chunk: later copies are dropped by the state."""
    return stream.dropDuplicates([key])


def drain(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """What has arrived so far into a Parquet folder, exactly once over restarts."""
    q = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()


def track(stream: DataFrame, sink: str, checkpoint: str) -> None:
    drain(progress(stream), sink, checkpoint)


def is_complete(expected: DataFrame, done: DataFrame, key: str = "chunk") -> bool:
    return expected.join(done.select(key), key, "left_anti").isEmpty()


class Deadline(StatefulProcessor):
    """A job's chunks against its deadline, which starts with the first of them. State: the first arrival of each chunk, the
    deadline, and whether the job was reported. A job's arrivals are one value, read and written once a call, as every access to the
    state is a message to the store."""

    def __init__(self, expected: int, limit_ms: int):
        self.expected, self.limit = expected, limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("arrivals", "chunks string")
        self.due = handle.getValueState("due", "at long")
        self.said = handle.getValueState("said", "done boolean")

    def arrived(self) -> dict[int, int]:
        """First arrival of every chunk so far."""
        value = self.first.get()
        return dict(json.loads(value[0])) if value else {}

    def report(self, key: tuple, status: str, in_time: int, at: int) -> pd.DataFrame:
        return pd.DataFrame({"job": [key[0]], "status": [status], "arrived": [in_time], "missing": [self.expected - in_time], "at": [pd.Timestamp(at, unit="ms")]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        said = self.said.exists()
        first = {} if said else self.arrived()
        known = dict(first)
        for b in rows:
            if said:
                continue
            for chunk, at in zip(b.chunk.tolist(), b.at_ms.tolist(), strict=True):
                if chunk is not None and chunk == chunk and at < first.get(int(chunk), float("inf")):
                    first[int(chunk)] = int(at)
        if said or not first:
            return
        times = sorted(first.values())
        due = times[0] + self.limit
        value = self.due.get() if known else None  # a deadline comes with the first arrival
        before = value[0] if value else None
        if len(times) >= self.expected and times[self.expected - 1] <= due:
            if before is not None:
                self.handle.deleteTimer(before)
            yield self.finish(key, "complete", times, times[self.expected - 1])
            return
        if first != known:
            self.first.update((json.dumps(list(first.items())),))
        if before != due:  # an arrival from before the first one moves the deadline
            if before is not None:
                self.handle.deleteTimer(before)
            self.due.update((due,))
            self.handle.registerTimer(due)

    def finish(self, key: tuple, status: str, times: list[int], at: int) -> pd.DataFrame:
        in_time = sum(t <= times[0] + self.limit for t in times)
        self.said.update((True,))
        self.first.clear()
        return self.report(key, status, min(in_time, self.expected), at)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if not self.said.exists():
            yield self.finish(key, "late", sorted(self.arrived().values()), expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass


def watch(stream: DataFrame, expected: int, limit: str, delay: str = "10 minutes") -> DataFrame:
    """One row per job that is complete (as soon as it is; at: its last chunk) or late (once time has passed its deadline; at: the
    deadline): job, status, arrived and missing (chunks in time), at. stream: job, chunk, at (timestamp). A job has `expected`
    different chunks, due within `limit` of its first; arrivals count by their own time, whatever order they come in, as far as
    `delay` behind the latest. State is kept by key in the state store, so a restart goes on with the same deadlines; needs a
    store with timers, which this sets for the session."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    ms = spark.sql(f"SELECT unix_millis(timestamp'1970-01-01 00:00:00Z' + interval {limit}) v").first()[0]
    d = stream.select(F.col("job").cast("string").alias("job"), F.col("chunk").cast("long").alias("chunk"), F.col("at").cast("timestamp").alias("at"), F.unix_millis(F.col("at").cast("timestamp")).alias("at_ms"))
    return d.withWatermark("at", delay).groupBy("job").transformWithStateInPandas(Deadline(expected, ms), REPORTS, "append", "eventTime")
