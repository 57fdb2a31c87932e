"""Tumbling sums by the clock (A1/T1): processing-time windows that close without further input.

A row belongs to the window of the micro-batch time at which it is taken.  The sum of each (key, window) is
kept in map state with a processing-time timer at the window's end; when the clock passes it, the sum is
emitted once and removed.  Rows are summed per task and Arrow batch before they are dealt out by
key, so a very frequent key costs a few rows per task.

Spark runs timers only within a batch, and a query that was stopped between two batches starts none until
new rows come.  A second source that ticks once a second (and adds no row) makes sure of a batch, so
windows left open by a stopped query close after its restart.  The checkpoint holds both sources: one
that was written without the ticks cannot be continued.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rivulet.functions.parse import duration_us


class ClockWindows(StatefulProcessor):
    def __init__(self, key: str, size_ms: int):
        self.key_name, self.size_ms = key, size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", "start bigint", "total bigint")

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.size_ms
        total = sum(int(x) for batch in rows for x in batch["total"])
        before = self.sums.getValue((start,))[0] if self.sums.containsKey((start,)) else 0
        self.sums.updateValue((start,), (before + total,))
        self.handle.registerTimer(start + self.size_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        start = expiredTimerInfo.getExpiryTimeInMs() - self.size_ms
        if self.sums.containsKey((start,)):
            total = self.sums.getValue((start,))[0]
            self.sums.removeKey((start,))
            keys = pd.Series([key[0]], dtype=object)
            yield pd.DataFrame({self.key_name: keys, "start": [start], "total": [total]})

    def close(self) -> None:
        pass


def _partial_sums(batches):
    """``(key, value)`` -> sums per key of a batch; null values count as nothing."""
    import pyarrow as pa

    for batch in batches:
        summed = pa.Table.from_batches([batch]).group_by(batch.schema.names[0]).aggregate([("total", "sum")])
        yield from summed.select([batch.schema.names[0], "total_sum"]).rename_columns([batch.schema.names[0], "total"]).to_batches()


def _ticks(df: DataFrame, schema) -> DataFrame:
    """A stream of no rows that has new offsets every second; its values start at 0, so the filter drops all."""
    rate = df.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    return rate.where("value < 0").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def clock_tumble_sum(df: DataFrame, key: str, value: str, size: str, out_sum: str = "n", out_start: str = "start_time",
                     result_type: str = "int") -> DataFrame:
    """Per key and processing-time window of a stream: ``(key, out_start, out_sum)``, append mode.

    The window's length is a whole number of milliseconds; under ANSI mode a sum beyond ``result_type``
    fails.  A window whose values are all null sums to 0."""
    size_us = duration_us(size)
    if size_us % 1000 or size_us <= 0:
        raise ValueError("the window must be a positive whole number of milliseconds")
    key_type = df.schema[key].dataType.simpleString()
    rows = df.select(key, F.coalesce(F.col(value).cast("bigint"), F.lit(0)).alias("total"))
    summed = rows.mapInArrow(_partial_sums, f"`{key}` {key_type}, total bigint")
    if df.isStreaming:
        summed = summed.union(_ticks(df, summed.schema))
    windows = summed.groupBy(key).transformWithStateInPandas(
        ClockWindows(key, size_us // 1000), f"`{key}` {key_type}, start bigint, total bigint", "Append", "ProcessingTime")
    return windows.select(key, F.timestamp_millis("start").alias(out_start), F.col("total").cast(result_type).alias(out_sum))
