"""Counter source (S3): every parallel instance (``subtask``) emits 0, 1, 2, ... (``value``).

The bounded form is ``spark.range``.  The stream is a Python data source whose reader fills Arrow
batches (no per-row Python) and keeps one offset per subtask in the checkpointed offset log, so a
restarted query continues where the last committed batch ended and every value is emitted
exactly once per subtask, also when it is restarted with another number of subtasks.

Options: ``subtasks`` (default 1), ``rows_per_batch`` (values per subtask and micro-batch, default 1000).
"""

from __future__ import annotations

from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SOURCE_NAME = "rivulet_counter"
SCHEMA = "subtask int, value bigint"
_ARROW_ROWS = 1 << 16


class CounterRange(InputPartition):
    def __init__(self, subtask: int, start: int, end: int):
        super().__init__((subtask, start, end))
        self.subtask, self.start, self.end = subtask, start, end


def _emit(part: CounterRange):
    import numpy as np
    import pyarrow as pa

    for lo in range(part.start, part.end, _ARROW_ROWS):
        hi = min(lo + _ARROW_ROWS, part.end)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(hi - lo, part.subtask, dtype=np.int32)), pa.array(np.arange(lo, hi, dtype=np.int64))],
            names=["subtask", "value"])


class CounterStreamReader(DataSourceStreamReader):
    """Offsets are a list with one next value per subtask.

    The list only ever grows: a restart with more subtasks starts the new ones at 0, a restart with fewer
    keeps the places of those that are gone, so that they go on there if they come back."""

    def __init__(self, options):
        self.subtasks = int(options.get("subtasks", 1))
        self.step = int(options.get("rows_per_batch", 1000))
        self.pos = [0] * self.subtasks

    def initialOffset(self):
        return {"next": [0] * self.subtasks}

    def latestOffset(self):
        self.pos = [p + self.step * (i < self.subtasks) for i, p in enumerate(self.pos)]
        return {"next": list(self.pos)}

    def partitions(self, start, end):
        # After a restart Spark replays from the offset log; move our position up to it so
        # that the next latestOffset() continues after the last planned batch.
        self.pos = [max(p, e) for p, e in zip_longest(self.pos, end["next"], fillvalue=0)]
        # A planned batch is replayed as it was planned, for the subtasks of that time.
        ranges = enumerate(zip_longest(start["next"], end["next"], fillvalue=0))
        return [CounterRange(i, s, e) for i, (s, e) in ranges if e > s] or [CounterRange(0, 0, 0)]

    def read(self, partition):
        yield from _emit(partition)

    def commit(self, end):
        pass


class CounterDataSource(DataSource):
    @classmethod
    def name(cls):
        return SOURCE_NAME

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        return CounterStreamReader(self.options)


def register_counter(spark: SparkSession) -> None:
    spark.dataSource.register(CounterDataSource)


def counter_frame(spark: SparkSession, subtasks: int, count: int) -> DataFrame:
    """Bounded counter: ``subtasks`` instances, each emitting ``0 .. count-1`` (``spark.range``)."""
    if subtasks < 1 or count < 0:
        raise ValueError("subtasks must be at least 1 and count not negative")
    ids = spark.range(subtasks * count)
    return ids.select((F.col("id") % subtasks).cast("int").alias("subtask"),
                      F.call_function("div", F.col("id"), F.lit(subtasks).cast("bigint")).alias("value"))


def counter_stream(spark: SparkSession, subtasks: int, rows_per_batch: int = 1000) -> DataFrame:
    """Unbounded counter stream (restartable from its checkpoint)."""
    register_counter(spark)
    return (spark.readStream.format(SOURCE_NAME).option("subtasks", subtasks)
            .option("rows_per_batch", rows_per_batch).load())
