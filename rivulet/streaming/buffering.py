"""Streaming buffered delivery (K2 + T8/T9): per bucket a checkpointed list-state buffer.

Rows arrive with a ``bucket`` (the sink instance; ``stable_bucket`` gives a stable one) and a
``seq``.  New rows are appended to the bucket's buffer in ``seq`` order (nulls first); every complete
group of ``threshold`` rows is emitted with its group number and removed; the rest stays in state,
survives restarts (checkpoint) and is never emitted without more input.  Deliver the emitted
groups with ``deliver_batches`` (an idempotent ``foreachBatch`` writer).  Rows are handled as pandas
batches, integers beside nulls exactly; the state never holds ``threshold`` rows or more.

**Another number of buckets.**  ``rescaled`` reads the buffers of a stopped query from its checkpoint,
deals the held rows out to the new buckets, and gives (a) the groups that are complete at once
and (b) the rest, which ``buffered_stream(resumed=...)`` takes as its initial state.  Group numbers go on
after the largest one delivered, so a (bucket, group) pair never comes twice.  The new query has a
checkpoint of its own: give it only rows that the old one has not committed (``unread`` for a source of
files; sources with start offsets take them from ``committed_offset``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rivulet.operators.buffering import buffered_groups
from rivulet.session import checkpoint_location
from rivulet.streaming.nullable import integral, joined, split

_POS = "rv_held_pos"


class BufferProcessor(StatefulProcessor):
    def __init__(self, bucket: str, payload: Sequence[str], payload_schema: str, threshold: int, out: str,
                 integers: Sequence[str], first_group: int = 0):
        self.bucket, self.payload, self.integers = bucket, list(payload), list(integers)
        self.payload_schema, self.threshold, self.out, self.first_group = payload_schema, threshold, out, first_group

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffer = handle.getListState("buffer", self.payload_schema)
        self.groups = handle.getValueState("groups", "delivered bigint")

    def _keep(self, rest) -> None:
        import pandas as pd

        if len(rest):
            self.buffer.put([tuple(None if pd.isna(v) else v for v in r) for r in rest.astype(object).itertuples(index=False, name=None)])
        else:
            self.buffer.clear()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        held = initialState.sort_values(_POS, kind="stable")
        self._keep(joined(held, self.payload, self.integers))

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd

        batch = pd.concat(list(rows), ignore_index=True).sort_values(["rv_order_set", "rv_order"], kind="stable", na_position="first")
        batch = joined(batch, self.payload, self.integers)
        held = pd.DataFrame(list(self.buffer.get()) if self.buffer.exists() else [], columns=self.payload, dtype=object)
        for c in self.integers:
            held[c] = held[c].astype("Int64")
        batch = pd.concat([held, batch], ignore_index=True) if len(held) else batch.reset_index(drop=True)
        delivered = self.groups.get()[0] if self.groups.exists() else self.first_group
        full = len(batch) // self.threshold * self.threshold
        self._keep(batch.iloc[full:])  # fewer rows than the threshold
        self.groups.update((int(delivered + full // self.threshold),))
        out = batch.iloc[:full].copy()
        out.insert(0, self.out, delivered + np.arange(full) // self.threshold)
        out.insert(0, self.bucket, [key[0]] * full)
        yield out

    def close(self) -> None:
        pass


@dataclass(frozen=True)
class Rescaled:
    """Buffers dealt out anew: ``ready(bucket, out, *payload)`` can be delivered at once, ``held``
    is the initial state of the next query, whose group numbers start at ``first_group``."""

    ready: DataFrame
    held: DataFrame
    first_group: int


def buffered_stream(df: DataFrame, bucket: str, seq: str, payload: Sequence[str], threshold: int,
                    out: str = "batch_no", resumed: Rescaled | None = None) -> DataFrame:
    """``(bucket, out, *payload)`` rows of complete groups, from ``transformWithStateInPandas``."""
    schema = df.schema
    payload_schema = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in payload)
    out_schema = f"`{bucket}` {schema[bucket].dataType.simpleString()}, `{out}` bigint, {payload_schema}"
    processor = BufferProcessor(bucket, payload, payload_schema, threshold, out, integral(df, payload), resumed.first_group if resumed else 0)
    order = F.col(seq) if not integral(df, [seq]) else F.coalesce(F.col(seq), F.lit(0).cast(schema[seq].dataType))
    rows = df.select(bucket, *split(df, payload), F.col(seq).isNotNull().alias("rv_order_set"), order.alias("rv_order"))
    initial = resumed.held.select(bucket, *split(resumed.held, payload), _POS).groupBy(bucket) if resumed else None
    return rows.groupBy(bucket).transformWithStateInPandas(processor, out_schema, "Append", "None", initialState=initial)


def held_rows(spark: SparkSession, checkpoint: str, bucket: str = "bucket") -> DataFrame:
    """Rows in the buffers of a stopped query: ``(bucket, nth, payload struct)``."""
    state = (spark.read.format("statestore").option("stateVarName", "buffer").option("flattenCollectionTypes", "false")
             .load(checkpoint))
    return state.select(F.col(f"key.{bucket}").alias(bucket), F.posexplode("list_value").alias("nth", "payload"))


def rescaled(spark: SparkSession, checkpoint: str, payload: Sequence[str], threshold: int, rebucket: Column,
             bucket: str = "bucket", out: str = "batch_no") -> Rescaled:
    """The buffers of a stopped query, dealt out by ``rebucket`` (an expression over ``payload``).

    Held rows of one new bucket are ordered by (old bucket, place in its buffer).  The old query must be
    stopped; its state is read as of its last committed batch and written anew under the shared
    checkpoint folder, so the old checkpoint is not needed afterwards."""
    folder = checkpoint_location(spark, "rescaled")
    rows = held_rows(spark, checkpoint, bucket).select(F.col(bucket).alias("_old"), "nth", *[F.col(f"payload.{c}").alias(c) for c in payload])
    rows = _written(rows.withColumn(bucket, rebucket), f"{folder}/rows")
    groups = spark.read.format("statestore").option("stateVarName", "groups").load(checkpoint)
    first = groups.agg(F.max("value.delivered")).first()[0] or 0
    ready = _written(buffered_groups(rows, bucket, ["_old", "nth"], threshold, out), f"{folder}/ready")
    same = rows["_old"].eqNullSafe(ready["_old"]) & (rows["nth"] == ready["nth"])
    # Fewer than ``threshold`` rows a bucket are left.
    place = F.row_number().over(Window.partitionBy(bucket).orderBy("_old", "nth"))
    rest = _written(rows.join(ready, same, "left_anti").select(bucket, *payload, place.alias(_POS)), f"{folder}/held")
    most = ready.agg(F.max(out)).first()[0]
    return Rescaled(ready.select(bucket, (F.col(out) + first).alias(out), *payload), rest, int(first) + (0 if most is None else int(most) + 1))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def committed_offset(spark: SparkSession, checkpoint: str, source: int = 0):
    """The JSON offset of a source up to which a stopped query has committed its input (None if
    it never committed)."""
    root = checkpoint.rstrip("/")
    names = [r[0] for r in spark.read.text(f"{root}/commits").select(F.col("_metadata.file_name")).distinct().collect()]  # batches kept: 100 or so
    last = max((int(n) for n in names if n.isdigit()), default=None)
    if last is None:
        return None
    text = spark.read.text(f"{root}/offsets/{last}", wholetext=True).first()[0]
    return json.loads(text.splitlines()[2 + source])


def unread(df: DataFrame, checkpoint: str, source: int = 0) -> DataFrame:
    """Rows of a stream of files that the query of ``checkpoint`` has not committed: files that its source
    log assigns to a committed offset are left out."""
    spark = df.sparkSession
    done = committed_offset(spark, checkpoint, source)
    if done is None:
        return df
    plain = lambda path: F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")  # noqa: E731  file:///a and file:/a are one file
    entry = F.from_json("value", "path string, batchId bigint")
    log = spark.read.text(f"{checkpoint.rstrip('/')}/sources/{source}").select(entry.alias("e")).select("e.*")
    read = log.where(F.col("path").isNotNull() & (F.col("batchId") <= done["logOffset"])).select(plain(F.col("path")).alias("_read_path")).distinct()
    placed = df.select("*", plain(F.col("_metadata.file_path")).alias("_from_path"))
    return placed.join(read, F.col("_from_path") == F.col("_read_path"), "left_anti").drop("_from_path")
