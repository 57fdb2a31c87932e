"""Tumbling-window aggregates for batch and streaming frames.

On a stream the caller declares the watermark first (``withWatermark``); Spark's ``window``
then lets it keep one partial aggregate per open (window, key) in the state store and emit a
window when the watermark passes its end (append) or on every trigger (update / complete).

On a batch frame the window start is computed with integer arithmetic on epoch microseconds
(the same epoch-aligned buckets ``window`` gives) and rows without a time are dropped after the
aggregate.  ``window`` itself adds an ``isnotnull(time)`` filter that Catalyst pushes down to
the scan by inlining the whole time expression -- for a parsed time that parses every row twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.parse import duration_us


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _group_window(df: DataFrame, time_col: str, size: str):
    """(grouping column, start column, timed-rows aggregate or None) for a tumbling window.

    Batch: groups whose rows all lack a time are dropped by ``count(time) > 0`` on the
    aggregate output -- a predicate on an aggregate value, which Catalyst cannot push below
    the aggregate (a null test on the grouping key would be pushed down and inlined)."""
    if df.isStreaming:
        return F.window(time_col, size).alias("w"), F.col("w.start"), None
    us = duration_us(size)
    dtype = df.schema[time_col].dataType.simpleString()
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    start = F.timestamp_micros(micros - F.pmod(micros, F.lit(us))).cast(dtype)
    return start.alias("w"), F.col("w"), F.count(time_col).alias("_timed")


def tumble_count(df: DataFrame, time_col: str, key_col: str, size: str,
                 counted: str | None = None, out_count: str = "cnt",
                 out_start: str = "start_time") -> DataFrame:
    """Per key and tumbling window: ``count(counted)`` (nulls not counted) and the window start.

    ``counted`` defaults to the key, as in ``count(user_name)``: a null-key group still gives a
    row, with count 0.
    """
    counted = counted or key_col
    group, start, timed = _group_window(df, time_col, size)
    aggs = [F.count(F.col(counted)).alias(out_count)] + ([timed] if timed is not None else [])
    agg = df.groupBy(group, F.col(key_col)).agg(*aggs)
    if timed is not None:
        agg = agg.where(F.col("_timed") > 0)
    return agg.select(key_col, out_count, start.alias(out_start))


def tumble_sum(df: DataFrame, time_col: str, key_col: str, value_col: str, size: str,
               out_sum: str = "n", out_start: str | None = "start_time",
               result_type: str | None = "int") -> DataFrame:
    """Per key and tumbling window: ``sum(value)`` (``keyBy(0).timeWindow(size).sum(1)``).

    ``result_type`` keeps the input's integer width (``int`` like the reference's tuple field);
    ANSI mode makes an overflow fail instead of wrapping.  ``out_start=None`` drops the window
    column, like the reference's ``(word, sum)`` output.
    """
    total = F.sum(value_col)
    if result_type:
        total = total.cast(result_type)
    group, start, timed = _group_window(df, time_col, size)
    aggs = [total.alias(out_sum)] + ([timed] if timed is not None else [])
    agg = df.groupBy(group, F.col(key_col)).agg(*aggs)
    if timed is not None:
        agg = agg.where(F.col("_timed") > 0)
    cols = [key_col]
    if out_start:
        cols.append(start.alias(out_start))
    return agg.select(*cols, out_sum)


def processing_time(df: DataFrame, out: str = "proc_time") -> DataFrame:
    """Stamp rows with the micro-batch's processing time (for processing-time windows)."""
    return df.withColumn(out, F.current_timestamp())
