"""Buffered delivery (K2): elements are delivered in complete groups of ``threshold``.

Reference behaviour: each sink instance appends elements to a buffer; when the buffer holds
exactly ``threshold`` elements they are delivered together and the buffer is cleared.  The
remainder (fewer than ``threshold``) stays buffered and is not delivered at end of input.

Batch twin: per bucket (a sink instance) number the elements in arrival order (skew-safe, see
``keyed_scan``; a bucket is by nature a hot key), keep the first ``floor(total / threshold) *
threshold`` and label them with their group number ``(rn - 1) div threshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.keyed_scan import drop_scan_columns, keyed_sequence


def stable_bucket(cols: Sequence[str], buckets: int) -> Column:
    """Deterministic bucket ``0..buckets-1`` of a row (stable across runs and restarts)."""
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def buffered_groups(df: DataFrame, bucket: str, order: Sequence[str], threshold: int,
                    out: str = "batch_no", chunk_rows: int | None = None) -> DataFrame:
    """Rows that are delivered, with ``out`` = 0-based group number within their bucket.  Arrival
    order is ascending with nulls first."""
    if threshold < 1:
        raise ValueError("threshold must be >= 1")
    seq = drop_scan_columns(keyed_sequence(df, [bucket], order, total="_total", chunk_rows=chunk_rows))
    n = F.lit(threshold).cast("bigint")
    delivered = F.col("rn") <= F.call_function("div", F.col("_total"), n) * n  # integer math throughout
    return (seq.where(delivered)
            .withColumn(out, F.call_function("div", F.col("rn") - 1, n))
            .drop("rn", "_total"))
