"""Per-key count windows (A3): every ``n`` consecutive values of a key give one integer average.

Reference behaviour: per key a state ``(count, sum)`` starts at ``(0, 0)``; each value adds to
it; when the count reaches ``n`` the job emits ``(key, sum / count)`` with integer division
(truncating toward zero) and clears the state.  A trailing incomplete window emits nothing.
With a state TTL, a value older than the TTL reads as the empty state, so a gap of at least
``ttl`` between two consecutive values of a key starts a new run of windows.

Batch twin (this module): order within the key is explicit (``order`` columns, ties broken by
them).  Window ``w`` of a run holds run positions ``w*n+1 .. w*n+n``.  The positions come from
``keyed_scan`` (skew-safe); the windows are then a plain ``groupBy`` with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.parse import duration_us
from rivulet.operators.keyed_scan import KEY, keyed_runs, keyed_sequence


def count_window_average(df: DataFrame, key: str, value: str, order: Sequence[str], n: int = 2,
                         ttl: str | None = None, time_col: str | None = None,
                         out: str = "avg", chunk_rows: int | None = None) -> DataFrame:
    """``(key, [run_no,] win_no, out)``: one row per complete window of ``n`` values.

    ``ttl`` (e.g. ``'1 second'``, ``'6 hours'``) with ``time_col`` (timestamp) applies state
    expiry on that clock: a value whose gap to the key's previous value is ``>= ttl`` finds the
    state expired.  ``run_no`` (1-based) is then part of the output.  ``chunk_rows`` sets the row
    target of the splitting of long keys (see ``keyed_scan``; results do not depend on it).

    Order is ascending with nulls first.  A null value fails the query, as it fails the stream.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    if ttl is not None and time_col is None:
        raise ValueError("ttl needs time_col")
    cols = [key, value] + [c for c in order if c not in (key, value)]
    if time_col and time_col not in cols:
        cols.append(time_col)
    base = df.select(*cols)
    checked = F.coalesce(F.col(value), F.raise_error(F.lit(f"null in {value}")).cast(df.schema[value].dataType))
    base = base.withColumn(value, checked)
    if ttl is None:
        seq = keyed_sequence(base, [key], order, chunk_rows=chunk_rows)
        pos, runs = F.col("rn"), []
    else:
        seq = keyed_runs(base, [key], order, time_col, duration_us(ttl), chunk_rows=chunk_rows)
        pos, runs = F.col("run_rn"), ["run_no"]
    # Windows may reach over a chunk's end, so they are summed by key: map-side combine first.
    windows = seq.withColumn("win_no", _int_div(pos - 1, F.lit(n)).cast("bigint"))
    agg = (windows.groupBy(KEY, *runs, "win_no")
           .agg(F.count(F.lit(1)).alias("_c"), F.sum(value).alias("_s")))
    return (agg.where(F.col("_c") == n)
            .select(F.col(KEY)[key].alias(key), *runs, "win_no", _int_div(F.col("_s"), F.col("_c")).alias(out)))


def _int_div(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero, like Java's ``long / long`` (SQL ``div``)."""
    return F.call_function("div", a, b)
