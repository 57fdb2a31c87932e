"""Broadcast behind a measured size in bytes.

Without table statistics Spark cannot size a derived table (an aggregate over a join is
estimated as the join's cartesian bound), so it plans a shuffle join and moves the big side.
``broadcast_if_small`` measures the candidate instead: one aggregation over the *small* side
sums the bytes of its rows as text.  Up to the limit the frame is returned with a broadcast
hint, beyond it unchanged -- Spark (AQE) then chooses the join from measured shuffle sizes and
splits skewed partitions.

The limit is ``rivulet.broadcast.maxBytes`` (session conf, default 32 MB).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BYTES_CONF = "rivulet.broadcast.maxBytes"
DEFAULT_MAX_BYTES = 32 << 20
ROW_BYTES = 64  # what a row costs in a hash table besides its values


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows: their values as JSON text plus a fixed cost per row."""
    row = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    return int(df.agg(F.coalesce(F.sum(row + ROW_BYTES), F.lit(0))).first()[0])


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``(frame, broadcast?)``.  Use only on a side that is cheap to compute twice (the measure
    and the join each evaluate it) -- never on a side that calls an external service."""
    limit = max_bytes or int(df.sparkSession.conf.get(MAX_BYTES_CONF, str(DEFAULT_MAX_BYTES)))
    if df.isStreaming:
        return df, False
    return (F.broadcast(df), True) if measured_bytes(df) <= limit else (df, False)
