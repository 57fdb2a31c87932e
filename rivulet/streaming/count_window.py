"""Streaming count-window average (A3 + T6/T7): keyed value state ``(count, sum)`` with TTL.

Per key the state starts empty; each value (in ``seq`` order within a micro-batch, nulls first) adds to it;
at ``n`` values the processor emits ``(key, sum div count)`` and clears the state.  With
``ttl_ms`` the state expires ``ttl_ms`` after its last write (processing time; Spark judges
expiry per micro-batch, so values of one micro-batch never expire each other; ``expiry`` judges every
value by its own time).

Spark keeps no arrival order, so input rows carry ``seq``.  A key's rows of a micro-batch come as
Arrow batches and are sorted and summed as arrays (inherent to keyed state: in one task; the
trigger size -- ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` -- bounds them).  A null value
fails the query, as in the batch twin.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rivulet.streaming.nullable import integral

_STATE_SCHEMA = "cnt bigint, total bigint"


class CountWindowProcessor(StatefulProcessor):
    def __init__(self, key: str, value: str, n: int, ttl_ms: int | None, out: str):
        self.key_name, self.value, self.n, self.ttl_ms, self.out = key, value, n, ttl_ms, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("count_sum", _STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import numpy as np
        import pandas as pd

        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(["rv_order_set", "rv_order"], kind="stable", na_position="first")
        values = batch[self.value].to_numpy(dtype=np.int64)
        cnt, total = self.state.get() if self.state.exists() else (0, 0)
        # The state's values stand before the first window as one value and cnt - 1 zeros.
        values = np.concatenate([np.array([total] + [0] * (cnt - 1), dtype=np.int64)[:cnt], values])
        full = len(values) // self.n * self.n
        sums = values[:full].reshape(-1, self.n).sum(axis=1)
        rest = values[full:]
        if len(rest):
            self.state.update((len(rest), int(rest.sum())))
        else:
            self.state.clear()
        means = np.sign(sums) * (np.abs(sums) // self.n)  # truncates toward zero
        yield pd.DataFrame({self.key_name: pd.Series([key[0]] * len(means), dtype=object if key[0] is None else None), self.out: means})

    def close(self) -> None:
        pass


def count_window_stream(df: DataFrame, key: str, value: str, seq: str, n: int = 2,
                        ttl_ms: int | None = None, out: str = "avg") -> DataFrame:
    """Streaming (or batch) ``(key, out)`` rows from ``transformWithStateInPandas``; append mode."""
    key_type = df.schema[key].dataType.simpleString()
    processor = CountWindowProcessor(key, value, n, ttl_ms, out)
    checked = F.coalesce(F.col(value).cast("bigint"), F.raise_error(F.lit(f"null in {value}")).cast("bigint"))
    order = F.col(seq) if not integral(df, [seq]) else F.coalesce(F.col(seq), F.lit(0).cast(df.schema[seq].dataType))
    rows = df.select(key, checked.alias(value), F.col(seq).isNotNull().alias("rv_order_set"), order.alias("rv_order"))
    return rows.groupBy(key).transformWithStateInPandas(
        processor, f"{key} {key_type}, {out} bigint", "Append",
        "ProcessingTime" if ttl_ms else "None")
