"""Single-row lookup enrichment.

* ``lookup_json``: the set-based form.  The lookup table is cut to one row per key first (a
  partial + final aggregate, so duplicate or hot keys cost nothing extra), then left-joined to
  the input: exactly one output per input row.  The cut table is broadcast when its measured
  bytes are under the limit (``sizing.broadcast_if_small``) -- the input is then never
  shuffled; above it Spark chooses the join and splits skew.  On a stream the table is joined
  without a hint, so that each micro-batch's own plan decides.
* ``async_lookup``: a call per distinct key to an external client, concurrently from a set
  number of tasks, with a per-call timeout and a bound on calls in flight; results are joined
  back, so again one output per input row.  Output order is not kept.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rivulet.functions.json import json_or
from rivulet.operators.sizing import broadcast_if_small


def first_per_key(table: DataFrame, key: str, fields: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``(key, _rec)``: one record struct of ``fields`` per key -- the first by ``order``, or
    the smallest record when no order is given (the reference takes an unspecified first row)."""
    rec = F.struct(*[F.col(f) for f in fields])
    pick = F.min_by(rec, F.struct(*[F.col(o) for o in order])) if order else F.min(rec)
    return table.groupBy(key).agg(pick.alias("_rec"))


def lookup_json(df: DataFrame, key_col: str, table: DataFrame, table_key: str, fields: Sequence[str],
                out: str = "info", miss: str = "{}", order: Sequence[str] = ()) -> DataFrame:
    """Add ``out``: compact JSON ``{"f1":...,"f2":...}`` of the key's first table row (null
    fields kept as ``null``), or the literal ``miss`` when the key has no row."""
    dim = first_per_key(table, table_key, fields, order).withColumnRenamed(table_key, "_dk")
    if not df.isStreaming:
        dim, _ = broadcast_if_small(dim)
    joined = df.join(dim, df[key_col] == dim["_dk"], "left")
    return joined.select(*[df[c] for c in df.columns],
                         json_or(F.col("_rec"), F.col("_dk").isNotNull(), miss).alias(out))


def lookup_or_timeout(df: DataFrame, key_col: str, table: DataFrame, table_key: str,
                      fields: Sequence[str], out: str = "info") -> DataFrame:
    """The callback client's behaviour: a key with no row never answers, so it times out."""
    return lookup_json(df, key_col, table, table_key, fields, out=out, miss="timeout")


# --- bounded concurrent calls -----------------------------------------------------------------

def _call_batches(batches, out_schema, client_factory: Callable, timeout_s: float,
                  capacity: int, workers: int, timeout_value: str):
    """Per task: one client, one thread pool and one window of at most ``capacity`` calls in flight,
    which slides on over the borders of Arrow batches: while calls of one batch are out, those of
    the next are sent, so a slow call holds back only its own batch and those behind it in the output.
    Per batch one call per distinct non-null key (in ``_async_key``), as a plain Python value, each answered
    or timed out ``timeout_s`` after submission; a null key is never sent, its answer is null.
    Batches come out in order; one is read ahead only when all keys before it are sent, so at
    most ``capacity`` + 1 batches are held."""
    import pyarrow as pa

    client = client_factory()
    pool = ThreadPoolExecutor(max_workers=workers)
    held: deque = deque()  # (batch, its keys, answers so far, number of answers to come)
    inflight: dict = {}  # future -> (key, deadline, entry of held)

    def settle(until_below: int):
        """Take answers until fewer than ``until_below`` calls are in flight or the first batch is whole."""
        while len(inflight) >= until_below and held[0]["open"]:
            earliest = min(deadline for _, deadline, _ in inflight.values())
            done, _ = wait(list(inflight), timeout=max(0.0, earliest - time.monotonic()), return_when=FIRST_COMPLETED)
            now = time.monotonic()
            for fut, (key, deadline, entry) in list(inflight.items()):
                if fut in done or deadline <= now:  # abandoned: a Python thread cannot be stopped
                    inflight.pop(fut)
                    # a failing call fails the task (Spark retries it)
                    entry["answers"][key] = fut.result() if fut in done else timeout_value
                    entry["open"] -= 1

    def finished():
        while held and not held[0]["open"]:
            entry = held.popleft()
            batch = entry["batch"]
            columns = [batch.column(n) for n in batch.schema.names if n != "_async_key"]
            columns.append(pa.array([entry["answers"][k] for k in entry["asked"]], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=out_schema)

    try:
        for batch in batches:
            asked = batch.column("_async_key").to_pylist()
            keys = list(dict.fromkeys(k for k in asked if k is not None))
            entry = {"batch": batch, "asked": asked, "answers": {None: None}, "open": len(keys)}
            held.append(entry)
            for key in keys:
                while len(inflight) >= capacity:
                    settle(capacity)
                    yield from finished()
                inflight[pool.submit(client, key)] = (key, time.monotonic() + timeout_s, entry)
            yield from finished()
        while held:
            settle(1)
            yield from finished()
    finally:
        pool.shutdown(wait=False, cancel_futures=True)
        close = getattr(client, "close", None)
        if close:
            close()


def async_lookup(df: DataFrame, key_col: str, client_factory: Callable[[], Callable], out: str = "info",
                 timeout_ms: int = 1000, capacity: int = 100, workers: int = 30,
                 timeout_value: str = "timeout", tasks: int | None = None) -> DataFrame:
    """Add ``out`` = ``client(key)`` (a string); null for a null key, which is never sent.

    ``client_factory`` runs once per task (open a connection there) and returns a callable;
    a ``close()`` on it is called at the end.  Keys arrive as plain Python values of their
    column's type.  Per task at most ``capacity`` calls are in flight on ``workers`` threads; a
    call not answered ``timeout_ms`` after submission yields ``timeout_value``.  A timed-out
    call is abandoned, not stopped (Python threads cannot be killed): it keeps its worker thread
    until it returns, so size ``workers`` above the number of calls expected to hang.

    Batch input: the service is called once per distinct key, from ``tasks`` tasks (default: the
    shuffle partitions; a fixed number, so AQE does not merge the few bytes of keys into one),
    and the answers are joined back.  Nothing runs before the result is used.  The answers are
    part of the plan: a retry of a later stage reads their shuffle, and calls again only for
    lost tasks.  Streaming input: each micro-batch is handled in place (stateless), one call
    per distinct key of each Arrow batch, with one window of calls in flight per task.
    """
    key = F.col(key_col)

    def run_with(names):
        def run(batches):
            return _call_batches(batches, names, client_factory, timeout_ms / 1000.0, capacity, workers, timeout_value)
        return run

    if df.isStreaming:
        names = [*df.columns, out]
        shape = StructType(df.schema.fields + [StructField(out, StringType())])
        return df.withColumn("_async_key", key).mapInArrow(run_with(names), shape)

    n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.where(key.isNotNull()).select(key.alias("_ak")).distinct().repartition(n, "_ak")
    answer_shape = StructType([StructField("_ak", df.schema[key_col].dataType), StructField(out, StringType())])
    answers = keys.withColumn("_async_key", F.col("_ak")).mapInArrow(run_with(["_ak", out]), answer_shape)
    joined = df.join(answers, df[key_col] == answers["_ak"], "left")
    return joined.select(*[df[c] for c in df.columns], answers[out])
