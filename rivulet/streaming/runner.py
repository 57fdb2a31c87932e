"""Starting, driving and stopping streaming queries; sinks (K1 print, K2 delivery, K3 append)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivulet.session import checkpoint_location


def start(df: DataFrame, name: str, mode: str = "append", sink: str = "memory",
          trigger: dict | None = None, checkpoint: str | None = None, **options) -> StreamingQuery:
    """Start ``df`` into ``sink`` (``memory`` registers table ``name``; ``console`` prints).

    The checkpoint goes under the shared ``spark.checkpoint.dir`` unless given; reusing a
    checkpoint restarts the query where it stopped (offsets, state and commits)."""
    spark = df.sparkSession
    writer = (df.writeStream.format(sink).outputMode(mode).queryName(name)
              .option("checkpointLocation", checkpoint or checkpoint_location(spark, name)))
    for k, v in options.items():
        writer = writer.option(k, v)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_available(df: DataFrame, name: str, mode: str = "append", timeout_s: float = 120,
                  checkpoint: str | None = None) -> DataFrame:
    """Process everything available now into a memory table and return it (bounded wait)."""
    q = start(df, name, mode, trigger={"availableNow": True}, checkpoint=checkpoint)
    try:
        if not q.awaitTermination(timeout_s):
            raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    finally:
        q.stop()
    return df.sparkSession.table(name)


def deliver_batches(df: DataFrame, path: str, name: str, checkpoint: str | None = None,
                    trigger: dict | None = None) -> StreamingQuery:
    """K2 delivery: write each micro-batch's complete groups to ``path/batch_id=<id>``.

    Overwriting the batch's own folder makes a replayed batch idempotent (exactly-once output
    together with the checkpointed state)."""
    spark: SparkSession = df.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    writer = (df.writeStream.foreachBatch(write).queryName(name)
              .option("checkpointLocation", checkpoint or checkpoint_location(spark, name)))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def drain(query: StreamingQuery, timeout_s: float = 120) -> None:
    """``processAllAvailable`` with a deadline: on timeout the query is stopped and an error
    raised (a stateful query in processing-time mode may otherwise keep running empty batches)."""
    import threading

    errors: list = []

    def wait():
        try:
            query.processAllAvailable()
        except Exception as e:  # surfaced below
            errors.append(e)

    t = threading.Thread(target=wait, daemon=True)
    t.start()
    t.join(timeout_s)
    if t.is_alive():
        query.stop()
        raise TimeoutError(f"stream {query.name} still busy after {timeout_s}s")
    if errors:
        raise errors[0]


def asof_join_batches(probe_stream: DataFrame, versions: DataFrame, keys, probe_time: str,
                      version_time: str, version_cols, path: str, name: str, how: str = "inner",
                      checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """J4 on a stream: every micro-batch of probes is as-of joined (``asof_join``) with the
    versions of its keys and written to ``path/batch_id=<id>`` (overwrite per batch: a replayed
    batch rewrites the same folder).

    ``versions`` is a frame, or a function that returns one: it is called for each batch, so
    a table whose files change is listed anew.  Only versions of the batch's keys are scanned
    further (a semi-join before the shuffle)."""
    from rivulet.operators.temporal import asof_join

    spark: SparkSession = probe_stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        table = versions() if callable(versions) else versions
        table = table.join(batch.select(*keys).distinct(), list(keys), "left_semi")
        joined = asof_join(batch, table, keys, probe_time, version_time, version_cols, how=how)
        joined.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    writer = (probe_stream.writeStream.foreachBatch(write).queryName(name)
              .option("checkpointLocation", checkpoint or checkpoint_location(spark, name)))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
