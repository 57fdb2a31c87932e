"""A streaming sink with commit and abort (K2/U6): format ``rivulet_groups``.

Tasks write Arrow batches to part files under ``<path>/_parts``.  When all tasks of a batch are done, the driver
writes one record, ``<path>/_commits/<batch id>.json``, that lists the batch's part files; it is moved into
place whole.  ``read_committed`` reads only listed files, so no reader sees an aborted or half-written batch.
A batch that is replayed after its record was written leaves the record as it is and removes its new
parts: every batch counts once.  An aborted batch removes the parts it knows of; parts of tasks that
died unseen are never listed and can be removed by ``remove_orphans`` while no query writes.

The folder must be shared by driver and executors.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rivulet.session import checkpoint_location
from rivulet.sources.files import open_store

FORMAT = "rivulet_groups"


@dataclass
class Part(WriterCommitMessage):
    """A task's file (empty: it had no rows) and its rows."""

    name: str
    rows: int


class GroupWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator):
        import pyarrow.parquet as pq

        store, root = open_store(self.path)
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if batch.num_rows:
                    if out is None:
                        store.create_dir(f"{root}/_parts", recursive=True)
                        out = pq.ParquetWriter(f"{root}/_parts/{name}", batch.schema, filesystem=store)
                    out.write_batch(batch)
                    rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Part(name if rows else "", rows)

    def commit(self, messages: Sequence[Part | None], batchId: int) -> None:
        store, root = open_store(self.path)
        record = f"{root}/_commits/{batchId}.json"
        if _exists(store, record):
            self.abort(messages, batchId)
            return
        store.create_dir(f"{root}/_commits", recursive=True)
        parts = [m for m in messages if m is not None and m.rows]
        waiting = f"{root}/_commits/.{batchId}.{uuid.uuid4().hex}"
        with store.open_output_stream(waiting) as f:
            f.write(json.dumps({"batch": batchId, "rows": sum(m.rows for m in parts), "parts": [m.name for m in parts]}).encode())
        store.move(waiting, record)

    def abort(self, messages: Sequence[Part | None], batchId: int) -> None:
        store, root = open_store(self.path)
        for m in messages:
            if m is not None and m.rows and _exists(store, f"{root}/_parts/{m.name}"):
                store.delete_file(f"{root}/_parts/{m.name}")


def _exists(store, path: str) -> bool:
    from pyarrow import fs

    return store.get_file_info(path).type != fs.FileType.NotFound


class GroupSink(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def streamWriter(self, schema, overwrite):
        return GroupWriter(self.options["path"])


def deliver_groups(df: DataFrame, path: str, name: str, checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start a query that delivers into ``path`` through the sink."""
    spark = df.sparkSession
    spark.dataSource.register(GroupSink)
    writer = (df.writeStream.format(FORMAT).option("path", path).queryName(name).outputMode("append")
              .option("checkpointLocation", checkpoint or checkpoint_location(spark, name)))
    return (writer.trigger(**trigger) if trigger else writer).start()


def commits(path: str) -> list[dict]:
    """The commit records, by batch: one small record a batch."""
    from pyarrow import fs

    store, root = open_store(path.rstrip("/"))
    files = store.get_file_info(fs.FileSelector(f"{root}/_commits", allow_not_found=True))
    records = [f.path for f in files if f.path.endswith(".json") and not f.base_name.startswith(".")]
    out = []
    for p in records:
        with store.open_input_stream(p) as f:
            out.append(json.loads(f.read()))
    return sorted(out, key=lambda r: r["batch"])


def read_committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All rows of committed batches."""
    root = path.rstrip("/")
    files = [f"{root}/_parts/{name}" for record in commits(path) for name in record["parts"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def remove_orphans(path: str) -> int:
    """Delete part files that no record lists; only while no query writes to ``path``."""
    from pyarrow import fs

    store, root = open_store(path.rstrip("/"))
    known = {name for record in commits(path) for name in record["parts"]}
    loose = [f.path for f in store.get_file_info(fs.FileSelector(f"{root}/_parts", allow_not_found=True)) if f.base_name not in known]
    for p in loose:
        store.delete_file(p)
    return len(loose)
