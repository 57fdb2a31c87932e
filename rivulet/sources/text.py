"""Text-line sources: a folder of text files (batch or stream) and lines cut out of a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def read_text_lines(spark: SparkSession, path: str | None = None, stream: bool = False,
                    max_files_per_trigger: int | None = None, host: str | None = None,
                    port: int | None = None) -> DataFrame:
    """One row ``value string`` per line of the text files under ``path``.

    ``stream=True`` gives the streaming twin (new files become new micro-batches): the
    replayable, fault-tolerant stand-in for a socket line source.  ``host`` / ``port`` read a
    TCP line stream with Spark's ``socket`` format instead, as the reference's jobs do; that
    source keeps no offsets (no recovery after failure) and is meant for demos only.
    """
    if host is not None:
        if port is None:
            raise ValueError("a socket source needs host and port")
        return spark.readStream.format("socket").option("host", host).option("port", port).load()
    if path is None:
        raise ValueError("path (or host and port) is required")
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, line_no, value)``: every line of every text, ``line_no`` counted from 1.

    A generator plus a filter inside the scan stage (codegen, no shuffle); each text is cut
    whole.  The final piece after the last newline is a line only when it is not empty.
    """
    parts = docs.select(id_col, F.split(text_col, "\n", -1).alias("_parts"))
    pieces = parts.select(id_col, F.size("_parts").alias("_n"), F.posexplode("_parts").alias("pos", "value"))
    keep = (F.col("pos") < F.col("_n") - 1) | (F.col("value") != F.lit(""))
    return pieces.where(keep).select(id_col, (F.col("pos") + 1).cast("bigint").alias("line_no"), "value")
