"""Bounded literal source (``fromElements``): rows in a given order, with that order kept as ``seq``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType


def from_elements(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str,
                  seq_col: str = "seq") -> DataFrame:
    """Literal rows as a DataFrame with an explicit 1-based arrival column ``seq_col``.

    Spark keeps no row order, so operators whose result depends on arrival order (count
    windows, buffering) read it from ``seq_col``.  Meant for small, in-code fixtures only.
    """
    rows = [tuple(r) for r in rows]
    base = spark.createDataFrame(rows, schema) if rows else spark.createDataFrame([], schema)
    fields = [StructField(seq_col, IntegerType(), False)] + list(base.schema.fields)
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], StructType(fields))
