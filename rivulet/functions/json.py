"""Compact JSON objects from columns, keeping null fields (``{"a":null}``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def json_object(struct_col: Column) -> Column:
    """``to_json`` of a struct with null fields written out."""
    return F.to_json(struct_col, _KEEP_NULLS)


def json_or(struct_col: Column, present: Column, fallback: str) -> Column:
    """JSON of ``struct_col`` where ``present`` holds, else the literal ``fallback``."""
    return F.when(present, json_object(struct_col)).otherwise(F.lit(fallback))
