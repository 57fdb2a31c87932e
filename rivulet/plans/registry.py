"""Registry of named queries: a Spark builder and, where SQL can express it, its oracle SQL.

Each builder takes ``(spark, sf_dir)``, reads the parquet tables under ``sf_dir`` and returns a
lazy DataFrame over the whole tables.  The oracle SQL is plain SQL for DuckDB over views named
like the tables; output column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rivulet.session import configure


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a builder under ``name`` with its oracle ``sql`` (None: rows-only check)."""

    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name!r}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = Query(name, build, sql, (fn.__doc__ or "").strip())
        return fn

    return wrap


# --- SQL fragments shared by several oracle queries (DuckDB dialect) -------------------------

def sql_bucket(col: str, seconds: int) -> str:
    """Start of the tumbling window of ``seconds`` holding ``col`` (epoch aligned, like Spark)."""
    us = seconds * 1_000_000
    return f"make_timestamp(epoch_us({col}) - epoch_us({col}) % {us})"


def sql_java_split(col: str, sep: str = " ") -> str:
    """Java ``String.split`` of ``col`` (trailing empty tokens dropped)."""
    return (f"CASE WHEN {col} <> '' AND rtrim({col}, '{sep}') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({col}, '{sep}'), '{sep}') END")


SQL_ACTION_LINES = (
    "SELECT event_id, concat_ws(';', CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S')) AS value "
    "FROM events"
)

SQL_USER_ACTIONS = (
    f"SELECT event_id, split_part(value, ';', 1) AS user_name, "
    f"strptime(split_part(value, ';', 2), '%Y-%m-%d %H:%M:%S') AS user_action_time "
    f"FROM ({SQL_ACTION_LINES}) AS lines"
)

SQL_DOC_LINES = (
    "SELECT doc_id, line_no, value FROM ("
    "SELECT doc_id, t.value, t.line_no, len(string_split(text, chr(10))) AS n_parts "
    "FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS t(value, line_no)"
    ") AS parts WHERE line_no < n_parts OR value <> ''"
)

SQL_DOC_WORDS = (
    f"SELECT doc_id, line_no, w.word_no, w.word FROM ({SQL_DOC_LINES}) AS lines, "
    f"unnest({sql_java_split('value')}) WITH ORDINALITY AS w(word, word_no)"
)

# A third of all events on one user (the same expression in Spark SQL and in DuckDB), and the row
# target that splits that user's rows on the smallest tables already.
SQL_SKEWED_USER = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id + 1 END"
SKEW_CHUNK_ROWS = 500
