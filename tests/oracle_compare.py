"""Compare a registered Spark query with its DuckDB oracle SQL on the same parquet files."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

from rivulet.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


# Spark simple type -> DuckDB type name of the same values.
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
              "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def types_of_spark(df) -> dict:
    return {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}


def types_of_duck(con, sql: str) -> dict:
    rel = con.sql(sql)
    return {c: str(t) for c, t in zip(rel.columns, rel.types)}


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def rows_of_duck(con, sql: str):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]


def compare(spark, query, sf_dir: str, con=None) -> dict:
    """Row count, column names and an order-insensitive multiset check of the values."""
    con = con or duck(sf_dir)
    df = query.build(spark, sf_dir)
    s_types, d_types = types_of_spark(df), types_of_duck(con, query.sql)
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(con, query.sql)
    res = {"name": query.name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": s_cols == d_cols, "spark_cols": s_cols, "oracle_cols": d_cols,
           "types_match": s_types == d_types}
    if s_types != d_types:
        res["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                            if s_types.get(c) != d_types.get(c)}
    if s_cols == d_cols:
        cs, cd = Counter(s_rows), Counter(d_rows)
        res["values_match"] = cs == cd
        if cs != cd:
            res["only_spark"] = list((cs - cd).elements())[:5]
            res["only_oracle"] = list((cd - cs).elements())[:5]
    else:
        res["values_match"] = False
    res["ok"] = (res["cols_match"] and res["types_match"] and res["values_match"]
                 and len(s_rows) == len(d_rows))
    return res
