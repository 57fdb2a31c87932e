"""Queries for the stateful operators' batch twins: A3 count windows (+TTL), K2.  The ``*_split``
queries run the same operators with a third of all rows on one key that is split into chunks.

S3 (the counter source) reads no table, so it is library code (``sources.counter``) and tested."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.buffering import buffered_groups
from rivulet.operators.count_window import count_window_average
from rivulet.plans.registry import SKEW_CHUNK_ROWS, SQL_SKEWED_USER, register
from rivulet.sources.tables import read_table

# Fixed parameters of the registered queries.
TTL = "6 hours"          # event-time state TTL of count_window_avg_ttl
BUFFER_THRESHOLD = 3     # buffered_sink group size
BUFFER_BUCKETS = 4       # buffered_sink instances (bucket = user_id % 4)


def _pairs(spark: SparkSession, sf_dir: str, user: str = "user_id") -> DataFrame:
    """(key, value) stream from events: key = user_id, value = floor(value) as bigint,
    arrival order = (ts, event_id)."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value")
    return ev.select(F.expr(user).alias("user_id"), "ts", "event_id", F.floor("value").cast("bigint").alias("v"))


def _events_sql(user: str) -> str:
    return f"(SELECT event_id, ts, event_type, value, {user} AS user_id FROM events) AS ev"


def _cw_sql(n: int, user: str = "user_id") -> str:
    return (
        "SELECT user_id, win_no, CAST(sum(v) AS BIGINT) // count(*) AS avg FROM ("
        f"SELECT user_id, CAST(floor(value) AS BIGINT) AS v, "
        f"(row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST) - 1) // {n} AS win_no "
        f"FROM {_events_sql(user)}) AS s GROUP BY user_id, win_no HAVING count(*) = {n}")


def _ttl_sql(user: str, interval: str) -> str:
    order = "ORDER BY ts NULLS FIRST, event_id NULLS FIRST"
    return (
        "WITH b AS (SELECT user_id, ts, event_id, CAST(floor(value) AS BIGINT) AS v, "
        f"CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL '{interval}' THEN 1 ELSE 0 END AS brk "
        f"FROM {_events_sql(user)} WINDOW w AS (PARTITION BY user_id {order})), "
        f"r AS (SELECT *, sum(brk) OVER (PARTITION BY user_id {order} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_no FROM b), "
        f"p AS (SELECT *, (row_number() OVER (PARTITION BY user_id, run_no {order}) - 1) // 2 AS win_no FROM r) "
        "SELECT user_id, CAST(run_no AS BIGINT) AS run_no, win_no, CAST(sum(v) AS BIGINT) // count(*) AS avg "
        "FROM p GROUP BY user_id, run_no, win_no HAVING count(*) = 2")


@register("count_window_avg", _cw_sql(2))
def count_window_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: per user, integer average of every 2 consecutive values (last odd value dropped)."""
    return count_window_average(_pairs(spark, sf_dir), "user_id", "v", ["ts", "event_id"], n=2)


@register("count_window_avg_n", _cw_sql(3))
def count_window_avg_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 generalised: windows of 3 values."""
    return count_window_average(_pairs(spark, sf_dir), "user_id", "v", ["ts", "event_id"], n=3)


@register("count_window_avg_ttl", _ttl_sql("user_id", TTL))
def count_window_avg_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + T7: pairs of values with a 6-hour state TTL on event time (a gap >= TTL resets)."""
    return count_window_average(_pairs(spark, sf_dir), "user_id", "v", ["ts", "event_id"], n=2,
                                ttl=TTL, time_col="ts")


@register("buffered_sink",
          "SELECT bucket, (rn - 1) // 3 AS batch_no, event_id, event_type FROM ("
          "SELECT user_id % 4 AS bucket, event_id, event_type, "
          "row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS rn, "
          "count(*) OVER (PARTITION BY user_id % 4) AS total FROM events) AS s "
          "WHERE rn <= (total // 3) * 3")
def buffered_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: events delivered by 4 buffering sink instances in complete groups of 3."""
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    rows = ev.select((F.col("user_id") % BUFFER_BUCKETS).alias("bucket"), "event_id", "event_type")
    return buffered_groups(rows, "bucket", ["event_id"], BUFFER_THRESHOLD)


@register("count_window_avg_split", _cw_sql(2, SQL_SKEWED_USER))
def count_window_avg_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 with a third of all events on one user, whose rows are split (row target 500)."""
    return count_window_average(_pairs(spark, sf_dir, SQL_SKEWED_USER), "user_id", "v", ["ts", "event_id"], n=2,
                                chunk_rows=SKEW_CHUNK_ROWS)


@register("count_window_avg_ttl_split", _ttl_sql(SQL_SKEWED_USER, "10 minutes"))
def count_window_avg_ttl_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + T7 with a short TTL on the same skewed keys."""
    return count_window_average(_pairs(spark, sf_dir, SQL_SKEWED_USER), "user_id", "v", ["ts", "event_id"], n=2,
                                ttl="10 minutes", time_col="ts", chunk_rows=SKEW_CHUNK_ROWS)


@register("buffered_sink_split",
          "SELECT bucket, (rn - 1) // 3 AS batch_no, event_id, event_type FROM ("
          "SELECT user_id % 4 AS bucket, event_id, event_type, "
          "row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_type NULLS FIRST, event_id NULLS FIRST) AS rn, "
          "count(*) OVER (PARTITION BY user_id % 4) AS total FROM events) AS s "
          "WHERE rn <= (total // 3) * 3")
def buffered_sink_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 in text order with every bucket split (row target 500)."""
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    rows = ev.select((F.col("user_id") % BUFFER_BUCKETS).alias("bucket"), "event_id", "event_type")
    return buffered_groups(rows, "bucket", ["event_type", "event_id"], BUFFER_THRESHOLD, chunk_rows=SKEW_CHUNK_ROWS)
