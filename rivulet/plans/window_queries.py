"""Tumbling-window queries: A1 (sum of ones per key), A2 / A2s (count per user and window)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.windows import tumble_count, tumble_sum
from rivulet.plans.registry import SQL_USER_ACTIONS, register, sql_bucket
from rivulet.sources.tables import read_table
from rivulet.sources.user_actions import register_user_actions, user_actions_from_events


def _user_count_sql(seconds: int) -> str:
    return (f"SELECT user_name, count(user_name) AS cnt, {sql_bucket('user_action_time', seconds)} AS start_time "
            f"FROM ({SQL_USER_ACTIONS}) AS ua GROUP BY ALL")


def _user_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_actions_from_events(read_table(spark, sf_dir, "events", "user_id", "ts"))


def _tumble_user_count(size: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tumble_count(_user_actions(spark, sf_dir), "user_action_time", "user_name", size)
    return build


@register("tumble_user_count", _user_count_sql(60))
def tumble_user_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: per user and 1-minute event-time window, count(user_name) and the window start."""
    return _tumble_user_count("1 minute")(spark, sf_dir)


@register("tumble_user_count_1h", _user_count_sql(3600))
def tumble_user_count_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 with 1-hour windows."""
    return _tumble_user_count("1 hour")(spark, sf_dir)


@register("tumble_user_count_1d", _user_count_sql(86400))
def tumble_user_count_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 with 1-day windows."""
    return _tumble_user_count("1 day")(spark, sf_dir)


@register("tumble_user_count_sql", _user_count_sql(60))
def tumble_user_count_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2s: the same count written in Spark SQL against the registered ``user_actions`` table."""
    register_user_actions(_user_actions(spark, sf_dir))
    # Minutes by date_trunc: window() would add a null test that Catalyst pushes below the view with
    # the whole parse written out again.  Groups without a time are dropped after the aggregate.
    return spark.sql(
        "SELECT user_name, count(user_name) AS cnt, CAST(date_trunc('MINUTE', user_action_time) AS TIMESTAMP_NTZ) AS start_time "
        "FROM user_actions GROUP BY user_name, date_trunc('MINUTE', user_action_time) HAVING count(user_action_time) > 0")


@register("tumble_sum_event_time",
          f"SELECT event_type AS word, {sql_bucket('ts', 5)} AS start_time, CAST(count(*) AS INTEGER) AS n "
          "FROM events GROUP BY ALL")
def tumble_sum_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: (word, 1) pairs keyed by word, summed per 5-second tumbling window (event time)."""
    ev = read_table(spark, sf_dir, "events", "ts", "event_type")
    pairs = ev.select("ts", F.col("event_type").alias("word"), F.lit(1).cast("int").alias("n"))
    return tumble_sum(pairs, "ts", "word", "n", "5 seconds")
