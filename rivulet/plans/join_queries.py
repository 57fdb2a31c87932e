"""Enrichment and as-of join queries: J1 lookup_first_json, J2 lookup_or_timeout, J4 temporal_join.

J3 (concurrent calls to a service) is library code, ``operators.enrich.async_lookup``: a query over
given tables has no service to call, and its set-based form is J1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.enrich import lookup_json, lookup_or_timeout
from rivulet.operators.temporal import asof_join_within
from rivulet.plans.registry import SKEW_CHUNK_ROWS, SQL_SKEWED_USER, register
from rivulet.sources.tables import read_table

# Lookup table ("employees"): all suppliers; lastName = supplier name, firstName = nation name.
# Input ids: events.user_id, which run beyond the supplier keys, so some find no row.
SQL_EMPLOYEES = (
    "SELECT s_suppkey AS employee_number, s_name AS lastName, n_name AS firstName "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey"
)


def _lookup_sql(miss: str) -> str:
    return (
        "SELECT e.event_id, CAST(e.user_id AS INTEGER) AS id, "
        f"CASE WHEN d.employee_number IS NULL THEN '{miss}' "
        "ELSE to_json(struct_pack(lastName := d.lastName, firstName := d.firstName))::VARCHAR END AS info "
        "FROM events e LEFT JOIN ("
        "SELECT employee_number, lastName, firstName FROM ("
        "SELECT *, row_number() OVER (PARTITION BY employee_number ORDER BY lastName, firstName) AS rn "
        f"FROM ({SQL_EMPLOYEES}) AS emp) AS r WHERE rn = 1) AS d ON e.user_id = d.employee_number")


def _employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select(
        F.col("s_suppkey").alias("employee_number"), F.col("s_name").alias("lastName"), F.col("n_name").alias("firstName"))


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id")
    return ev.select("event_id", F.col("user_id").cast("int").alias("id"))


@register("lookup_first_json", _lookup_sql("{}"))
def lookup_first_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each id enriched with the JSON of its first employee row, or '{}' when none."""
    return lookup_json(_ids(spark, sf_dir), "id", _employees(spark, sf_dir), "employee_number",
                       ["lastName", "firstName"])


@register("lookup_or_timeout", _lookup_sql("timeout"))
def lookup_or_timeout_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As J1, but an id without a row answers 'timeout' (the callback never completes)."""
    return lookup_or_timeout(_ids(spark, sf_dir), "id", _employees(spark, sf_dir), "employee_number",
                             ["lastName", "firstName"])


_TEMPORAL_SQL = (
    "SELECT p.event_id, p.user_id, p.ts, v.event_id AS version_event_id, v.value AS version_value "
    "FROM (SELECT event_id, {user} AS user_id, ts FROM events WHERE event_type = 'purchase') AS p "
    "ASOF JOIN (SELECT event_id, {user} AS user_id, ts, value FROM events WHERE event_type = 'signup') AS v "
    "ON p.user_id = v.user_id AND p.ts >= v.ts")


def _temporal(spark: SparkSession, sf_dir: str, user: str = "user_id", chunk_rows: int | None = None) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type", "value")
    ev = ev.withColumn("user_id", F.expr(user))
    kind = F.col("event_type")
    return asof_join_within(ev, kind == "purchase", kind == "signup", ["user_id"], "ts", ["event_id", "user_id", "ts"],
                            ["event_id", "value"], chunk_rows=chunk_rows)


@register("temporal_join", _TEMPORAL_SQL.format(user="user_id"))
def temporal_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase joined to the user's latest signup at or before it (inner)."""
    return _temporal(spark, sf_dir)


@register("temporal_join_split", _TEMPORAL_SQL.format(user=SQL_SKEWED_USER))
def temporal_join_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 with a third of all events on one user, whose rows are split (row target 500)."""
    return _temporal(spark, sf_dir, SQL_SKEWED_USER, chunk_rows=SKEW_CHUNK_ROWS)
