"""Named queries over the test warehouse (``queries()``) and their oracle SQL (``oracle_sql()``)."""

from __future__ import annotations

from rivulet.plans.registry import REGISTRY, Query, register
from rivulet.plans import join_queries, state_queries, text_queries, window_queries  # noqa: F401  (registration)


def queries():
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}


__all__ = ["REGISTRY", "Query", "register", "queries", "oracle_sql"]
