"""Every registered query with oracle SQL must match DuckDB at sf0.01 (rows, columns, values)."""

import pytest

from conftest import SF_ORACLE
from oracle_compare import compare, duck
from rivulet.plans import REGISTRY

NAMES = sorted(n for n, q in REGISTRY.items() if q.sql)


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    res = compare(spark, REGISTRY[name], SF_ORACLE, con)
    assert res["ok"], res


def test_rows_only_queries_run(spark):
    for name, q in sorted(REGISTRY.items()):
        if q.sql is None:
            assert q.build(spark, SF_ORACLE).count() >= 0
