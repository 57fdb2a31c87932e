"""The driver contract: entry() runs on sf0.001; every query key has a callable; SQL keys match."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    assert [f.name for f in df.schema.fields] == ["user_name", "cnt", "start_time"]
    assert df.count() > 0


def test_oracle_keys_are_query_keys():
    mod = _entry_module()
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert len(mod.queries()) >= 20
