"""Operators against plain (single-task) window formulations on random inputs, with tiny chunk
targets so that every key spans many chunks; plus the enrichment and as-of join contracts."""

import random
import time

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.operators.buffering import buffered_groups
from rivulet.operators.count_window import count_window_average
from rivulet.operators.enrich import async_lookup, lookup_json, lookup_or_timeout
from rivulet.operators.keyed_scan import drop_scan_columns, keyed_last_value, keyed_sequence
from rivulet.operators.temporal import asof_join

ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, rows):
    return spark.createDataFrame([(k, i * 10 + random.randint(0, 9), v) for i, (k, v) in enumerate(rows)],
                                 "k int, t bigint, v bigint")


def _java_div(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def _count_window_model(rows, n, ttl=None):
    """Plain simulation of the keyed (count, sum) state with optional expiry by gap >= ttl."""
    state, last, out, runs, wins = {}, {}, [], {}, {}
    for k, t, v in sorted(rows, key=lambda r: r[1]):
        if k not in last or (ttl is not None and t - last[k] >= ttl):
            state[k] = (0, 0)
            runs[k] = runs.get(k, 0) + 1
            wins[k] = 0
        last[k] = t
        c, s = state[k]
        c, s = c + 1, s + v
        if c >= n:
            out.append((k, runs[k], wins[k], _java_div(s, c)))
            wins[k] += 1
            c, s = 0, 0
        state[k] = (c, s)
    return out


@given(ROWS, st.integers(1, 3), st.sampled_from([{"chunk_rows": 1}, {"chunk_rows": 3}, {}]))
@SETTINGS
def test_count_window_matches_model(spark, rows, n, chunking):
    df = _frame(spark, rows)
    data = [tuple(r) for r in df.collect()]
    got = sorted((r.k, r.win_no, r.avg) for r in count_window_average(df, "k", "v", ["t"], n=n, **chunking).collect())
    want = sorted((k, w, a) for k, _, w, a in _count_window_model(data, n))
    assert got == want


@given(ROWS, st.integers(5, 40))
@SETTINGS
def test_count_window_ttl_matches_model(spark, rows, ttl):
    df = _frame(spark, rows).withColumn("ts", F.timestamp_seconds("t"))
    data = [tuple(r)[:3] for r in df.collect()]
    res = count_window_average(df, "k", "v", ["t"], n=2, ttl=f"{ttl} seconds", time_col="ts", chunk_rows=4)
    got = sorted((r.k, r.run_no, r.win_no, r.avg) for r in res.collect())
    assert got == sorted(_count_window_model(data, 2, ttl))


@given(ROWS, st.integers(5, 40), st.sampled_from([{"chunk_rows": 1}, {"chunk_rows": 2}, {"chunk_rows": 5}, {}]))
@SETTINGS
def test_count_window_ttl_one_pass_matches_model(spark, rows, ttl, chunking):
    """Keys ordered by the time the TTL looks at."""
    df = _frame(spark, rows).withColumn("ts", F.timestamp_seconds("t"))
    data = [tuple(r)[:3] for r in df.collect()]
    res = count_window_average(df, "k", "v", ["ts", "t"], n=2, ttl=f"{ttl} seconds", time_col="ts", **chunking)
    got = sorted((r.k, r.run_no, r.win_no, r.avg) for r in res.collect())
    assert got == sorted(_count_window_model(data, 2, ttl))


@given(ROWS)
@SETTINGS
def test_sequence_and_last_value(spark, rows):
    df = _frame(spark, rows).withColumn("x", F.when(F.col("v") % 3 == 0, F.col("v")))
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("k", "t", F.row_number().over(w).alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("tot"),
                     F.lag("v").over(w).alias("prev_v"),
                     F.last("x", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("lx"))
    seq = drop_scan_columns(keyed_sequence(df, ["k"], ["t"], total="tot", prev=["v"], chunk_rows=3))
    got = keyed_last_value(seq, ["k"], ["t"], "x", "lx", chunk_rows=2)
    cols = ["k", "t", "rn", "tot", "prev_v", "lx"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())


def test_buffered_groups_many_chunks(spark):
    rows = [(i, i % 3) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, bucket int")
    want = []
    for b in range(3):
        ids = [i for i, bb in rows if bb == b]
        full = len(ids) // 4 * 4
        want += [(b, j // 4, ids[j]) for j in range(full)]
    for chunking in ({"chunk_rows": 1}, {"chunk_rows": 5}, {}):
        got = sorted((r.bucket, r.batch_no, r.id)
                     for r in buffered_groups(df, "bucket", ["id"], 4, **chunking).collect())
        assert got == sorted(want), chunking


def test_null_keys_group_together(spark):
    df = spark.createDataFrame([(None, 1, 10), (None, 2, 20), (1, 3, 5), (1, 4, 7)], "k int, t bigint, v bigint")
    got = sorted((r.k if r.k is not None else -1, r.avg) for r in count_window_average(df, "k", "v", ["t"], chunk_rows=1).collect())
    assert got == [(-1, 15), (1, 6)]


def test_lookup_first_row_and_misses(spark):
    ids = spark.createDataFrame([(1, 1002), (2, 1003), (3, 7), (4, 1002)], "event_id int, id int")
    dim = spark.createDataFrame([(1002, "Doe", "Ann"), (1003, "Roe", None), (1002, "Zed", "Zoe")],
                                "employeeNumber int, lastName string, firstName string")
    got = sorted(tuple(r) for r in lookup_json(ids, "id", dim, "employeeNumber", ["lastName", "firstName"]).collect())
    assert got == [(1, 1002, '{"lastName":"Doe","firstName":"Ann"}'), (2, 1003, '{"lastName":"Roe","firstName":null}'),
                   (3, 7, "{}"), (4, 1002, '{"lastName":"Doe","firstName":"Ann"}')]
    miss = lookup_or_timeout(ids, "id", dim, "employeeNumber", ["lastName", "firstName"]).where("id = 7").first()
    assert miss.info == "timeout"


def test_async_lookup_timeout_and_one_output_per_input(spark):
    # defined locally so that it is shipped to the Python workers by value
    def slow_client():
        def call(key):
            if key % 2:
                time.sleep(1.5)
            return f"v{key}"
        return call

    df = spark.createDataFrame([(i, i % 4) for i in range(20)], "event_id int, id int")
    res = async_lookup(df, "id", slow_client, timeout_ms=300, capacity=4, workers=4).collect()
    assert len(res) == 20
    got = {r.id: r.info for r in res}
    assert got == {0: "v0", 1: "timeout", 2: "v2", 3: "timeout"}


def test_asof_join_inner_and_left(spark):
    probe = spark.createDataFrame([(1, "a", 5), (2, "a", 10), (3, "b", 1), (4, "a", 20), (5, None, 7)],
                                  "pid int, k string, t int")
    versions = spark.createDataFrame([("a", 5, "v5"), ("a", 12, "v12"), ("b", 2, "b2"), (None, 6, "n6")],
                                     "k string, t int, val string")
    inner = asof_join(probe, versions, ["k"], "t", "t", ["val"], chunk_rows=1)
    assert sorted((r.pid, r.version_val) for r in inner.collect()) == [(1, "v5"), (2, "v5"), (4, "v12")]
    left = asof_join(probe, versions, ["k"], "t", "t", ["val"], how="left")
    assert sorted((r.pid, r.version_val) for r in left.collect()) == [
        (1, "v5"), (2, "v5"), (3, None), (4, "v12"), (5, None)]
    nulls = asof_join(probe, versions, ["k"], "t", "t", ["val"], null_keys_equal=True)
    assert {r.pid: r.version_val for r in nulls.collect()}[5] == "n6"


def test_asof_join_null_times_match_nothing(spark):
    """The rules of ``ASOF JOIN ... ON p.k = v.k AND p.t >= v.t``."""
    import duckdb
    probe, versions = [(1, "a", 5), (2, "a", None), (3, None, 9), (4, "c", 9)], [("a", None, "vn"), (None, 1, "nk"), ("a", 4, "v4")]
    p, v = spark.createDataFrame(probe, "pid int, k string, t int"), spark.createDataFrame(versions, "k string, t int, val string")
    con = duckdb.connect()
    con.execute("CREATE TABLE p (pid INT, k VARCHAR, t INT)")
    con.execute("CREATE TABLE v (k VARCHAR, t INT, val VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", probe)
    con.executemany("INSERT INTO v VALUES (?, ?, ?)", versions)
    for how, sql in (("inner", "ASOF JOIN"), ("left", "ASOF LEFT JOIN")):
        want = con.execute(f"SELECT pid, val FROM p {sql} v ON p.k = v.k AND p.t >= v.t").fetchall()
        for rows in (1, 1000):
            got = asof_join(p, v, ["k"], "t", "t", ["val"], how=how, chunk_rows=rows).collect()
            assert sorted((r.pid, r.version_val) for r in got) == sorted(want)


def test_lookup_broadcast_is_decided_by_bytes(spark):
    """Few wide records are over the limit: no broadcast hint, the shuffle join gives the same."""
    from rivulet.operators.sizing import broadcast_if_small, measured_bytes
    ids = spark.createDataFrame([(1, 1002), (2, 7)], "event_id int, id int")
    dim = spark.createDataFrame([(1002, "D" * 5000, "Ann"), (1003, "Roe", None)],
                                "employeeNumber int, lastName string, firstName string")
    assert 5000 < measured_bytes(dim) < 6000
    assert broadcast_if_small(dim)[1] and not broadcast_if_small(dim, 4000)[1]
    spark.conf.set("rivulet.broadcast.maxBytes", "4000")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = lookup_json(ids, "id", dim, "employeeNumber", ["lastName", "firstName"])
        plan = res._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert sorted(tuple(r) for r in res.collect()) == [
            (1, 1002, '{"lastName":"%s","firstName":"Ann"}' % ("D" * 5000)), (2, 7, "{}")]
    finally:
        spark.conf.unset("rivulet.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_async_lookup_null_and_integer_keys_from_several_tasks(spark):
    def telling_client():
        from pyspark import TaskContext
        return lambda key: f"{type(key).__name__}:{key}:{TaskContext.get().partitionId()}"

    df = spark.createDataFrame([(i, i % 50 if i % 51 else None) for i in range(300)], "event_id int, id int")
    rows = async_lookup(df, "id", telling_client, tasks=6).collect()
    assert len(rows) == 300 and all(r.info is None for r in rows if r.id is None)
    assert all(r.info.startswith(f"int:{r.id}:") for r in rows if r.id is not None)
    assert len({r.info.split(":")[2] for r in rows if r.info}) > 1
    answers = {}
    for r in rows:
        assert answers.setdefault(r.id, r.info) == r.info  # one call per key


def test_async_lookup_builds_without_calls(spark):
    def failing_client():
        raise RuntimeError("called while building")

    assert async_lookup(spark.range(3), "id", failing_client).columns == ["id", "info"]


def test_checkpoint_root_needs_a_shared_folder_on_a_cluster(monkeypatch):
    import pytest

    from rivulet.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_counter_frame(spark):
    from rivulet.sources.counter import counter_frame
    rows = sorted(tuple(r) for r in counter_frame(spark, 3, 4).collect())
    assert rows == [(s, v) for s in range(3) for v in range(4)]
    assert counter_frame(spark, 2, 0).count() == 0


def test_word_total_outgrows_int(spark):
    from rivulet.operators.wordcount import word_totals
    pairs = spark.createDataFrame([("a", 2_000_000_000), ("a", 2_000_000_000)], "word string, n int")
    assert [tuple(r) for r in word_totals(pairs).collect()] == [("a", 4_000_000_000)]


def test_batch_windows_drop_rows_without_time(spark):
    from rivulet.operators.windows import tumble_count, tumble_sum
    df = spark.createDataFrame([("amy", "2020-03-20 15:22:10", 1), ("amy", None, 1), ("bob", "2020-03-20 15:22:59", 1),
                                (None, "2020-03-20 15:22:30", 1)], "u string, t string, n int") \
        .withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = sorted((r.u or "", r.cnt, str(r.start_time)) for r in tumble_count(df, "t", "u", "1 minute").collect())
    assert got == [("", 0, "2020-03-20 15:22:00"), ("amy", 1, "2020-03-20 15:22:00"), ("bob", 1, "2020-03-20 15:22:00")]
    sums = sorted((r.u or "", r.n) for r in tumble_sum(df, "t", "u", "n", "1 minute").collect())
    assert sums == [("", 1), ("amy", 1), ("bob", 1)]


def test_ttl_boundary_gap_equal_to_ttl_expires(spark):
    df = spark.createDataFrame([(1, 0, 3), (1, 10, 5)], "k int, t bigint, v bigint").withColumn(
        "ts", F.timestamp_seconds("t"))
    for order in (["ts", "t"], ["t"]):  # one-pass path and the fallback path
        expired = count_window_average(df, "k", "v", order, n=2, ttl="10 seconds", time_col="ts").collect()
        shorter = count_window_average(df, "k", "v", order, n=2, ttl="9999999 microseconds", time_col="ts").collect()
        assert expired == [] and shorter == []
        alive = count_window_average(df, "k", "v", order, n=2, ttl="10000001 microseconds", time_col="ts").collect()
        assert [(r.k, r.avg) for r in alive] == [(1, 4)]


def test_async_lookup_respects_capacity(spark):
    """With more threads than capacity, no task ever has more than ``capacity`` calls in flight."""
    def counting_client():
        import threading
        lock = threading.Lock()
        state = {"now": 0}

        def call(key):
            with lock:
                state["now"] += 1
                seen = state["now"]
            time.sleep(0.05)
            with lock:
                state["now"] -= 1
            return str(seen)
        return call

    df = spark.createDataFrame([(i, i) for i in range(40)], "event_id int, id int").coalesce(1)
    res = async_lookup(df, "id", counting_client, timeout_ms=5000, capacity=3, workers=10).collect()
    assert len(res) == 40
    assert 2 <= max(int(r.info) for r in res) <= 3  # concurrent, and bounded


def test_split_path_equals_whole_path_on_nulls_strings_and_hashes(spark):
    """Null order values come first, text and 64-bit hashes order like numbers, ties are stable."""
    rows = [(i % 2, None if i % 7 == 0 else f"t{i * 37 % 100:03d}", i) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, s string, v bigint").withColumn("h", F.xxhash64("v"))
    for order in (["s", "v"], ["h"], ["s"]):
        whole = sorted(map(tuple, drop_scan_columns(keyed_sequence(df, ["k"], order, total="n", prev=["v"])).collect()), key=str)
        split = sorted(map(tuple, drop_scan_columns(keyed_sequence(df, ["k"], order, total="n", prev=["v"], chunk_rows=5)).collect()), key=str)
        assert whole == split
        delivered = [sorted(map(tuple, buffered_groups(df, "k", order, 7, chunk_rows=c).collect()), key=str) for c in (5, None)]
        assert delivered[0] == delivered[1] and len(delivered[0]) == 2 * (60 // 7 * 7)
    timed = df.withColumn("ts", F.when(F.col("v") % 5 != 0, F.timestamp_seconds("v")))
    runs = [sorted(map(tuple, count_window_average(timed, "k", "v", ["ts", "v"], n=2, ttl="3 seconds", time_col="ts",
                                                   chunk_rows=c).collect())) for c in (4, None)]
    assert runs[0] == runs[1] and runs[0]


def test_null_value_fails_a_count_window(spark):
    import pytest
    df = spark.createDataFrame([(1, 1, 3), (1, 2, None)], "k int, t int, v bigint")
    with pytest.raises(Exception, match="null in v"):
        count_window_average(df, "k", "v", ["t"]).collect()
