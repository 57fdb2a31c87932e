"""Streaming forms: reference fixtures, stream = batch twin, late data, TTL, restart."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from rivulet.operators.buffering import buffered_groups
from rivulet.operators.count_window import count_window_average
from rivulet.session import checkpoint_location
from rivulet.sources.counter import counter_stream
from rivulet.sources.text import read_text_lines
from rivulet.streaming.buffering import buffered_stream
from rivulet.streaming.count_window import count_window_stream
from rivulet.streaming.pipelines import lookup_stream, user_count_stream, word_count_stream
from rivulet.streaming.runner import deliver_batches, drain, run_available, start

PAIRS_SCHEMA = "seq int, k bigint, v bigint"
REFERENCE_PAIRS = [(1, 1, 3), (2, 1, 5), (3, 1, 7), (4, 1, 4), (5, 1, 2)]


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def _write_json(spark, rows, schema, folder, idx):
    """One JSON file per call: the file becomes one micro-batch (maxFilesPerTrigger=1)."""
    path = os.path.join(folder, f"part-{idx:04d}")
    spark.createDataFrame(rows, schema).coalesce(1).write.json(path)
    return path


def _stream(spark, folder, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").json(folder))


@pytest.fixture
def no_empty_batches(spark):
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    yield
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")


def test_count_window_reference_fixture(spark, tmp_path, no_empty_batches):
    _write_json(spark, REFERENCE_PAIRS, PAIRS_SCHEMA, str(tmp_path), 0)
    out = run_available(count_window_stream(_stream(spark, str(tmp_path), PAIRS_SCHEMA), "k", "v", "seq"),
                        _name("cw"))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 4), (1, 5)]


def test_count_window_batch_twin_reference_fixture(spark):
    """The reference's five literal elements, in order, through the bounded literal source."""
    from rivulet.sources.elements import from_elements
    df = from_elements(spark, [(k, v) for _, k, v in REFERENCE_PAIRS], "k bigint, v bigint")
    assert [r.seq for r in df.orderBy("seq").collect()] == [1, 2, 3, 4, 5]
    rows = count_window_average(df, "k", "v", ["seq"], n=2).collect()
    assert sorted((r.k, r.avg) for r in rows) == [(1, 4), (1, 5)]


def test_console_sink_prints(spark, tmp_path, no_empty_batches):
    """K1: the console sink takes every record and the query ends with the input (the JVM prints to its
    own standard output, which a test cannot read)."""
    _write_json(spark, REFERENCE_PAIRS, PAIRS_SCHEMA, str(tmp_path), 0)
    q = start(count_window_stream(_stream(spark, str(tmp_path), PAIRS_SCHEMA), "k", "v", "seq"),
              _name("console"), sink="console", trigger={"availableNow": True})
    assert q.awaitTermination(120)
    q.stop()
    assert q.lastProgress["numInputRows"] == 5


def test_count_window_ttl_expires_half_pair(spark, tmp_path, no_empty_batches):
    """3, then 2 s later 5 and 7: with a 1 s TTL the 3 is forgotten -> (1,6); without -> (1,4)."""
    results = {}
    for ttl in (1000, None):
        folder = str(tmp_path / f"ttl{ttl}")
        os.makedirs(folder)
        name = _name("ttl")
        q = start(count_window_stream(_stream(spark, folder, PAIRS_SCHEMA), "k", "v", "seq", ttl_ms=ttl),
                  name, trigger={"processingTime": "200 milliseconds"})
        try:
            _write_json(spark, [(1, 1, 3)], PAIRS_SCHEMA, folder, 0)
            drain(q, 60)
            time.sleep(2.2)
            _write_json(spark, [(2, 1, 5), (3, 1, 7)], PAIRS_SCHEMA, folder, 1)
            drain(q, 60)
        finally:
            q.stop()
        results[ttl] = sorted(tuple(r) for r in spark.table(name).collect())
    assert results[1000] == [(1, 6)]
    assert results[None] == [(1, 4)]


def test_count_window_stream_equals_batch(spark, tmp_path, no_empty_batches):
    """Events (sf0.001) fed as 4 time-ordered files == the batch twin over the whole table."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_id", "ts", "user_id", F.floor("value").cast("bigint").alias("v"))
    pdf = ev.toPandas().sort_values(["ts", "event_id"]).reset_index(drop=True)
    pdf["seq"] = range(1, len(pdf) + 1)
    schema = "event_id bigint, user_id bigint, v bigint, seq int"
    n = len(pdf)
    for i in range(4):
        part = pdf.iloc[i * n // 4:(i + 1) * n // 4]
        rows = [(int(a), int(b), int(c), int(d)) for a, b, c, d in
                part[["event_id", "user_id", "v", "seq"]].itertuples(index=False)]
        _write_json(spark, rows, schema, str(tmp_path), i)
    stream = run_available(count_window_stream(_stream(spark, str(tmp_path), schema), "user_id", "v", "seq"),
                           _name("cwev"))
    batch = count_window_average(ev, "user_id", "v", ["ts", "event_id"], n=2)
    got = sorted(tuple(r) for r in stream.collect())
    want = sorted((r.user_id, r.avg) for r in batch.collect())
    assert len(got) == len(want) > 0 and got == want


def test_buffered_stream_restart(spark, tmp_path, no_empty_batches):
    """a..g with threshold 3 -> (a,b,c),(d,e,f), g held; after restart h,i complete (g,h,i)."""
    schema = "seq int, bucket int, word string, n int"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    ckpt = checkpoint_location(spark, "buffer")
    rows = [(i + 1, 0, w, 1) for i, w in enumerate("abcdefg")]
    _write_json(spark, rows, schema, folder, 0)

    def run():
        stream = buffered_stream(_stream(spark, folder, schema), "bucket", "seq", ["word", "n"], 3)
        q = deliver_batches(stream, out, _name("buf"), checkpoint=ckpt, trigger={"availableNow": True})
        assert q.awaitTermination(120)
        q.stop()
        return sorted((r.batch_no, r.word) for r in spark.read.parquet(out).collect())

    first = run()
    assert first == [(0, "a"), (0, "b"), (0, "c"), (1, "d"), (1, "e"), (1, "f")]
    _write_json(spark, [(8, 0, "h", 1), (9, 0, "i", 1)], schema, folder, 1)
    second = run()
    assert second == first + [(2, "g"), (2, "h"), (2, "i")]


def test_buffered_batch_twin_fixture(spark):
    df = spark.createDataFrame([(i + 1, 0, w) for i, w in enumerate("abcdefg")], "seq int, bucket int, word string")
    rows = buffered_groups(df, "bucket", ["seq"], 3).collect()
    assert sorted((r.batch_no, r.word) for r in rows) == [
        (0, "a"), (0, "b"), (0, "c"), (1, "d"), (1, "e"), (1, "f")]


def _late_data_counts(spark, folder, delay):
    lines = ["amy;2020-03-20 15:22:00", "bob;2020-03-20 15:23:01", "amy;2020-03-20 15:25:30",
             "cat;2020-03-20 15:26:00", "bob;2020-03-20 15:23:05", "bob;2020-03-20 15:29:00"]
    os.makedirs(folder)
    name = _name("late")
    stream = user_count_stream(read_text_lines(spark, folder, stream=True, max_files_per_trigger=1), delay=delay)
    q = start(stream, name, mode="update", trigger={"processingTime": "100 milliseconds"})
    try:
        for i, line in enumerate(lines):
            with open(os.path.join(folder, f"f{i:02d}.txt"), "w") as fh:
                fh.write(line + "\n")
            drain(q, 60)
            # leave a batch between rows so the watermark of one row is in force for the next
            time.sleep(0.4)
            drain(q, 60)
    finally:
        q.stop()
    rows = spark.table(name).collect()
    best = {}
    for r in rows:
        k = (r.user_name, r.start_time.strftime("%H:%M"))
        best[k] = max(best.get(k, 0), r.cnt)
    return best


@pytest.mark.parametrize("delay,expected", [("0 seconds", 1), ("1 minute", 1), ("5 minutes", 2)])
def test_user_count_late_data(spark, tmp_path, delay, expected):
    best = _late_data_counts(spark, str(tmp_path / "lines"), delay)
    assert best[("bob", "15:23")] == expected
    assert best[("amy", "15:22")] == 1 and best[("bob", "15:29")] == 1


def test_word_count_stream_totals(spark, tmp_path, no_empty_batches):
    folder = str(tmp_path / "words")
    os.makedirs(folder)
    texts = ["a b ", "", " a  b", "b\tc a"]
    for i, t in enumerate(texts):
        with open(os.path.join(folder, f"f{i}.txt"), "w") as fh:
            fh.write(t + "\n")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    stream = word_count_stream(read_text_lines(spark, folder, stream=True, max_files_per_trigger=1), timers=False)
    name = _name("wc")
    q = start(stream, name, mode="update", trigger={"availableNow": True})
    assert q.awaitTermination(120)
    q.stop()
    totals = {}
    for r in spark.table(name).collect():
        totals[(r.word, r.start_time)] = r.n
    by_word = {}
    for (w, _), n in totals.items():
        by_word[w] = by_word.get(w, 0) + n
    # tokens: [a,b] [''] ['',a,'',b] ['b\tc', a]
    assert by_word == {"a": 3, "b": 2, "": 3, "b\tc": 1}


def test_counter_stream_restart(spark, tmp_path):
    """Stop and restart from one checkpoint: every value exactly once per subtask (file sink)."""
    ckpt = checkpoint_location(spark, "counter")
    out = str(tmp_path / "counter_out")
    for _ in range(2):
        q = start(counter_stream(spark, subtasks=2, rows_per_batch=5), _name("cnt"), sink="parquet",
                  checkpoint=ckpt, trigger={"processingTime": "100 milliseconds"}, path=out)
        try:
            first = None
            deadline = time.time() + 60
            while time.time() < deadline:
                p = q.lastProgress
                if p is not None:
                    first = p["batchId"] if first is None else first
                    if p["batchId"] >= first + 3:
                        break
                time.sleep(0.2)
        finally:
            q.stop()
    seen = [tuple(r) for r in spark.read.parquet(out).collect()]
    for s in (0, 1):
        vals = sorted(v for sub, v in seen if sub == s)
        assert vals == list(range(len(vals))) and len(vals) >= 40


def test_lookup_stream_static(spark, tmp_path, no_empty_batches):
    folder = str(tmp_path / "ids")
    os.makedirs(folder)
    with open(os.path.join(folder, "ids.txt"), "w") as fh:
        fh.write("1002\n1003\n+1002\n7\n")
    dim = spark.createDataFrame([(1002, "Doe", "Ann"), (1003, "Roe", None), (1002, "Zed", "Zoe")],
                                "employeeNumber int, lastName string, firstName string")
    stream = lookup_stream(read_text_lines(spark, folder, stream=True), dim, "employeeNumber",
                           ["lastName", "firstName"])
    rows = run_available(stream, _name("lk")).collect()
    got = sorted((r.id, r.info) for r in rows)
    assert got == [(7, "{}"), (1002, '{"lastName":"Doe","firstName":"Ann"}'),
                   (1002, '{"lastName":"Doe","firstName":"Ann"}'),
                   (1003, '{"lastName":"Roe","firstName":null}')]


def test_async_lookup_stream(spark, tmp_path, no_empty_batches):
    """J3 on a stream: one output per input line, calls per micro-batch."""
    from rivulet.functions.parse import parse_int
    from rivulet.operators.enrich import async_lookup
    folder = str(tmp_path / "ids")
    os.makedirs(folder)
    with open(os.path.join(folder, "ids.txt"), "w") as fh:
        fh.write("1\n2\n1\n")
    ids = read_text_lines(spark, folder, stream=True).select(parse_int("value").alias("id"))

    def digest_client():
        import hashlib
        return lambda key: hashlib.md5(str(key).encode()).hexdigest()

    rows = run_available(async_lookup(ids, "id", digest_client), _name("aio")).collect()
    import hashlib
    assert sorted((r.id, r.info) for r in rows) == sorted(
        (i, hashlib.md5(str(i).encode()).hexdigest()) for i in (1, 2, 1))


def test_asof_join_stream_batches(spark, tmp_path, no_empty_batches):
    from rivulet.streaming.runner import asof_join_batches
    schema = "pid int, k string, t int"
    folder, out = str(tmp_path / "probes"), str(tmp_path / "asof_out")
    _write_json(spark, [(1, "a", 5), (2, "a", 10)], schema, folder, 0)
    _write_json(spark, [(3, "b", 1), (4, "a", 20)], schema, folder, 1)
    versions = spark.createDataFrame([("a", 5, "v5"), ("a", 12, "v12"), ("b", 2, "b2")], "k string, t int, val string")
    q = asof_join_batches(_stream(spark, folder, schema), versions, ["k"], "t", "t", ["val"], out, _name("asof"),
                          how="left", trigger={"availableNow": True})
    assert q.awaitTermination(120)
    q.stop()
    got = sorted((r.pid, r.version_val) for r in spark.read.parquet(out).collect())
    assert got == [(1, "v5"), (2, "v5"), (3, None), (4, "v12")]


def test_buffered_stream_equals_batch(spark, tmp_path, no_empty_batches):
    schema = "seq int, bucket int, event_id bigint"
    folder = tmp_path / "in"
    os.makedirs(folder)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    pdf = ev.toPandas().sort_values(["event_id"]).reset_index(drop=True)
    pdf["seq"] = range(1, len(pdf) + 1)
    pdf["bucket"] = (pdf["user_id"] % 4).astype(int)
    n = len(pdf)
    for i in range(4):
        part = pdf.iloc[i * n // 4:(i + 1) * n // 4]
        _write_json(spark, [(int(a), int(b), int(c)) for a, b, c in part[["seq", "bucket", "event_id"]].itertuples(index=False)],
                    schema, str(folder), i)
    stream = run_available(buffered_stream(_stream(spark, str(folder), schema), "bucket", "seq", ["event_id"], 3),
                           _name("bufev"))
    rows = ev.select((F.col("user_id") % 4).cast("int").alias("bucket"), "event_id")
    batch = buffered_groups(rows, "bucket", ["event_id"], 3)
    got = sorted((r.bucket, r.batch_no, r.event_id) for r in stream.collect())
    want = sorted((r.bucket, r.batch_no, r.event_id) for r in batch.collect())
    assert len(got) == len(want) > 0 and got == want


def test_user_count_stream_equals_batch(spark, tmp_path):
    """A2 as a stream (update mode, generous watermark so nothing is late) == the batch twin."""
    from rivulet.operators.windows import tumble_count
    from rivulet.sources.user_actions import action_lines_from_events, user_actions_from_events
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    lines = action_lines_from_events(ev.orderBy("ts", "event_id")).toPandas()["value"].tolist()
    folder = tmp_path / "lines"
    os.makedirs(folder)
    n = len(lines)
    for i in range(4):
        with open(folder / f"f{i}.txt", "w") as fh:
            fh.write("\n".join(lines[i * n // 4:(i + 1) * n // 4]) + "\n")
    stream = user_count_stream(read_text_lines(spark, str(folder), stream=True, max_files_per_trigger=1),
                               size="1 hour", delay="3650 days")
    name = _name("ucev")
    q = start(stream, name, mode="update", trigger={"availableNow": True})
    assert q.awaitTermination(120)
    q.stop()
    final = {}
    for r in spark.table(name).collect():
        k = (r.user_name, r.start_time.replace(tzinfo=None))
        final[k] = max(final.get(k, 0), r.cnt)
    batch = tumble_count(user_actions_from_events(ev), "user_action_time", "user_name", "1 hour")
    want = {(r.user_name, r.start_time): r.cnt for r in batch.collect()}
    assert final == want


def test_counter_stream_restart_after_idle_stop(spark, tmp_path):
    """Stopped while idle (the last batch committed), restarted: still exactly once."""
    ckpt = checkpoint_location(spark, "counter-idle")
    out = str(tmp_path / "counter_idle_out")
    for _ in range(2):
        q = start(counter_stream(spark, subtasks=2, rows_per_batch=5), _name("cnti"), sink="parquet",
                  checkpoint=ckpt, trigger={"processingTime": "2 seconds"}, path=out)
        try:
            t0 = time.time()
            while time.time() - t0 < 60 and (q.lastProgress is None or q.status["isTriggerActive"]):
                time.sleep(0.1)
            time.sleep(0.5)
        finally:
            q.stop()
    seen = [tuple(r) for r in spark.read.parquet(out).collect()]
    for s in (0, 1):
        vals = sorted(v for sub, v in seen if sub == s)
        assert vals == list(range(len(vals))) and len(vals) >= 10


def test_user_count_append_emits_each_window_once(spark, tmp_path):
    """A2 + K3 in append mode: a window appears once, after the watermark passes its end; late rows
    are dropped; open windows are not emitted."""
    folder = str(tmp_path / "lines")
    os.makedirs(folder)
    stream = user_count_stream(read_text_lines(spark, folder, stream=True, max_files_per_trigger=1), delay="1 minute")
    name = _name("append")
    q = start(stream, name, mode="append", trigger={"processingTime": "100 milliseconds"})
    try:
        for i, line in enumerate(["amy;2020-03-20 15:22:00", "amy;2020-03-20 15:22:59", "bob;2020-03-20 15:23:01",
                                  "cat;2020-03-20 15:26:00", "bob;2020-03-20 15:23:05", "dan;2020-03-20 15:40:00"]):
            with open(os.path.join(folder, f"f{i:02d}.txt"), "w") as fh:
                fh.write(line + "\n")
            drain(q, 60)
            time.sleep(0.4)
            drain(q, 60)
    finally:
        q.stop()
    rows = sorted((r.user_name, r.cnt, r.start_time.strftime("%H:%M")) for r in spark.table(name).collect())
    assert rows == [("amy", 2, "15:22"), ("bob", 1, "15:23"), ("cat", 1, "15:26")]


def test_word_count_windows_close_by_the_clock(spark, tmp_path):
    """A1 + T1 in append mode: the only line's windows come out without further lines, each word
    and window once."""
    folder = str(tmp_path / "words")
    os.makedirs(folder)
    with open(os.path.join(folder, "f0.txt"), "w") as fh:
        fh.write("a b a\n")
    stream = word_count_stream(read_text_lines(spark, folder, stream=True), size="2 seconds")
    name = _name("clock")
    q = start(stream, name, mode="append", trigger={"processingTime": "500 milliseconds"})
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table(name).count() < 2:
            time.sleep(0.5)
        time.sleep(3)
    finally:
        q.stop()
    rows = [(r.word, r.n) for r in spark.table(name).collect()]
    assert sorted(rows) == [("a", 2), ("b", 1)]


def test_state_processors_fail_or_keep_nulls_as_documented(spark, tmp_path, no_empty_batches):
    """A null value fails the count window; the buffer keeps null payload fields and null order
    values (first) over a restart."""
    schema = "seq int, bucket int, word string, n int"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    ckpt = checkpoint_location(spark, "nulls")
    for i, rows in enumerate(([(2, 0, "b", None), (None, 0, "a", 1)], [(3, 0, None, 5), (4, 0, "d", 2)])):
        _write_json(spark, rows, schema, folder, i)
        q = deliver_batches(buffered_stream(_stream(spark, folder, schema), "bucket", "seq", ["word", "n"], 3), out,
                            _name("nulls"), checkpoint=ckpt, trigger={"availableNow": True})
        assert q.awaitTermination(120)
    got = [(r.batch_no, r.word, r.n) for r in spark.read.parquet(out).collect()]
    assert sorted(got, key=str) == sorted([(0, "a", 1), (0, "b", None), (0, None, 5)], key=str)
    _write_json(spark, [(1, 1, None)], PAIRS_SCHEMA, str(tmp_path / "pairs"), 0)
    with pytest.raises(Exception, match="null in v"):
        run_available(count_window_stream(_stream(spark, str(tmp_path / "pairs"), PAIRS_SCHEMA), "k", "v", "seq"), _name("nv"))


def test_asof_versions_are_listed_for_each_batch(spark, tmp_path, no_empty_batches):
    from rivulet.streaming.runner import asof_join_batches
    schema = "pid int, k string, t int"
    folder, table, out, ckpt = str(tmp_path / "p"), str(tmp_path / "v"), str(tmp_path / "o"), checkpoint_location(spark, "versions")
    versions = lambda: spark.read.parquet(table)
    for i, version in enumerate([("a", 1, "v1"), ("a", 2, "v2")]):
        spark.createDataFrame([version], "k string, t int, val string").write.mode("append").parquet(table)
        _write_json(spark, [(i, "a", 9)], schema, folder, i)
        q = asof_join_batches(_stream(spark, folder, schema), versions, ["k"], "t", "t", ["val"], out, _name("ver"),
                              checkpoint=ckpt, trigger={"availableNow": True})
        assert q.awaitTermination(120)
    assert sorted((r.pid, r.version_val) for r in spark.read.parquet(out).collect()) == [(0, "v1"), (1, "v2")]
