"""The registered action format, the sink with commit and abort, the table function, the counter's
change of subtasks and the sliding window of calls."""

import datetime
import decimal
import os
import random
import threading
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_streaming import _name, _stream, _write_json

from rivulet.functions.tables import register_table_functions
from rivulet.operators.enrich import _call_batches, async_lookup
from rivulet.operators.wordcount import split_words
from rivulet.session import checkpoint_location
from rivulet.sources import action_format
from rivulet.sources.action_format import ActionReader, Stretch, lines_of, register_action_format
from rivulet.sources.counter import counter_stream
from rivulet.sources.files import open_store
from rivulet.sources.user_actions import parse_user_actions
from rivulet.streaming.buffering import buffered_stream
from rivulet.streaming.group_sink import Part, GroupWriter, commits, deliver_groups, read_committed, remove_orphans
from rivulet.streaming.runner import start


@pytest.fixture
def no_empty_batches(spark):
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    yield
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")


# --- U7/S5: the registered format --------------------------------------------------------------

def _action_lines(n):
    return [f"{random.Random(i).choice(['ann', 'bob', '', 'é']) if i % 17 else ''};2024-01-{1 + i % 28:02d} {i % 24:02d}:00:{i % 60:02d}{';extra' if i % 5 == 0 else ''}" for i in range(n)]


@pytest.mark.parametrize("split", [1, 7, 40, 1 << 20])
def test_every_line_is_read_once_whatever_the_split(tmp_path, split):
    texts = {"a.txt": "x;1\nlonger line;2\n\nlast", "b.txt": "", "c.txt": "one\n", "d.txt": "\n\n\nend\n" + "y" * 50}
    for name, text in texts.items():
        path = str(tmp_path / name)
        with open(path, "w") as f:
            f.write(text)
        store, _ = open_store(path)
        size = os.path.getsize(path)
        got = [line for at in range(0, size, split) for some in lines_of(store, Stretch(path, at, min(size, at + split)), block=5) for line in some]
        assert got == text.encode().split(b"\n")[:None if not text.endswith("\n") and text else -1]


def test_action_format_equals_the_parsed_lines(spark, tmp_path):
    register_action_format(spark)
    lines = _action_lines(500)
    folder = str(tmp_path / "actions")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(folder)
    want = parse_user_actions(spark.createDataFrame([(x,) for x in lines], "value string"))
    view = _name("actions")
    spark.sql(f"CREATE TEMPORARY VIEW {view} USING {action_format.FORMAT} OPTIONS (path '{folder}', split_bytes '300')")
    got = spark.sql(f"SELECT user_name, CAST(user_action_time AS timestamp_ntz) AS user_action_time FROM {view}")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    late = spark.sql(f"SELECT * FROM {view} WHERE user_action_time >= TIMESTAMP '2024-01-20 00:00:00' AND user_name = 'ann'")
    assert late.count() == want.where("user_action_time >= '2024-01-20' and user_name = 'ann'").count() > 0
    stream = spark.readStream.format(action_format.FORMAT).option("path", folder).load()
    q = start(stream, name := _name("fmt"), trigger={"availableNow": True})
    assert q.awaitTermination(60) and spark.table(name).count() == 500


def test_time_filter_reaches_the_reader(spark, tmp_path):
    """The rows that leave the reader are already filtered: with Spark's own filter they are as many."""
    from pyspark.sql.datasource import GreaterThanOrEqual, IsNotNull
    import datetime as dt
    path = str(tmp_path / "x.txt")
    with open(path, "w") as f:
        f.write("\n".join(_action_lines(280)))
    reader = ActionReader({"path": path})
    since = dt.datetime(2024, 1, 27, tzinfo=dt.timezone.utc)
    filters = [IsNotNull(("user_action_time",)), GreaterThanOrEqual(("user_action_time",), since)]
    assert list(reader.pushFilters(filters)) == filters and len(reader.filters) == 2
    rows = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    assert rows == 20
    register_action_format(spark)
    df = spark.read.format(action_format.FORMAT).load(path).where(F.col("user_action_time") >= F.lit(since))
    assert df.count() == 20


def test_action_format_fails_on_malformed_lines(spark, tmp_path):
    register_action_format(spark)
    for i, text in enumerate(("no field\n", "a;not a time\n", "a;2024-01-01\n")):
        path = str(tmp_path / f"{i}.txt")
        with open(path, "w") as f:
            f.write(text)
        with pytest.raises(Exception):
            spark.read.format(action_format.FORMAT).load(path).collect()
    assert spark.read.format(action_format.FORMAT).load(str(tmp_path / "none")).count() == 0


# --- K2/U6: commit and abort -------------------------------------------------------------------

SCHEMA = "seq int, bucket int, word string"
OUT = "bucket int, batch_no bigint, word string"


def test_sink_shows_whole_batches_only_and_replays_once(spark, tmp_path, no_empty_batches):
    folder, path, ckpt = str(tmp_path / "in"), str(tmp_path / "sink"), checkpoint_location(spark, "sink")
    trap = str(tmp_path / "trap")

    def run(failing):
        stream = buffered_stream(_stream(spark, folder, SCHEMA), "bucket", "seq", ["word"], 2)
        if failing:
            def burst(batches):
                for b in batches:
                    yield b
                    if b.num_rows and os.path.exists(trap):
                        raise RuntimeError("task lost")
            stream = stream.mapInArrow(burst, stream.schema)
        q = deliver_groups(stream, path, _name("sink"), checkpoint=ckpt, trigger={"availableNow": True})
        if failing and os.path.exists(trap):
            with pytest.raises(Exception, match="task lost"):
                q.awaitTermination(120)
        else:
            assert q.awaitTermination(120)
        return sorted(r.word for r in read_committed(spark, path, OUT).collect())

    _write_json(spark, [(i, i % 3, f"a{i}") for i in range(12)], SCHEMA, folder, 0)
    first = run(False)
    assert first == sorted(f"a{i}" for i in range(12)) and [c["rows"] for c in commits(path)] == [12]
    _write_json(spark, [(i, i % 3, f"b{i}") for i in range(12)], SCHEMA, folder, 1)
    open(trap, "w").close()
    assert run(True) == first  # the failed batch is not seen, not even in part
    os.remove(trap)
    both = run(False)
    assert both == sorted(first + [f"b{i}" for i in range(12)])
    # The last batch runs again, as after a crash between the sink's commit and Spark's.
    last = max(int(x) for x in os.listdir(os.path.join(ckpt, "commits")) if x.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(ckpt, "commits", name)):
            os.remove(os.path.join(ckpt, "commits", name))
    assert run(False) == both and [c["batch"] for c in commits(path)] == [0, 1]
    listed = {p for c in commits(path) for p in c["parts"]}
    remove_orphans(path)
    assert set(os.listdir(os.path.join(path, "_parts"))) == listed and run(False) == both


def test_sink_abort_and_empty_batches(tmp_path):
    path = str(tmp_path / "sink")
    writer = GroupWriter(path)
    batch = pa.RecordBatch.from_pydict({"word": ["a", "b"]})
    kept, gone, none = writer.write(iter([batch, batch])), writer.write(iter([batch])), writer.write(iter([batch.slice(0, 0)]))
    assert (kept.rows, gone.rows, none) == (4, 2, Part("", 0))
    writer.abort([gone, None, none], 0)
    writer.commit([kept, none, None], 0)
    writer.commit([none], 1)
    assert [(c["batch"], c["rows"], len(c["parts"])) for c in commits(path)] == [(0, 4, 1), (1, 0, 0)]
    assert os.listdir(os.path.join(path, "_parts")) == [kept.name]


# --- U2: the table function --------------------------------------------------------------------

def test_split_words_with_lateral_takes_many_lines_at_a_time(spark):
    """Not a batch per line: that took twice as long. Values passed on keep their types."""
    register_table_functions(spark)
    df = spark.createDataFrame([(i, "a  b%d " % i) for i in range(300)] + [(300, None), (301, "  "), (302, "")], "id int, value string")
    got = spark.sql("SELECT id, w.* FROM {df}, LATERAL split_words(value, ' ', day => DATE'2020-02-29', price => 1.50BD) AS w", df=df)
    assert "ArrowEvalPython" not in got._jdf.queryExecution().executedPlan().toString()
    passed = (datetime.date(2020, 2, 29), decimal.Decimal("1.50"))
    want = [(i, no, word, *passed) for i in range(300) for no, word in enumerate(["a", "", "b%d" % i], 1)] + [(302, 1, "", *passed)]
    assert sorted(map(tuple, got.collect())) == want


def test_split_words_with_lateral(spark):
    register_table_functions(spark)
    rows = [(1, "a b  c "), (2, ""), (3, "   "), (4, None), (5, " lead"), (6, "tab\tno split"), (7, "é 日")]
    df = spark.createDataFrame(rows, "id int, value string")
    got = spark.sql("SELECT id, w.word_no, w.word FROM {df}, LATERAL split_words(value) AS w", df=df).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, split_words(df.where("value is not null"), keep=("id",)).collect()))
    wide = spark.sql("SELECT w.* FROM {df}, LATERAL split_words(value, 'b', part => 7, tag => 'x') AS w WHERE id = 1", df=df)
    assert wide.columns == ["word_no", "word", "part", "tag"] and sorted(map(tuple, wide.collect())) == [(1, "a ", 7, "x"), (2, "  c ", 7, "x")]
    for bad in ("split_words(1)", "split_words('a', 'too long')", "split_words('a', CAST(NULL AS STRING))"):
        with pytest.raises(Exception, match="split_words"):
            spark.sql(f"SELECT * FROM {bad}").collect()


# --- S3/U5: another number of subtasks ---------------------------------------------------------

@pytest.mark.parametrize("counts", [(2, 3), (3, 1, 3)])
def test_counter_goes_on_with_another_number_of_subtasks(spark, tmp_path, counts):
    ckpt, out = checkpoint_location(spark, "rescale"), str(tmp_path / "out")
    for n in counts:
        q = start(counter_stream(spark, subtasks=n, rows_per_batch=5), _name("cnt"), sink="parquet", checkpoint=ckpt,
                  trigger={"processingTime": "100 milliseconds"}, path=out)
        first, deadline = None, time.time() + 60
        while time.time() < deadline:
            p = q.lastProgress
            first = p["batchId"] if p and first is None else first
            if p and p["batchId"] >= first + 3:
                break
            time.sleep(0.1)
        q.stop()
    seen = [tuple(r) for r in spark.read.parquet(out).collect()]
    for s in range(max(counts)):
        values = sorted(v for sub, v in seen if sub == s)
        assert values == list(range(len(values))) and len(values) >= 10, s


# --- J3: calls in flight over batch borders ----------------------------------------------------

class Slow:
    """Answers at once but for keys that begin with ``s``; counts the calls in flight."""

    def __init__(self, wait=0.4):
        self.wait, self.now, self.most, self.lock = wait, 0, 0, threading.Lock()

    def __call__(self, key):
        with self.lock:
            self.now += 1
            self.most = max(self.most, self.now)
        time.sleep(self.wait if key.startswith("s") else 0)
        with self.lock:
            self.now -= 1
        return key.upper()


def _batches(keys, size):
    return [pa.RecordBatch.from_pydict({"i": list(range(at, at + len(keys[at:at + size]))), "_async_key": pa.array(keys[at:at + size], pa.string())})
            for at in range(0, len(keys), size)]


def test_slow_calls_of_several_batches_overlap():
    keys = [("s" if i % 10 == 0 else "k") + str(i) for i in range(80)]  # one slow call in each of 8 batches
    client = Slow()
    began = time.monotonic()
    out = list(_call_batches(iter(_batches(keys, 10)), ["i", "info"], lambda: client, 5, 100, 30, "timeout"))
    assert time.monotonic() - began < 1.6  # one after the other they would take 3.2 s
    assert [x for b in out for x in b.column("info").to_pylist()] == [k.upper() for k in keys]
    assert [x for b in out for x in b.column("i").to_pylist()] == list(range(80))


def test_window_is_full_over_batch_borders_and_never_more():
    keys = [f"s{i}" for i in range(40)] + [None, "s0", None]
    client = Slow(0.05)
    out = list(_call_batches(iter(_batches(keys, 3)), ["i", "info"], lambda: client, 5, 8, 30, "timeout"))
    assert client.most == 8
    assert [x for b in out for x in b.column("info").to_pylist()] == [k and k.upper() for k in keys]


def test_timeouts_and_failures_in_the_window():
    out = list(_call_batches(iter(_batches(["a", "s1", "b", "s2"], 1)), ["i", "info"], lambda: Slow(0.6), 0.1, 2, 4, "timeout"))
    assert [b.column("info")[0].as_py() for b in out] == ["A", "timeout", "B", "timeout"]

    def fails(key):
        raise KeyError(key)

    with pytest.raises(KeyError):
        list(_call_batches(iter(_batches(["a"], 1)), ["i", "info"], lambda: fails, 1, 2, 2, "timeout"))
    assert list(_call_batches(iter([]), ["i", "info"], lambda: fails, 1, 2, 2, "timeout")) == []


def test_async_lookup_still_gives_one_row_each(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else f"k{i % 5}") for i in range(200)], "i int, k string")
    got = async_lookup(df, "k", lambda: lambda key: key.upper(), tasks=2).collect()
    assert sorted((r.i, r.info) for r in got) == [(i, None if i % 7 == 0 else f"K{i % 5}") for i in range(200)]
