"""The user-action table source as a Spark format (S4/S5/U7): ``USING rivulet_user_actions``.

Text files of ``name;yyyy-MM-dd HH:mm:ss`` lines become ``(user_name string, user_action_time timestamp)``, from
``spark.read.format``, ``readStream.format`` or ``CREATE TEMPORARY VIEW ... USING``.  Option ``path``: a folder or
file that driver and executors share; ``split_bytes``: bytes of a task's stretch of a file (default 32 MB).

Filters on the time are pushed to the reader (comparisons with a literal, null tests) and applied to
each Arrow batch before rows go to the JVM; set ``spark.sql.python.filterPushdown.enabled``
(``register_action_format`` does).  A pushed filter is also kept by Spark, so a reader that ignored it would still
give the right rows.

The stream takes files in order of (modification time, path); its offset is the last file taken, so files
must appear whole (moved into place) and not with an older time than one already taken.

Lines are parsed as by ``parse_user_actions``: a missing field or a malformed time fails the query; further
fields are ignored; empty files have no line.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan,
    LessThanOrEqual,
)

from rivulet.sources.files import listed, open_store

FORMAT = "rivulet_user_actions"
SCHEMA = "user_name string, user_action_time timestamp"
SPLIT_BYTES = 32 << 20
_COMPARISONS = {EqualTo: "equal", GreaterThan: "greater", GreaterThanOrEqual: "greater_equal", LessThan: "less", LessThanOrEqual: "less_equal"}


class Stretch(InputPartition):
    """Lines that begin in ``[start, stop)`` of a file."""

    def __init__(self, path: str, start: int, stop: int):
        super().__init__((path, start, stop))
        self.path, self.start, self.stop = path, start, stop


def stretches(files, split_bytes: int) -> list[Stretch]:
    return [Stretch(path, at, min(at + split_bytes, size)) for path, size, _ in files for at in range(0, size, split_bytes)]


def lines_of(store, part: Stretch, block: int = 1 << 20):
    """Lists of the stretch's lines (bytes): a line belongs to the stretch in which it begins."""
    with store.open_input_file(part.path) as f:
        at = part.start
        rest = b""
        if at:  # the line that runs over the start belongs to the stretch before
            f.seek(at - 1)
            at -= 1
            while True:
                piece = f.read(block)
                cut = piece.find(b"\n")
                if not piece or cut >= 0:
                    break
                at += len(piece)
            if not piece:
                return
            at += cut + 1
            f.seek(at)
        first = at  # where ``rest`` begins
        while first < part.stop:
            piece = f.read(block)
            data = rest + piece
            if not piece:
                if data:
                    yield [data]
                return
            *whole, rest = data.split(b"\n")
            took = []
            for line in whole:
                if first >= part.stop:
                    break
                took.append(line)
                first += len(line) + 1
            if took:
                yield took


def parsed(lines: list[bytes], filters):
    """An Arrow batch of the lines' actions that pass the filters."""
    import pyarrow as pa
    import pyarrow.compute as pc

    text = pa.array([line.removesuffix(b"\r") for line in lines], pa.binary()).cast(pa.string())
    fields = pc.split_pattern(text, ";")
    if len(fields) and pc.min(pc.list_value_length(fields)).as_py() < 2:
        raise ValueError("a line has no second field")
    times = pc.strptime(pc.list_element(fields, 1), format="%Y-%m-%d %H:%M:%S", unit="us").cast(pa.timestamp("us", tz="UTC"))
    columns = {"user_name": pc.list_element(fields, 0), "user_action_time": times}
    batch = pa.RecordBatch.from_pydict(columns)
    for name, comparison, value in filters:
        keep = pc.is_valid(columns[name]) if comparison == "set" else getattr(pc, comparison)(columns[name], pa.scalar(value, columns[name].type))
        batch = batch.filter(keep)
        columns = dict(zip(batch.schema.names, batch.columns))
    return batch


class ActionReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split_bytes = options["path"], int(options.get("split_bytes", SPLIT_BYTES))
        self.filters: list[tuple] = []

    def pushFilters(self, filters):
        """Takes what it can compare; every filter goes back to Spark as well."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in ("user_name", "user_action_time") and isinstance(f, IsNotNull):
                self.filters.append((column, "set", None))
            elif column in ("user_name", "user_action_time") and type(f) in _COMPARISONS and f.value is not None:
                self.filters.append((column, _COMPARISONS[type(f)], f.value))
            yield f

    def partitions(self):
        return stretches(listed(self.path), self.split_bytes) or [Stretch("", 0, 0)]

    def read(self, partition):
        if partition.stop > partition.start:
            store, _ = open_store(self.path)
            for lines in lines_of(store, partition):
                yield parsed(lines, self.filters)


class ActionStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.split_bytes = options["path"], int(options.get("split_bytes", SPLIT_BYTES))

    def initialOffset(self):
        return {"time": -1, "path": ""}

    def latestOffset(self):
        files = listed(self.path)
        return {"time": files[-1][2], "path": files[-1][0]} if files else self.initialOffset()

    def partitions(self, start, end):
        low, high = ((x["time"], x["path"]) for x in (start, end))
        return stretches([f for f in listed(self.path) if low < (f[2], f[0]) <= high], self.split_bytes) or [Stretch("", 0, 0)]

    def read(self, partition):
        if partition.stop > partition.start:
            store, _ = open_store(self.path)
            for lines in lines_of(store, partition):
                yield parsed(lines, ())


class ActionDataSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ActionReader(self.options)

    def streamReader(self, schema):
        return ActionStreamReader(self.options)


def register_action_format(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ActionDataSource)
