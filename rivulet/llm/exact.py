"""Exact deduplication as a stateful stream with disk-backed keyed state.

1. Every document is reduced to a digest row: SHA-256 of its normalised text, its id and its
   content locator (input file, row in the file).  Texts are not moved.
2. A Structured Streaming aggregation keyed by digest runs over the digest rows.  Its state --
   RocksDB on the executors' disks, checkpointed to the shared folder, never expired -- holds the
   row that stays (least id, then locator) and the group's size.  A restart resumes from the
   checkpoint; ``observe`` can also be pointed at an endless stream.
3. The final state is read back as a table (``statestore`` source) and joined to the digest rows.
4. Hits are checked on full bytes: of every group with a hit the least and the greatest text are
   compared.  Should they differ in spite of the digest, the group is split by its bytes.  A bit
   set of fixed size keeps texts without a hit out of this step.

Only built-in functions run.  A group that holds a third of all rows is pre-aggregated map-side
before the state and in step 4; the join back is on narrow rows and split by AQE.

Edge cases: a null text counts as empty; null ids order last (``keep_id`` is null only if the
whole group has null ids); of rows that share text and id exactly one stays, decided by the
locator; further columns are ignored; an empty table gives an empty result.  Frames that do not
come straight from files have no locators, so they are written to the shared folder first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import SPACE_CLASS, bit_table, broadcast_below, shared_folder, stored, text_or_empty, with_may_match

BROADCAST_ROWS = 100_000  # locators that are broadcast instead of shuffling the documents
# Close a partition's store once it has committed: an open one reserves several MB of local disk.
UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"
FILES_PER_TRIGGER = 1000  # digest files that one micro-batch takes


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE_CLASS + "+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id, text, file, row``: the frame with its content locators."""
    narrow = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        return narrow.select("id", "text", *place)
    except AnalysisException:  # not read from files
        return stored(narrow, "exact-input").select("id", "text", *place)


def observe(stream: DataFrame) -> DataFrame:
    """Streaming frame of digest rows -> the keyed state as an update stream."""
    stay = F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")
    return stream.groupBy("digest").agg(F.min(stay).alias("stay"), F.count(F.lit(1)).alias("n"))


def run_state(digests: str, schema, spark, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Stream the stored digest rows through the state; the final state as a table."""
    place = shared_folder(spark, "exact-state")
    before = spark.conf.get(UNLOAD)
    spark.conf.set(UNLOAD, "true")  # read when the stream starts
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(digests)
    query = (observe(stream).writeStream.format("noop").outputMode("update").option("checkpointLocation", place)
             .trigger(availableNow=True).start())
    spark.conf.set(UNLOAD, before)
    query.awaitTermination()
    state = spark.read.format("statestore").load(place)
    return state.select("key.digest", F.col("value")[_field(state, "min")].alias("stay"),
                        F.col("value")[_field(state, "count")].alias("n"))


def _field(state: DataFrame, prefix: str) -> str:
    return next(f.name for f in state.schema["value"].dataType.fields if f.name.startswith(prefix))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text",
                 digest: Callable[[Column], Column] = sha256,
                 files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``digest`` (binary) and
    the locator ``file``, ``row``."""
    spark = df.sparkSession
    source = located(df, id_col, text).withColumn("norm", normalised("text")).drop("text")
    source = source.withColumn("digest", digest(F.col("norm")))
    rows = source.select("id", "digest", "file", "row")
    place = shared_folder(spark, "exact-digests")
    rows.write.parquet(place)
    schema = rows.schema
    rows = spark.read.schema(schema).parquet(place)
    if rows.isEmpty():
        groups = rows.select("digest", F.struct(F.lit(True).alias("none"), "id", "file", "row").alias("stay"),
                             F.lit(1).cast("bigint").alias("n"))
    else:
        groups = stored(run_state(place, schema, spark, files_per_trigger), "exact-groups")
    found = rows.join(groups, "digest")
    odd = _unequal(source, groups.where("n > 1"))
    if odd is not None:
        found = _regroup(found, odd)
    stays = (F.col("file") == F.col("stay.file")) & (F.col("row") == F.col("stay.row"))
    return found.select(F.col("id").alias(id_col), F.col("stay.id").alias("keep_id"), F.col("n").alias("group_size"),
                        stays.alias("kept"), "digest", "file", "row")


def _unequal(source: DataFrame, groups: DataFrame) -> DataFrame | None:
    """Rows whose digest stands for different bytes (None: there are none).  Per digest with a hit, the
    least and the greatest text are compared byte for byte; they are found with map-side combine."""
    key = F.xxhash64("digest")
    hits = with_may_match(source, key, bit_table(groups.select("digest"), key), "_hit").where("_hit")
    mixed = hits.groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("b")).where("a <> b").select("digest")
    mixed = stored(mixed, "exact-mixed")
    if mixed.isEmpty():
        return None
    return stored(hits.join(mixed, "digest").select("id", "digest", "file", "row", "norm"), "exact-odd")


def _regroup(found: DataFrame, odd: DataFrame) -> DataFrame:
    stay = F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")
    own = odd.groupBy("digest", "norm").agg(F.min(stay).alias("_stay"), F.count(F.lit(1)).alias("_n"))
    own = odd.join(own, ["digest", "norm"]).select("file", "row", "_stay", "_n")
    out = found.join(own, ["file", "row"], "left")
    return out.withColumn("n", F.coalesce("_n", "n")).withColumn("stay", F.coalesce("_stay", "stay")).drop("_stay", "_n")


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of a frame that stay, with all their columns (a frame not read from files is written
    to the shared folder first)."""
    place = [F.col("_metadata.file_path").alias("_dedup_file"), F.col("_metadata.row_index").alias("_dedup_row")]
    try:
        placed = df.select("*", *place)
    except AnalysisException:  # not read from files
        df = stored(df, "exact-input")
        placed = df.select("*", *place)
    groups = exact_groups(df, id_col, text)
    gone = stored(groups.where(~F.col("kept")).select(F.col("file").alias("_gone_file"), F.col("row").alias("_gone_row")), "exact-gone")
    gone = broadcast_below(gone, BROADCAST_ROWS)
    return placed.join(gone, (F.col("_dedup_file") == F.col("_gone_file")) & (F.col("_dedup_row") == F.col("_gone_row")),
                       "left_anti").drop("_dedup_file", "_dedup_row")
