"""Helpers shared by the operators: white space, words, lineage cuts, bounded broadcasts."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import checkpoint_root

# The six white-space characters of the text contracts, [\x20\x09-\x0D].
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """Words of a non-null text, in order (an empty array when there are none)."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def row_digest(text: Column) -> Column:
    """128 bits of a text as two longs (independent seeds): a fixed-width stand-in for equality."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the frame once as Parquet in the shared folder and read it back."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches_below(spark: SparkSession, size: int):
    """While a job is started in here, Arrow batches sent to Python end at ``size`` bytes: 10,000 long
    texts in one batch can take a worker hundreds of MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def broadcast_below(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a (stored, narrow) frame only if it is counted to hold at most ``rows`` rows;
    else leave the choice of join to Spark."""
    return F.broadcast(df) if df.count() <= rows else df


FILTER_BITS = 1 << 26
_PAGE = 4096 * 8  # bits of one bitmap that Spark's bitmap aggregate makes


def bit_table(keys: DataFrame, key: Column, bits: int = FILTER_BITS) -> DataFrame:
    """A bit set of fixed size over 64-bit keys: at most ``bits / 32768`` rows (page, bitmap) of
    4 KB, so it may be broadcast whatever the number of keys."""
    at = F.pmod(key, F.lit(bits)) + 1
    return keys.select(at.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("_bit_page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("_bit_map"))


def with_may_match(df: DataFrame, key: Column, table: DataFrame, out: str, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` plus ``out``: false only if the key is certainly not among the table's keys."""
    at = F.pmod(key, F.lit(bits))
    place = F.pmod(at, F.lit(_PAGE))
    joined = df.withColumns({"_bit_own": F.floor(at / _PAGE) + 1, "_bit_at": place}).join(
        F.broadcast(table), F.col("_bit_own") == F.col("_bit_page"), "left")
    byte = F.conv(F.hex(F.substring("_bit_map", F.floor(F.col("_bit_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.pmod(F.col("_bit_at"), F.lit(8)).cast("int")).bitwiseAND(F.lit(1))
    return joined.withColumn(out, F.coalesce(bit == 1, F.lit(False))).drop("_bit_own", "_bit_at", "_bit_page", "_bit_map")
