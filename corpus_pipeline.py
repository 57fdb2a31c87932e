"""Corpus pipeline: quality rules, exact dedup, SimHash near-dedup, source mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the one before kept;
``run`` writes every stage's result as Parquet in the shared folder and reads it back for the
next.  All stages but the last return the columns of ``documents``; the last returns a row per
packed piece.  Rows are never capped or sampled.

Edge cases follow the operators: null texts count as empty (the quality rules reject them), the
dedup stages decide per row, so rows with null or repeated ids go only if their own text is a
copy, empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import broadcast_below, stored
from rivulet.llm.exact import drop_exact_duplicates
from rivulet.llm.mixing import mix_sources
from rivulet.llm.packing import pack_documents
from rivulet.llm.quality import kept_documents
from rivulet.llm.queries import tokenizer_path
from rivulet.llm.simhash import simhash_groups
from rivulet.llm.units import tokenizer_settings
from rivulet.session import configure
from rivulet.sources.tables import read_table

# Memory beside the heap: Arrow batches by bytes (texts may be long), one bounded store cache per executor.
BOUNDED = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}
BROADCAST_IDS = 200_000  # rows of (file, row) that are broadcast instead of shuffling the texts


def _prepare(spark: SparkSession) -> None:
    configure(spark)
    for key, value in BOUNDED.items():
        spark.conf.set(key, value)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    _prepare(spark)
    return kept_documents(docs)


def keep_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the least id."""
    _prepare(spark)
    return drop_exact_duplicates(docs)


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` plus the content locator of each row (input file, row in the file)."""
    place = [F.col("_metadata.file_path").alias("_near_file"), F.col("_metadata.row_index").alias("_near_row")]
    try:
        return docs.select("*", *place)
    except AnalysisException:  # not read from files
        return stored(docs, "near-input").select("*", *place)


def keep_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, one row: the least id (nulls last), then locator."""
    _prepare(spark)
    placed = _placed(docs)
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_near_file").alias("file"),
                   F.col("_near_row").alias("row"))
    groups = simhash_groups(placed.select(row.alias("place"), "text"), id_col="place", shingle=3, max_bits=2)
    gone = stored(groups.where((F.col("place.file") != F.col("component_id.file")) | (F.col("place.row") != F.col("component_id.row")))
                  .select(F.col("place.file").alias("_gone_file"), F.col("place.row").alias("_gone_row")), "near-gone")
    return placed.join(broadcast_below(gone, BROADCAST_IDS),
                       (F.col("_near_file") == F.col("_gone_file")) & (F.col("_near_row") == F.col("_gone_row")),
                       "left_anti").drop("_near_file", "_near_row")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    _prepare(spark)
    mixed = mix_sources(docs.select("*", F.struct("*").alias("_document")))
    taken = mixed.where("copies > 0").select("_document", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return taken.select("_document.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 1024 ids."""
    _prepare(spark)
    packed = pack_documents(docs, tokenizer_settings(tokenizer_path("byte_bpe_50k.json")), end_id=2, size=1024)
    return packed.select("doc_id", "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("quality rules", keep_quality),
    ("exact dedup", keep_exact),
    ("SimHash near-dedup", keep_near),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: Tokenisation and packing cannot be expressed in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    _prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
