"""Line dedup over range-partitioned line hashes, answered as keep bitmaps.

1. Every document is cut at ``\\n``; a line's key (stripped, A-Z lower-cased) is hashed to 128
   bits.  Only (hash, document, position) rows are shuffled, never text.
2. They are range-partitioned by (hash, document) with the position as secondary sort.  A line
   that a third of all documents hold is spread over several ranges, as the document is part of
   the range key.  A pass over each sorted run flags first occurrences within a document; these
   are summed map-side to document counts per hash.
3. Hashes in at least ``min_docs`` documents are joined back to the ranged rows (Spark picks the
   join by measured size and splits skew).
4. Dropped positions are gathered per document and turned into a keep bitmap, compressed as runs
   ``(start, length)`` of kept lines.  Documents that lose no line have no row.

Edge cases: a null text counts as one empty line; keys under ``min_chars`` code points are never
dropped; a document is an (id, text) pair, so rows that repeat both count once and get the same
bitmap, and rows that share only the id (null ids too) are kept apart by a 64-bit text hash;
further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import SPACE_CHARS, bit_table, row_digest, stored, text_or_empty, with_may_match


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE_CHARS)), string.ascii_uppercase, string.ascii_lowercase)


def line_keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 2,
                      min_chars: int = 1, keep_first: bool = True) -> DataFrame:
    """``(id, text_hash, n_lines, n_dropped, keep_runs)`` of documents that lose lines.

    Lines whose key occurs in ``min_docs`` documents or more are dropped; with ``keep_first`` the
    first occurrence over all documents (least id, nulls last, then text hash and position)
    stays.
    """
    source = text_or_empty(text)
    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(source).alias("text_hash"), F.split(source, "\n").alias("_lines"))
    lines = docs.select("id", "text_hash", F.size("_lines").alias("n_lines"), F.posexplode("_lines").alias("pos", "line"))
    lines = lines.withColumn("line", line_key(F.col("line"))).where(F.length("line") >= min_chars)
    lines = lines.select("id", "text_hash", "n_lines", "pos", row_digest(F.col("line")).alias("k")).select(
        "id", "text_hash", "n_lines", "pos", F.col("k.a").alias("ka"), F.col("k.b").alias("kb"))
    lines = stored(lines, "lines")  # narrow rows; the range sampling and both uses read these

    ranged = lines.repartitionByRange("ka", "kb", "id", "text_hash")
    in_doc = Window.partitionBy("ka", "kb", "id", "text_hash").orderBy("pos")
    firsts = ranged.withColumn("nth", F.row_number().over(in_doc)).where("nth = 1")
    counted = [F.count(F.lit(1)).alias("docs")]
    if keep_first:
        counted.append(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash", "pos")).alias("first"))
    frequent = firsts.groupBy("ka", "kb").agg(*counted).where(F.col("docs") >= min_docs)
    doomed = ranged.join(frequent, ["ka", "kb"])
    if keep_first:
        doomed = doomed.where(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash"))
                                & (F.col("pos") == F.col("first.pos"))))
    dropped = doomed.groupBy("id", "text_hash").agg(F.first("n_lines").alias("n_lines"),
                                                    F.array_sort(F.collect_set("pos")).alias("_p"))
    return dropped.select(F.col("id").alias(id_col), "text_hash", "n_lines", F.size("_p").alias("n_dropped"),
                          keep_runs(F.col("_p"), F.col("n_lines")).alias("keep_runs"))


def keep_runs(dropped: Column, n: Column) -> Column:
    """Runs of kept positions among 0..n-1, given the sorted dropped positions."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda x: x + 1))
    ends = F.concat(dropped, F.array(n))
    runs = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (e - s).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def apply_bitmaps(df: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` plus ``n_lines``, ``n_dropped`` and ``kept_text``.  Only texts that may lose a line
    are moved to their bitmap (by document); a bit set of fixed size tells the others."""
    bitmaps = stored(bitmaps, "line-bitmaps")
    marks = bitmaps.select(F.col(id_col).alias("_line_id"), F.col("text_hash").alias("_line_hash"),
                           F.struct("n_dropped", "keep_runs").alias("_line_mark"))
    source = text_or_empty(text)
    rows = df.withColumns({"_line_own": F.xxhash64(source), "_line_all": F.split(source, "\n"), "_line_text": source})
    rows = rows.withColumn("n_lines", F.size("_line_all").cast("bigint"))
    rows = with_may_match(rows, F.col("_line_own"), bit_table(bitmaps, F.col("text_hash")), "_line_may")
    moved = rows.where("_line_may").join(
        marks, F.col(id_col).eqNullSafe(F.col("_line_id")) & (F.col("_line_own") == F.col("_line_hash")), "left")
    mark = F.col("_line_mark")
    kept = F.flatten(F.transform(mark["keep_runs"], lambda r: F.slice("_line_all", r["start"] + 1, r["length"])))
    moved = moved.withColumns({
        "n_dropped": F.coalesce(mark["n_dropped"], F.lit(0)).cast("bigint"),
        "kept_text": F.when(mark.isNull(), F.col("_line_text")).otherwise(F.array_join(kept, "\n")),
    })
    whole = rows.where(~F.col("_line_may")).withColumns({"n_dropped": F.lit(0).cast("bigint"), "kept_text": F.col("_line_text")})
    columns = [c for c in df.columns if c not in ("n_lines", "n_dropped", "kept_text")] + ["n_lines", "n_dropped", "kept_text"]
    return moved.select(*columns).union(whole.select(*columns))
