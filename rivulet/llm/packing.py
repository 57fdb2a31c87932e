"""Best-fit packing by minimum bin slack over piece lengths.

1. Documents are tokenised and cut into pieces of at most ``size`` tokens (the first piece takes
   the remainder).  Pieces are written once, without their ids unless asked for.
2. The histogram of piece lengths -- at most ``size`` rows, whatever the input -- is planned:
   the longest length left seeds a bin, a bitset subset-sum over the lengths left (each as often
   as it is left) finds the fullest feasible combination, and that combination is removed as
   often as the histogram holds it.  A combination is removed until some length no longer has
   the copies it needs, so there are at most about ``size * ln(size)`` combinations.
3. Pieces of one length are numbered without bringing them together: hash buckets number their
   own rows, and the buckets' counts give each its first number.  A length that a third of all
   pieces share is spread over all buckets.
4. The number falls into a slot of the plan, which gives sequence and offset.

Edge cases: a null or empty text is one piece holding the end id; null or repeated ids and equal
texts are packed row by row; pieces that tie in every column are interchangeable; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import stored
from rivulet.llm.units import encoder


def token_pieces(df: DataFrame, settings: str, end_id: int, size: int, id_col: str = "doc_id",
                 text: str = "text", with_ids: bool = False) -> DataFrame:
    """``(id, piece, start, length, crc[, ids])``: ids are little-endian unsigned 32-bit."""
    columns = {"id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int32(), "crc": pa.int64()}
    columns |= {"ids": pa.binary()} if with_ids else {}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encode = encoder(settings).encode
        end, out = end_id.to_bytes(4, "little"), pa.schema(list(columns.items()))
        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(raw or b"") + end
                n = len(ids) // 4
                at, stop, piece = 0, n % size or size, 0
                while at < n:
                    part = ids[4 * at:4 * stop]
                    rows.append((doc, piece, at, stop - at, zlib.crc32(part), part)[:len(columns)])
                    at, stop, piece = stop, stop + size, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(columns), out.types)], schema=out)

    shape = "id bigint, piece int, start bigint, length int, crc bigint" + (", ids binary" if with_ids else "")
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("binary").alias("text")).mapInArrow(cut, shape)


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The multiset of lengths with the largest sum up to ``room``, as (length, copies)."""
    reach, steps, everything = 1, [], (1 << room + 1) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= reach << length * k & everything
            left, k = left - k, 2 * k
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            total -= length * k
            taken[length] = taken.get(length, 0) + k
    return sorted(taken.items(), reverse=True)


def plan_bins(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(times, [(length, copies), ...])`` until nothing is left."""
    left, plan = {x: n for x, n in counts.items() if n > 0}, []
    while left:
        seed = max(left)
        others = {x: n - (x == seed) for x, n in left.items() if n - (x == seed)}
        chosen = dict(fullest(others, size - seed))
        chosen[seed] = chosen.get(seed, 0) + 1
        times = min(left[x] // n for x, n in chosen.items())
        plan.append((times, sorted(chosen.items(), reverse=True)))
        for x, n in chosen.items():
            left[x] -= times * n
            if not left[x]:
                del left[x]
    return plan


def slots(plan: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first, past, sequence, copies, offset)``: the pieces of this length numbered
    first..past-1 go ``copies`` at a time into the sequences from ``sequence`` on."""
    rows, used, sequence = [], {}, 0
    for times, chosen in plan:
        offset = 0
        for length, copies in chosen:
            first = used.get(length, 0)
            used[length] = first + times * copies
            rows.append((length, first, used[length], sequence, copies, offset))
            offset += length * copies
        sequence += times
    return rows


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """A stored table of pieces plus ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= size rows
    table = spark.createDataFrame(slots(plan_bins(counts, size)),
                                  "slot_length int, first bigint, past bigint, sequence bigint, copies int, slot_offset int")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("id", "piece", "crc"), F.lit(parts)))
    own = Window.partitionBy("length", "_bucket").orderBy("id", "piece", "crc")
    dealt = dealt.withColumn("_nth", F.row_number().over(own) - 1)
    totals = pieces.select("length", F.pmod(F.xxhash64("id", "piece", "crc"), F.lit(parts)).alias("_bucket")).groupBy(
        "length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = dealt.join(totals, ["length", "_bucket"]).withColumn("_at", F.col("_nth") + F.col("_before"))
    placed = numbered.join(F.broadcast(table), (F.col("length") == F.col("slot_length"))
                           & (F.col("_at") >= F.col("first")) & (F.col("_at") < F.col("past")))
    j = F.col("_at") - F.col("first")
    return placed.select(*pieces.columns, (F.col("sequence") + F.floor(j / F.col("copies"))).cast("bigint").alias("sequence_id"),
                         (F.col("slot_offset") + F.pmod(j, F.col("copies").cast("bigint")) * F.col("length")).cast("bigint").alias("offset"))


def pack_documents(df: DataFrame, settings: str, end_id: int = 2, size: int = 1024, id_col: str = "doc_id",
                   text: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    pieces = stored(token_pieces(df, settings, end_id, size, id_col, text, with_ids), "pieces")
    return pack(pieces, size).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` of pieces packed ``with_ids`` (a sequence holds ``size`` ids at most)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.transform(parts, lambda x: x["ids"]).alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))
