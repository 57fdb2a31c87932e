"""Canonical length-limited Huffman coding of token ids, written and read as a table of blocks.

Writing:
1. Texts are range-partitioned by id and a hash of the text and sorted, tokenised in that order and written as plain
   ids (one row per document with its part and its place in the part).
   Each part ends with a row of its own (``seq`` -1) that holds its counts of ids.
2. The parts' counts are summed; the sums -- a row per id of the vocabulary -- give code lengths of
   at most ``max_bits`` by package-merge.
3. Every task encodes its documents into independent blocks of whole documents: one bit string,
   with the bit offset of every ``STRIDE``-th id as a checkpoint.

The file format is a folder of Parquet tables, so Spark's committer covers lost tasks:
``codes`` (id, bits), ``blocks`` (part, seq, before, doc_ids, doc_tokens, tokens, bits,
checkpoints, payload; ``before`` counts the part's ids before the block) and the plain ids in ``plain``.  Payloads hold codes from the highest bit on.

Reading: the canonical table is rebuilt from ``codes``; a table of 2^max_bits entries gives id and
length of the next code, and all stretches between checkpoints of a batch are decoded in step.
A document's place in the whole is its part's start (a running sum over the parts, one row per
range partition) plus its place in the part.

Edge cases: a null or empty text has the end id only; null ids come first; rows that share an id
are ordered by text and kept apart; further columns are ignored; an empty table gives empty
tables; a vocabulary with a single used id gets one-bit codes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_batches_below
from rivulet.llm.units import encoder, id_kind  # by name: its code is shipped with the functions that use it

MAX_BITS = 18
STRIDE = 512
BLOCK_TOKENS = 1 << 17
BATCH_BYTES = 4 << 20  # of text sent to a worker at once

_PLAIN = "part int, seq bigint, before bigint, id bigint, ids binary"
_BLOCKS = ("part int, seq bigint, before bigint, doc_ids array<bigint>, doc_tokens array<int>, tokens bigint, "
           "bits bigint, checkpoints array<bigint>, payload binary")


def _dtype(kind: str) -> str:
    return {"H": "<u2", "I": "<u4"}[kind]


def write_plain(df: DataFrame, path: str, settings: str, end_id: int, id_col: str, text: str) -> DataFrame:
    """Tokenise in order of id; ``ids`` are little-endian unsigned of 16 or 32 bits (``id_kind``)."""
    kind = id_kind(settings)
    dtype, width = _dtype(kind), 2 if kind == "H" else 4

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        names = ["part", "seq", "before", "id", "ids"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        encode, end = encoder(settings, kind).encode, end_id.to_bytes(width, "little")
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            n = batch.num_rows
            ids = [encode(raw or b"") + end for raw in batch.column(1).to_pylist()]
            own = np.bincount(np.frombuffer(b"".join(ids), dtype=dtype), minlength=len(total))
            own[:len(total)] += total
            total = own
            places = list(accumulate((len(x) // width for x in ids), initial=before))
            columns = [[part] * n, range(seq, seq + n), places[:-1], batch.column(0), ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            seq, before = seq + n, places[-1]
        if seq:
            used = np.nonzero(total)[0]
            counts = np.stack([used, total[used]], axis=1).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([part, -1, before, None, counts], types)], names=names)

    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).cast("binary").alias("text"))
    # The hash of the text divides rows that share an id (or have none); only it and the id are sampled for the ranges.
    docs = docs.withColumn("_dealt", F.xxhash64("text"))
    docs = docs.repartitionByRange("id", "_dealt").sortWithinPartitions("id", "_dealt", "text").drop("_dealt")
    with arrow_batches_below(df.sparkSession, BATCH_BYTES):
        docs.mapInArrow(tokenise, _PLAIN).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(_PLAIN).parquet(path)


def token_counts(plain: DataFrame) -> DataFrame:
    """``(token, n)`` over all parts; only the row groups that hold a part's counts are read."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                pairs = np.frombuffer(raw, dtype="<i8").reshape(-1, 2)
                total = np.concatenate([total, np.zeros(max(0, pairs[-1, 0] + 1 - len(total)), dtype=np.int64)])
                total[pairs[:, 0]] += pairs[:, 1]
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["token", "n"])

    return plain.where("seq = -1").select("ids").mapInArrow(unpack, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def code_lengths(weights, max_bits: int = MAX_BITS):
    """Package-merge: optimal code lengths of at most ``max_bits`` for positive weights."""
    import numpy as np
    w = np.asarray(weights, dtype=np.int64)
    n = len(w)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need codes of more than {max_bits} bits")
    order = np.argsort(w, kind="stable")
    leaves = w[order]
    merged, leaf_flags = leaves, [np.ones(n, dtype=bool)]
    for _ in range(max_bits - 1):
        even = len(merged) // 2 * 2
        both = np.concatenate([leaves, merged[:even:2] + merged[1:even:2]])
        rank = np.argsort(both, kind="stable")  # leaves first among equals
        merged = both[rank]
        leaf_flags.append(rank < n)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for flags in reversed(leaf_flags):
        own = int(flags[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


def canonical(tokens, lengths):
    """Codes in order of (length, id): arrays of (id, length, code)."""
    import numpy as np
    tokens, lengths = np.asarray(tokens, dtype=np.int64), np.asarray(lengths, dtype=np.int64)
    order = np.lexsort((tokens, lengths))
    tokens, lengths = tokens[order], lengths[order]
    if not len(tokens):
        return tokens, lengths, tokens
    top = int(lengths[-1])
    span = np.left_shift(1, top - lengths)  # share of the code space, in units of the longest code
    code = (np.cumsum(span) - span) >> (top - lengths)
    return tokens, lengths, code


def encode_block(ids, code_of, bits_of, stride: int = STRIDE):
    """``(payload, bits, checkpoints)`` of one array of ids."""
    import numpy as np
    size = bits_of[ids].astype(np.int64)
    end = np.cumsum(size)
    start = end - size
    total = int(end[-1])
    word = start >> 5
    value = code_of[ids].astype(np.uint64) << (64 - (start & 31) - size).astype(np.uint64)
    # All codes that start in one 32-bit word are joined in 64 bits; the low half runs into the next.
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    both = np.bitwise_or.reduceat(value, first)
    words = np.zeros((total + 31) // 32 + 1, dtype=np.uint64)
    words[word[first]] = both >> np.uint64(32)
    words[word[first] + 1] |= both & np.uint64(0xFFFFFFFF)
    return words.astype(">u4").tobytes()[:(total + 7) // 8], total, start[::stride].tolist()


def decode_batch(payloads: list[bytes], tokens: list[int], checkpoints: list[list[int]], table, max_bits: int,
                 stride: int = STRIDE):
    """Ids of several blocks, one after the other; all stretches advance together."""
    import numpy as np
    pad = b"\0" * 8
    raw = np.frombuffer(b"".join(p + pad for p in payloads), dtype=np.uint8).astype(np.uint32)
    four = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    base = np.cumsum([0] + [len(p) + 8 for p in payloads[:-1]]) * 8
    counts = [[min(stride, n - stride * i) for i in range(len(c))] for n, c in zip(tokens, checkpoints)]
    at = np.concatenate([np.asarray(c, dtype=np.int64) + b for c, b in zip(checkpoints, base)])
    count = np.concatenate([np.asarray(c, dtype=np.int64) for c in counts])
    first = np.cumsum(count) - count
    out = np.empty(int(count.sum()), dtype="<u4")
    order = np.argsort(-count, kind="stable")  # longest first: the live stretches are a prefix
    at, count, first = at[order], count[order], first[order]
    shift = np.uint32(32 - max_bits)
    live = len(at)
    for step in range(int(count[0]) if live else 0):
        while count[live - 1] <= step:
            live -= 1
        pos = at[:live]
        entry = table[(four[pos >> 3] << (pos & 7).astype(np.uint32)) >> shift]
        out[first[:live] + step] = entry >> 5
        pos += entry & 31
    return out


def decode_table(tokens, lengths, codes, max_bits: int):
    """Entry of each ``max_bits`` prefix: id * 32 + code length."""
    import numpy as np
    spans = np.left_shift(1, max_bits - lengths)
    table = np.zeros(1 << max_bits, dtype=np.int64)
    full = np.repeat(tokens * 32 + lengths, spans)
    table[:len(full)] = full
    return table


def write_blocks(plain: DataFrame, path: str, codes: list[tuple[int, int]], kind: str, stride: int = STRIDE,
                 block_tokens: int = BLOCK_TOKENS) -> None:
    import numpy as np
    dtype, width = _dtype(kind), 2 if kind == "H" else 4
    tokens, lengths, code = canonical([t for t, _ in codes], [b for _, b in codes])
    top = int(tokens.max()) + 1 if len(tokens) else 1
    code_of, bits_of = np.zeros(top, dtype=np.uint32), np.zeros(top, dtype=np.uint8)
    code_of[tokens], bits_of[tokens] = code, lengths

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        schema = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int32())),
                            ("tokens", pa.int64()), ("bits", pa.int64()), ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary())])

        def block(part, seq, before, docs, raws):
            ids = np.frombuffer(b"".join(raws), dtype=dtype)
            payload, bits, marks = encode_block(ids, code_of, bits_of, stride)
            row = [part, seq, before, docs, [len(r) // width for r in raws], len(ids), bits, marks, payload]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

        for batch in batches:
            part, seq, before, docs, raws, size = None, 0, 0, [], [], 0
            for p, s, b, d, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if raws and (p != part or s != seq + len(raws) or size >= block_tokens):
                    yield block(part, seq, before, docs, raws)
                    docs, raws, size = [], [], 0
                if not raws:
                    part, seq, before = p, s, b
                docs.append(d)
                raws.append(raw)
                size += len(raw) // width
            if raws:
                yield block(part, seq, before, docs, raws)

    plain.where("seq >= 0").select("part", "seq", "before", "id", "ids").mapInArrow(encode, _BLOCKS).write.option("compression", "none").parquet(path)


def write_ids(df: DataFrame, folder: str, settings: str, end_id: int = 2, id_col: str = "doc_id", text: str = "text",
              max_bits: int = MAX_BITS) -> None:
    """Encode every document of ``df`` and write the folder's tables."""
    spark = df.sparkSession
    plain = write_plain(df, f"{folder}/plain", settings, end_id, id_col, text)
    counted = token_counts(plain).orderBy("token").collect()  # a row per used id: bounded by the vocabulary
    lengths = code_lengths([r["n"] for r in counted], max_bits)
    codes = [(r["token"], int(b)) for r, b in zip(counted, lengths)]
    spark.createDataFrame(codes, "id bigint, bits int").coalesce(1).write.parquet(f"{folder}/codes")
    write_blocks(plain, f"{folder}/blocks", codes, id_kind(settings))


def read_ids(spark: SparkSession, folder: str, max_bits: int = MAX_BITS, sums_only: bool = False) -> DataFrame:
    """``(id, start, n_tokens, ids)`` of every document, decoded from the files: ``start`` counts
    the ids of all documents before it, ``ids`` are little-endian unsigned 32-bit.  ``sums_only``:
    their unsigned crc32 (``crc``) in place of the ids."""
    codes = [(r["id"], r["bits"]) for r in spark.read.schema("id bigint, bits int").parquet(f"{folder}/codes").collect()]
    tokens, lengths, code = canonical([t for t, _ in codes], [b for _, b in codes])
    table = decode_table(tokens, lengths, code, max_bits)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    sizes = blocks.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np
        for batch in batches:
            starts, docs, counts, tokens, marks, payload = (batch.column(i).to_pylist() for i in range(6))
            ids = decode_batch(payload, tokens, marks, table, max_bits).tobytes()
            sizes = [c for own in counts for c in own]
            stops = np.cumsum(sizes).tolist()
            places = np.concatenate([np.cumsum([at] + own[:-1]) for at, own in zip(starts, counts)])
            view = memoryview(ids)
            parts = (view[4 * (e - n):4 * e] for e, n in zip(stops, sizes))
            last = pa.array([zlib.crc32(x) for x in parts], pa.int64()) if sums_only else pa.array([bytes(x) for x in parts], pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array([d for x in docs for d in x], pa.int64()), pa.array(places, pa.int64()), pa.array(sizes, pa.int64()), last],
                names=["id", "start", "n_tokens", "crc" if sums_only else "ids"])

    # A row per range partition of the writer: at most spark.sql.shuffle.partitions of them.
    placed = blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("part_start"))
    return placed.select("start", "doc_ids", "doc_tokens", "tokens", "checkpoints", "payload").mapInArrow(
        decode, "id bigint, start bigint, n_tokens bigint, " + ("crc bigint" if sums_only else "ids binary"))
