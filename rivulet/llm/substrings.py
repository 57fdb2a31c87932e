"""Repeated-substring removal by bucket-pointer refinement of sampled suffixes.

A byte is removed if some ``length``-byte string that covers it also starts anywhere else.  A
full suffix array would sort one suffix per byte; here only sampled suffixes are sorted, and
their buckets are refined until they answer for every start position:

1. Sampling.  Of every ``WINDOW`` consecutive start positions the one with the least gram hash is
   an anchor.  The choice depends on the text of the window alone, so equal strings hold
   their anchor at the same place; there is one anchor per ``WINDOW / 2`` bytes on average.
2. Initial buckets.  Anchors with the same q-gram, q = length - WINDOW + 1 bytes, share a bucket.
   Buckets are counted with map-side combine; single suffixes are settled (unique) and drop out.
3. First refinement, by the identifier of the whole surroundings (all strings of ``length``
   bytes that hold the q-gram): suffixes that share it with another one are settled as well,
   all those strings are repeated.  Only one representative of each stays in its bucket.
4. Further refinement, for buckets with several surroundings: each of the ``WINDOW`` offsets gets
   the identifier of the string that starts there.  Identifiers are built by doubling -- that of
   2k bytes from those of k bytes here and k bytes on, each round reusing the last one's -- and
   the bucket is sorted by them, offset by offset; equal neighbours are repeated strings.
   Buckets of up to ``MAX_BUCKET`` representatives are refined together in a task (many small
   ones at a time).  Larger ones are refined over all tasks: ranges of offsets first, as in step 3,
   then the strings of the ranges left open, counted with map-side combine; no bucket is ever
   gathered in one place unbounded.
5. Spans are gathered and merged per text, stored, and cut out of all texts that hold one.

Steps in Python run one worker per task, and Arrow batches end at ``BATCH_BYTES``; the last step, which
reads every text again, needs none.

Identifiers are 64-bit hashes compared within a bucket, which is itself a 64-bit hash.  Texts
are addressed by a 128-bit digest, so copies of a text are one entry that is counted as often
as it occurs; rows need no id.  Two fixed-size bit filters (``FILTER_BITS``) keep texts without
repeats out of the joins; they only ever let too many through.

Edge cases: a null text counts as empty; texts under ``length`` bytes lose nothing; ids are not
read, so null and repeated ids and further columns pass through (internal columns are prefixed
``_sub_``); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_batches_below, bit_table, row_digest, stored, text_or_empty, with_may_match

WINDOW = 300  # start positions of which one is sampled
GRAM = 8  # bytes that the sampling hash looks at
MAX_BUCKET = 4096  # representatives of a bucket up to which one task refines it
RANGES = 16  # ranges of offsets in the refinement of larger buckets
COARSE = 4  # of them taken together first
BATCH = 256  # rows that a step takes at a time: what it makes of them is held in memory at once
FILTER_BITS = 1 << 26
BATCH_BYTES = 4 << 20  # of text sent to a worker at once
_CHUNK = 1 << 22  # positions sampled at a time (positions take 24 bits of a sampling key)


def anchors(raw: bytes, length: int, window: int):
    """Sampled start positions of one text, ascending."""
    import numpy as np
    starts = len(raw) - length + window  # positions that some window of starts holds
    found = []
    for at in range(0, max(0, len(raw) - length + 1), _CHUNK):
        n = min(starts - at, _CHUNK + window - 1)
        grams = np.ndarray((n,), "<u8", raw, at, (1,))
        key = grams * np.uint64(0x9E3779B97F4A7C15)
        key &= np.uint64(0xFFFFFFFFFF000000)
        key |= np.arange(n, dtype=np.uint64)
        least, width = key, 1
        while 2 * width <= window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < window:
            least = np.minimum(least[:len(least) - (window - width)], least[window - width:])
        place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        found.append(at + place[np.concatenate([[True], place[1:] != place[:-1]])])
    if not found:
        return np.zeros(0, dtype=np.int64)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Smaller batches: what a step makes of one is held in memory at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _signed(values):
    import numpy as np
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64), pa.int64())


_ANCHORS = "c bigint, e bigint, ta bigint, tb bigint, start int, pos int, stop int"


def anchor_rows(texts: DataFrame, length: int, window: int, wanted=None, with_context: bool = True) -> DataFrame:
    """A row per anchor: bucket ``c`` (its q-gram), ``e`` (its surroundings), the text's digest,
    the anchor and the bytes [start, stop) its strings cover.  ``wanted``: only buckets that this
    bit filter may hold."""
    core = length - window + 1
    shape = _ANCHORS if with_context else "c bigint"
    names = [f.split()[0] for f in shape.split(", ")]

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from xxhash import xxh64_intdigest as digest
        for batch in _slices(batches, BATCH):
            c, e, ta, tb, start, pos, stop = [], [], [], [], [], [], []
            a_all, b_all = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for i, raw in enumerate(batch.column(0).to_pylist()):
                n = len(raw)
                if n < length:
                    continue
                places = anchors(raw, length, window).tolist()
                buckets = [digest(raw[p:p + core]) for p in places]
                if wanted is not None:
                    may = np.nonzero(_in_filter(wanted, np.array(buckets, dtype=np.uint64)))[0].tolist()
                    places, buckets = [places[k] for k in may], [buckets[k] for k in may]
                c += buckets
                if not with_context:
                    continue
                for p in places:
                    s, t = max(0, p - window + 1), min(n, p + length)
                    e.append(digest(raw[s:t], seed=(p - s) * (length + 1) + (t - p)))
                    start.append(s)
                    stop.append(t)
                pos += places
                ta += [a_all[i]] * len(places)
                tb += [b_all[i]] * len(places)
            arrays = [_signed(c)]
            if with_context:
                arrays += [_signed(e), pa.array(ta, pa.int64()), pa.array(tb, pa.int64()),
                           *(pa.array(x, pa.int32()) for x in (start, pos, stop))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return texts.select("text", "ta", "tb").mapInArrow(sample, shape)


def bit_filter(keys: DataFrame, column: str, bits: int = FILTER_BITS):
    """The keys' low bits as a bit set of fixed size (``bits / 8`` bytes, built by Spark)."""
    import numpy as np
    v = F.pmod(F.col(column), F.lit(bits)) + 1
    rows = keys.select(v.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("m")).collect()  # at most bits / 32768 rows of 4 KB
    out = np.zeros((bits + 32767) // 32768 * 4096, dtype=np.uint8)
    for r in rows:
        out[(r["k"] - 1) * 4096:r["k"] * 4096] = np.frombuffer(bytes(r["m"]), dtype=np.uint8)
    return out


def _in_filter(filter_bytes, keys):
    """``keys`` as unsigned 64-bit; the filter size is a power of two."""
    import numpy as np
    at = (keys & np.uint64(len(filter_bytes) * 8 - 1)).astype(np.int64)
    return (filter_bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


_CONTEXTS = "c bigint, n bigint, ta bigint, tb bigint, pos int, lead int, bytes binary"


def contexts(texts: DataFrame, length: int, window: int) -> DataFrame:
    """``texts(text, ta, tb, wanted: array<struct<c, n, pos>>)`` -> the surroundings of each."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        names = [f.split()[0] for f in _CONTEXTS.split(", ")]
        for batch in _slices(batches, 64):
            rows = []
            for raw, a, b, want in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for w in want:
                    p = w["pos"]
                    s = max(0, p - window + 1)
                    rows.append((w["c"], w["n"], a, b, p, p - s, raw[s:p + length]))
            for at in range(0, len(rows), BATCH):
                columns = zip(*rows[at:at + BATCH])
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=names)

    return texts.select("text", "ta", "tb", "wanted").mapInArrow(cut, _CONTEXTS)


def string_ids(raws: list[bytes], leads, length: int, window: int):
    """``(ids, valid)``, both (members, window): the identifier of the string that starts d bytes
    before the member's anchor, and whether the text holds that string whole."""
    import numpy as np
    n, width = len(raws), window - 1 + length
    block = np.zeros((n, width), dtype=np.uint64)
    valid = np.zeros((n, window), dtype=bool)
    for i, raw in enumerate(raws):
        at = window - 1 - leads[i]
        block[i, at:at + len(raw)] = np.frombuffer(raw, dtype=np.uint8)
        valid[i, max(0, window - 1 + length - (at + len(raw))):leads[i] + 1] = True
    k1, k2, s = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29)

    def joined(left, right):
        mixed = (left ^ (left >> s)) * k1 + (right ^ (right >> s)) * k2
        return mixed ^ (mixed >> s)

    level, size, ids, done = (block + np.uint64(1)) * k2, 1, None, 0
    while True:
        if length & size:
            part = level[:, done:done + window]
            ids, done = part if ids is None else joined(ids, part), done + size
        if 2 * size > length:
            break
        level = joined(level[:, :-size], level[:, size:])
        size *= 2
    return np.ascontiguousarray(ids[:, ::-1]), valid  # column p of ``ids`` starts p bytes after the earliest start


def refine(rows: DataFrame, length: int, window: int) -> DataFrame:
    """Spans of repeated strings around members that have their surroundings to themselves; rows
    are grouped by bucket in sorted partitions, buckets are small."""
    shape = "ta bigint, tb bigint, start int, stop int"

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def spans(c, n, a, b, pos, lead, raws):
            parts = [string_ids(raws[i:i + BATCH], lead[i:i + BATCH], length, window) for i in range(0, len(raws), BATCH)]
            ids, valid = (np.concatenate(p) for p in zip(*parts))
            c = np.array(c, dtype=np.int64)
            shared = np.zeros(valid.shape, dtype=bool)
            for d in range(window):
                at = np.nonzero(valid[:, d])[0]
                order = at[np.lexsort((ids[at, d], c[at]))]
                equal = (ids[order[1:], d] == ids[order[:-1], d]) & (c[order[1:]] == c[order[:-1]])
                shared[order[1:][equal], d] = True
                shared[order[:-1][equal], d] = True
            out = []
            for i in np.nonzero((np.array(n) == 1) & shared.any(axis=1))[0].tolist():
                starts = pos[i] - np.nonzero(shared[i])[0][::-1]
                gaps = np.nonzero(np.diff(starts) > length)[0]
                for s, t in zip(starts[np.concatenate([[0], gaps + 1])].tolist(), starts[np.concatenate([gaps, [-1]])].tolist()):
                    out.append((a[i], b[i], s, t + length))
            columns = zip(*out) if out else [()] * 4
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=["ta", "tb", "start", "stop"])

        held: list[list] = [[] for _ in range(7)]
        for batch in _slices(batches, BATCH):
            for column, values in zip(held, (batch.column(i).to_pylist() for i in range(7))):
                column += values
            while len(held[0]) > BATCH and held[0][0] != held[0][-1]:  # whole buckets only
                cut = BATCH
                while cut < len(held[0]) and held[0][cut - 1] == held[0][cut]:
                    cut += 1
                if cut == len(held[0]):  # the last one may go on
                    while held[0][cut - 1] == held[0][-1]:
                        cut -= 1
                yield spans(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if held[0]:
            yield spans(*held)

    return rows.repartition("c").sortWithinPartitions("c").mapInArrow(settle, shape)


_RANGES = ("c bigint, r int, core bigint, e bigint, n bigint, ta bigint, tb bigint, pos int, low int, high int")


def refine_large(rows: DataFrame, length: int, window: int) -> DataFrame:
    """The same for buckets of any size, over all tasks; ``rows`` are stored.

    The offsets are cut into ranges, ``RANGES / COARSE`` first, and what these leave open into ``RANGES``:
    most of a repeat is settled by a few long ranges.  A range is a bucket of its own, by the bytes that
    all its strings hold (``core``), and its surroundings ``e`` settle it as in the first
    refinement: shared surroundings repeat every string of the range, and a member alone in its
    bucket repeats none.  Only ranges that neither settles -- about those at the ends of a repeat
    -- are spelled out string by string and counted.  All counts combine map-side.
    """
    def cut(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as digest
        names = [f.split()[0] for f in _RANGES.split(", ")]
        kinds = [pa.int64(), pa.int32(), None, None, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        for batch in _slices(batches, BATCH):
            out = []
            for c, a, b, pos, lead, raw, ranges in zip(*(x.to_pylist() for x in batch.columns)):
                for x in ranges:
                    last = min(x["high"], lead)  # offsets whose string the text holds: first..last
                    first = max(x["low"], lead + length - len(raw))
                    for low in range(x["low"] // step * step, x["high"] + 1, step):
                        high = min(low + step, window) - 1
                        d0, d1 = max(low, first), min(high, last)
                        if d0 <= d1:
                            out.append((c, low // step, digest(raw[lead - low:lead - high + length]),
                                        digest(raw[lead - d1:lead - d0 + length], seed=(d0 - low) * window + d1 - low), x["m"], a, b, pos, d0, d1))
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([_signed(x) if k is None else pa.array(x, k) for x, k in zip(columns, kinds)], names=names)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as digest
        for batch in _slices(batches, BATCH):
            out = []
            for c, a, b, pos, lead, raw, ranges in zip(*(x.to_pylist() for x in batch.columns)):
                for x in ranges:
                    out += [(c, d, digest(raw[lead - d:lead - d + length]), x["m"], a, b, pos - d) for d in range(x["low"], x["high"] + 1)]
            c, offsets, ids, m, a, b, start = zip(*out) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()), pa.array(offsets, pa.int32()), _signed(ids), pa.array(m, pa.int64()), pa.array(a, pa.int64()),
                 pa.array(b, pa.int64()), pa.array(start, pa.int32())], names=["c", "d", "id", "n", "ta", "tb", "start"])

    whole = F.array(F.struct(F.col("n").alias("m"), F.lit(0).alias("low"), F.lit(window - 1).alias("high")))
    asked, settled, fine = rows.withColumn("ranges", whole), [], -(-window // RANGES)
    for step in (COARSE * fine, fine):
        names = ["c", "ta", "tb", "pos", "lead", "bytes", "ranges"]
        cuts = asked.select(*names).mapInArrow(lambda batches, step=step: cut(batches, step), _RANGES)
        alike = cuts.groupBy("c", "r", "core", "e").agg(F.sum("n").alias("m"), *[F.first(x).alias(x) for x in ("ta", "tb", "pos", "low", "high")])
        alike = stored(alike, "sub-ranges")
        settled.append(cuts.where("n = 1").join(alike.where("m > 1").select("c", "r", "core", "e"), ["c", "r", "core", "e"], "left_semi"))
        several = alike.groupBy("c", "r", "core").agg(F.count(F.lit(1)).alias("k"), F.min("m").alias("least")).where("k > 1 AND least = 1")
        open_ = alike.join(several.select("c", "r", "core"), ["c", "r", "core"])
        open_ = open_.groupBy("c", "ta", "tb", "pos").agg(F.collect_list(F.struct("m", "low", "high")).alias("ranges"))
        asked = rows.join(open_, ["c", "ta", "tb", "pos"])
    strings = asked.select(*names).mapInArrow(
        spell, "c bigint, d int, id bigint, n bigint, ta bigint, tb bigint, start int")
    # Offset by offset, as in ``refine``: two anchors of a text may cover the same string, at different offsets.
    repeated = strings.groupBy("c", "d", "id").agg(F.sum("n").alias("times")).where("times > 1")
    single = strings.where("n = 1").join(repeated, ["c", "d", "id"], "left_semi")
    return settled[0].union(settled[1]).select("ta", "tb", (F.col("pos") - F.col("high")).alias("start"), (F.col("pos") - F.col("low") + length).alias("stop")).union(
        single.select("ta", "tb", "start", (F.col("start") + length).alias("stop")))


def merged(spans: Column) -> Column:
    """Maximal runs of an array of (start, stop), in order."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def merge(lists: pa.Array) -> pa.Array:
        out = []
        for own in lists.to_pylist():
            runs = []
            for x in sorted(own or [], key=lambda x: x["start"]):
                if runs and x["start"] <= runs[-1]["stop"]:
                    runs[-1]["stop"] = max(runs[-1]["stop"], x["stop"])
                else:
                    runs.append(dict(x))
            out.append(runs)
        return pa.array(out, type=kind)

    return F.arrow_udf(merge, "array<struct<start: int, stop: int>>")(spans)


def marked_spans(texts: DataFrame, length: int, window: int, max_bucket: int) -> DataFrame:
    """``texts(text, ta, tb)`` -> ``(ta, tb, spans)`` of the distinct texts that lose something, stored."""
    buckets = anchor_rows(texts, length, window, with_context=False).groupBy("c").agg(F.count(F.lit(1)).alias("size"))
    buckets = stored(buckets.where("size > 1").select("c"), "sub-buckets")
    active = anchor_rows(texts, length, window, wanted=bit_filter(buckets, "c"))
    members = stored(active.join(buckets, "c", "left_semi"), "sub-members")

    alike = members.groupBy("c", "e").agg(F.count(F.lit(1)).alias("n"), F.first("ta").alias("ta"), F.first("tb").alias("tb"),
                                          F.first("pos").alias("pos"))
    alike = stored(alike, "sub-alike")
    settled = members.join(alike.where("n > 1").select("c", "e"), ["c", "e"], "left_semi").select("ta", "tb", "start", "stop")

    several = alike.groupBy("c").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).where("k > 1 AND least = 1")
    open_ = stored(alike.join(several.select("c", "k"), "c"), "sub-open")
    wanted = open_.groupBy("ta", "tb").agg(F.collect_list(F.struct("c", "n", "pos", "k")).alias("wanted"))
    holders = with_may_match(texts, F.col("ta"), bit_table(open_, F.col("ta"), FILTER_BITS), "may", FILTER_BITS)
    holders = holders.where("may").drop("may").dropDuplicates(["ta", "tb"])
    around = contexts(holders.join(wanted, ["ta", "tb"]), length, window)
    sizes = open_.select("c", "k").distinct().where(F.col("k") > max_bucket).select("c")
    large = around.join(sizes, "c", "left_semi")
    small = around.join(sizes, "c", "left_anti")
    spans = settled.union(refine(small, length, window))
    if not sizes.isEmpty():
        spans = spans.union(refine_large(stored(large, "sub-large"), length, window))
    marks = spans.distinct().groupBy("ta", "tb").agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    return stored(marks.select("ta", "tb", merged(F.col("found")).alias("spans")), "sub-marks")


def repeated_spans(df: DataFrame, text: str = "text", length: int = 400, window: int = WINDOW,
                   max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``df`` plus ``spans``: the maximal byte runs of each text that are to go."""
    max_bucket = min(max_bucket, MAX_BUCKET)
    if not GRAM <= length - window + 1 or window < 2:
        raise ValueError("window must lie between 2 and length - 7")
    digest = row_digest(text_or_empty(text))
    texts = df.select(F.encode(text_or_empty(text), "UTF-8").alias("text"), digest.alias("d")).select(
        "text", F.col("d.a").alias("ta"), F.col("d.b").alias("tb"))

    with arrow_batches_below(df.sparkSession, BATCH_BYTES):
        marks = marked_spans(texts, length, window, max_bucket)

    none = F.array().cast("array<struct<start: int, stop: int>>")
    keyed = with_may_match(df.withColumn("_sub_key", digest), F.col("_sub_key.a"), bit_table(marks, F.col("ta"), FILTER_BITS),
                           "_sub_marked", FILTER_BITS)
    found = keyed.where("_sub_marked").join(marks.withColumnsRenamed({"ta": "_sub_a", "tb": "_sub_b", "spans": "_sub_spans"}),
                                            (F.col("_sub_key.a") == F.col("_sub_a")) & (F.col("_sub_key.b") == F.col("_sub_b")), "left")
    found = found.withColumn("spans", F.coalesce("_sub_spans", none))
    clean = keyed.where("NOT _sub_marked").withColumn("spans", none)
    columns = [c for c in df.columns if c != "spans"] + ["spans"]
    return found.select(*columns).union(clean.select(*columns))


def kept_bytes(text: Column, spans: Column) -> Column:
    """The bytes outside the spans, one after the other."""
    raw = F.encode(text_or_empty(text), "UTF-8")

    def cut(whole: Column) -> Column:
        def piece(i: Column) -> Column:
            start = F.coalesce(F.get(spans, i - 1)["stop"], F.lit(0))
            stop = F.coalesce(F.get(spans, i)["start"], F.octet_length(whole))
            return F.hex(F.substring(whole, start + 1, stop - start))

        return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans)), piece), ""))

    # Bound as an element, the bytes are made once, not for every piece.
    return F.when(F.size(spans) == 0, raw).otherwise(F.transform(F.array(raw), cut)[0])
