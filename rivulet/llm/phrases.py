"""Phrase collocations per language by vertical partitioning of a truncated suffix tree.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words
``[^\\x20\\x09]+``.  Every word position starts a suffix of its piece, cut at three words.

1. *Prefix counts.*  Words are counted per language (summed within a task, then across tasks).
   A word prefix with more suffixes than the memory budget is extended by its next word, and that
   pair by its third word: the variable-length prefixes by which suffixes are grouped.
2. *Pruning.*  A phrase is no more frequent than its parts, so suffixes are cut where a word or
   a pair cannot reach ``min_count``.  The frequent words and pairs are held as bit sets of fixed
   size over their hashes (false positives only cost suffixes, never counts).
3. *Subtrees.*  Suffixes are dealt out by their prefix and sorted, so that each group of prefixes
   becomes the depth-truncated subtrees of those prefixes in depth-first order, built apart from
   all others.  A batch-wise pass reads a node's count as the total of the leaves below it.
   Nodes above an extended prefix get one part per group; those parts are added up.
4. *Scores.*  Parts of a candidate are looked up by equality joins; the arithmetic is decimal.

Bounded: 2 bit sets of 8 MB are broadcast whatever the corpus; extended prefixes number at most
(positions / budget) per level; a task of step 3 streams its sorted suffixes.

Edge cases: a null text is empty, a null ``lang`` is ``und`` (and joins a language of that name);
empty texts and tables give no rows; repeated rows count as often as they occur; further columns
are ignored.  A language with fewer candidates than ``top`` returns them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.common import FILTER_BITS, bit_table, stored

PREFIX_BUDGET = 2_000_000  # suffixes that one prefix may bring to its group
_CHUNK = 1 << 21  # word positions that a task sums up at a time
_WORDS = 1 << 20  # distinct words of a chunk
_BREAK = 0  # local id of a piece's end
# What ends a piece, and odd multipliers that mix word hashes.
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class _Ids(dict):
    """Word bytes -> local id, given out on first sight; the empty string is no word."""

    def __init__(self):
        super().__init__({b"\n": _BREAK, b"": -1})

    def __missing__(self, word):
        self[word] = found = len(self) - 1
        return found


class Chunk:
    """Words of many texts of one language as an array of local ids with breaks between pieces."""

    def __init__(self, lang: str, ids: _Ids, at):
        import numpy as np
        import xxhash

        self.lang, self.at = lang, at
        self.words = [w for w in ids if w != b""]  # by local id; the first is the break
        seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), dtype=np.uint64, count=len(self.words))

    def strings(self, ids) -> pa.Array:
        return pa.array(self.words, type=pa.binary()).cast(pa.string()).take(pa.array(ids))

    def pair_hashes(self, a, b):
        import numpy as np

        x = self.hashes[a] * np.uint64(_MIX[0]) ^ (self.hashes[b] * np.uint64(_MIX[1]) + np.uint64(_MIX[2]))
        return x ^ (x >> np.uint64(29))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """``(lang, text)`` batches -> chunks; a text is never divided between two."""
    import numpy as np

    held: dict[str, tuple[_Ids, list]] = {}
    size = 0

    def flush():
        for lang, (ids, parts) in held.items():
            yield Chunk(lang, ids, np.concatenate(parts))
        held.clear()

    for batch in batches:
        for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            if not raw:
                continue
            ids, parts = held.setdefault(lang, (_Ids(), []))
            tokens = raw.lower().translate(_ENDS).replace(b"\n", b" \n ").split(b" ")
            at = np.fromiter(map(ids.__getitem__, tokens), dtype=np.int32, count=len(tokens))
            parts += [at[at >= 0], np.array([_BREAK], dtype=np.int32)]
            size += len(parts[-2])
            if size >= _CHUNK or len(ids) >= _WORDS:
                yield from flush()
                size = 0
    yield from flush()


def _signed(x):
    import numpy as np

    return pa.array(x.view(np.int64))


def _count_words(batches):
    import numpy as np

    for c in chunks(batches):
        n = np.bincount(c.at, minlength=len(c.words))
        ids = np.flatnonzero(n[1:]) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([c.lang] * len(ids), pa.string()), c.strings(ids), _signed(c.hashes[ids]), pa.array(n[ids])], ["lang", "word", "h", "n"])


def _holds(bit_set, hashes):
    """Which hashes may be in a bit set ``(bytes, bits)``."""
    import numpy as np

    raw, bits = bit_set
    at = hashes.view(np.int64) % np.int64(bits)
    return (np.frombuffer(raw, dtype=np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _bit_set(spark: SparkSession, keys: DataFrame, key: str, bits: int):
    """Broadcast bit set of the keys: at most ``bits / 8`` bytes pass through the driver."""
    pages = bit_table(keys, F.col(key), bits).collect()
    raw = bytearray(bits // 8 + 4096)
    for page, content in pages:
        raw[(page - 1) * 4096:page * 4096] = content
    return spark.sparkContext.broadcast((bytes(raw), bits))


def _pairs(c: Chunk, words):
    """Positions whose word and next word may both be frequent, their ids and pair hashes."""
    import numpy as np

    good = _holds(words.value, c.hashes)
    good[_BREAK] = False
    ok = good[c.at]
    at = np.flatnonzero(ok[:-1] & ok[1:])
    return at, c.pair_hashes(c.at[at], c.at[at + 1])


def _pair_counter(words):
    def count(batches):
        import numpy as np

        for c in chunks(batches):
            found, n = np.unique(_pairs(c, words)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(found), pa.array(n)], ["h", "n"])

    return count


def _suffixer(words, pairs, hot_words: frozenset, hot_pairs: frozenset):
    """Suffixes that start with a pair that may be frequent, cut after it unless the next pair
    may be frequent too.  ``part`` hashes the prefix that decides the group; ``level`` is that
    prefix's length in words."""

    def suffixes(batches):
        import numpy as np

        hot1, hot2 = (np.array(sorted(x), dtype=np.int64).view(np.uint64) for x in (hot_words, hot_pairs))
        for c in chunks(batches):
            at, h = _pairs(c, words)
            keep = _holds(pairs.value, h)
            at, h = at[keep], h[keep]
            starts = np.zeros(len(c.at) + 1, dtype=bool)
            starts[at] = True
            third = np.where(starts[at + 1], c.at[np.minimum(at + 2, len(c.at) - 1)], _BREAK).astype(np.int64)
            first, second = c.at[at].astype(np.int64), c.at[at + 1].astype(np.int64)
            # Two stable integer keys: the pair, then the third word.
            base = np.int64(len(c.words))
            _, where, pair_no = np.unique(first * base + second, return_index=True, return_inverse=True)
            both, n = np.unique(pair_no * base + third, return_counts=True)
            pair, third = where[both // base], both % base
            first, second, h = first[pair], second[pair], h[pair]
            level = np.where(np.isin(c.hashes[first], hot1), np.where(np.isin(h, hot2), 3, 2), 1)
            whole = h * np.uint64(_MIX[2]) + c.hashes[third]
            part = np.where(level == 1, c.hashes[first], np.where(level == 2, h, whole))
            last = pa.array(third, mask=third == _BREAK)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c.lang] * len(n), pa.string()), c.strings(first), c.strings(second),
                 pa.array(c.words, type=pa.binary()).cast(pa.string()).take(last), pa.array(n), _signed(part), pa.array(level.astype(np.int8))],
                ["lang", "w1", "w2", "w3", "n", "part", "level"])

    return suffixes


def _runs(columns, n):
    """Starts of the runs of equal neighbours in sorted columns."""
    import numpy as np
    import pyarrow.compute as pc

    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for c in columns:
        a, b = c.slice(1), c.slice(0, n - 1)
        differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= np.asarray(differ)
    return np.flatnonzero(new)


def _subtrees(min_count: int):
    """Sorted suffixes -> nodes of depth 2 and 3 with the totals of their leaves.  Nodes that
    lie within one group go only if frequent; parts of a node above its group's prefix all go."""

    def nodes(columns, n, depth):
        import numpy as np

        by = columns[:4] if depth == 3 else columns[:3]
        starts = _runs(by, n)
        totals = np.add.reduceat(np.asarray(columns[4]), starts)
        level = np.asarray(columns[5])[starts]
        keep = (totals >= min_count) | (level > depth)
        if depth == 3:
            keep &= ~np.asarray(columns[3].is_null())[starts]
        at = pa.array(starts[keep])
        w3 = columns[3].take(at) if depth == 3 else pa.nulls(len(at), pa.string())
        return pa.RecordBatch.from_arrays([*(c.take(at) for c in columns[:3]), w3, pa.array(totals[keep])], ["lang", "w1", "w2", "w3", "n"])

    def walk(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            if not len(table):
                continue
            held = table.to_batches()[0]
            columns = held.columns
            last = int(_runs(columns[:3], len(held))[-1])  # the last pair may go on in the next batch
            if last:
                done = [c.slice(0, last) for c in columns]
                yield nodes(done, last, 2)
                yield nodes(done, last, 3)
                held = held.slice(last)
            held = _summed(held)
        if held is not None and len(held):
            yield nodes(held.columns, len(held), 2)
            yield nodes(held.columns, len(held), 3)

    return walk


def _summed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Equal suffixes of the open pair as one: what is carried stays at one row per leaf."""
    import numpy as np

    starts = _runs(batch.columns[:4], len(batch))
    totals = np.add.reduceat(np.asarray(batch.column(4)), starts)
    at = pa.array(starts)
    return pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns[:4]), pa.array(totals), batch.column(5).take(at)], schema=batch.schema)


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = 10,
                  budget: int = PREFIX_BUDGET, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """``(words, phrases)``: ``words(lang, word, n)`` of every word, and ``phrases(lang, w1, w2,
    w3, n)`` of every phrase of 2 (``w3`` null) or 3 words found ``min_count`` times or more."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    counted = texts.mapInArrow(_count_words, "lang string, word string, h bigint, n bigint")
    words = stored(counted.groupBy("lang", "word", "h").agg(F.sum("n").alias("n")), "phrase-words")
    frequent = words.where(F.col("n") >= min_count)
    word_bits = _bit_set(spark, frequent, "h", bits)
    hot_words = frozenset(r["h"] for r in words.where(F.col("n") > budget).select("h").collect())  # positions / budget at most
    pairs = stored(texts.mapInArrow(_pair_counter(word_bits), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
                   .where(F.col("n") >= min_count), "phrase-pairs")
    pair_bits = _bit_set(spark, pairs, "h", bits)
    hot_pairs = frozenset(r["h"] for r in pairs.where(F.col("n") > budget).select("h").collect()) if hot_words else frozenset()
    groups = int(pairs.agg(F.sum("n")).first()[0] or 0) // budget + 1
    groups = max(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    suffixes = texts.mapInArrow(_suffixer(word_bits, pair_bits, hot_words, hot_pairs),
                                "lang string, w1 string, w2 string, w3 string, n bigint, part bigint, level tinyint")
    dealt = suffixes.repartition(groups, "part").drop("part").sortWithinPartitions("lang", "w1", "w2", "w3")
    parts = dealt.mapInArrow(_subtrees(min_count), "lang string, w1 string, w2 string, w3 string, n bigint")
    phrases = parts.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return words.drop("h"), stored(phrases, "phrase-counts")


def _exact(column: str):
    return F.col(column).cast("decimal(14,0)")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = 10, top: int = 2000,
                 inside_percent: int = 50, scale: int = 1_000_000, budget: int = PREFIX_BUDGET) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language.

    ``a`` counts the phrase; of its cuts the one with the least ``floor(scale * a * a / (l * r))``
    gives ``l`` and ``r``, the counts of the two parts.  A phrase inside a longer one that holds
    at least ``inside_percent`` of its count is dropped."""
    words, phrases = phrase_counts(docs, lang, text, min_count, budget)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    single = words.where(F.col("n") >= min_count)
    two = phrases.where("w3 is null").select("lang", "w1", "w2", F.col("n").alias("a"))
    three = phrases.where("w3 is not null").withColumnRenamed("n", "a")

    def count_of(parts: list[str], out: str) -> DataFrame:
        source = single.withColumnRenamed("word", "p0") if len(parts) == 1 else two.select("lang", F.col("w1").alias("p0"), F.col("w2").alias("p1"), F.col("a").alias("n"))
        return source.select("lang", *[F.col(f"p{i}").alias(c) for i, c in enumerate(parts)], F.col("n").alias(out))

    def cut(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
        k = len(left)
        return (df.join(count_of(left, f"l{k}"), ["lang", *left]).join(count_of(right, f"r{k}"), ["lang", *right])
                .withColumn(f"s{k}", F.call_function("div", _exact("a") * _exact("a") * F.lit(scale).cast("decimal(8,0)"), _exact(f"l{k}") * _exact(f"r{k}"))))

    covered = three.select("lang", "a", F.inline(F.array(*[F.struct(F.col(x).alias("w1"), F.col(y).alias("w2")) for x, y in (("w1", "w2"), ("w2", "w3"))]))) \
        .groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    two = two.alias("two")
    pairs = cut(two.join(covered, ["lang", "w1", "w2"], "left").where(F.coalesce(100 * F.col("longer") < inside_percent * F.col("a"), F.lit(True))), ["w1"], ["w2"])
    pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("l1").alias("l"), F.col("r1").alias("r"), F.col("s1").alias("score"))
    cuts = cut(cut(three, ["w1"], ["w2", "w3"]), ["w1", "w2"], ["w3"])
    early = F.col("s1") <= F.col("s2")
    triples = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                          F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = pairs.unionByName(triples).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
