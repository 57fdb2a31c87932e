"""SimHash near-duplicates found through deletion-variant signatures.

Fingerprint: word shingles are hashed with XXH64 (seed 42); a bit is 1 if it is set in over half
of the hashes.  Counting runs in an Arrow UDF over numpy, one text at a time.

Links, ``max_bits = k``: a fingerprint is cut into k div 2 + 1 segments (two at least), so of two
fingerprints within k bits some segment differs by one bit at most.  Every distinct fingerprint
is indexed under each whole segment and under each segment with one bit left out (a wildcard;
the bit itself is kept as the side).  Equal variants are joined -- whole segments with each
other, wildcard variants only across sides, so a pair meets once per segment -- and verified by
counting the differing bits.

Bounded work: copies are folded first (one node per distinct fingerprint).  Variants are counted
with map-side combine and only those that can hold a pair are joined.  A variant shared by more
than ``MAX_BUCKET`` fingerprints is not joined pairwise: its members go through meeting points
instead, which is exact too.  Two fingerprints within k bits have a point within ceil(k/2) bits
of the one and floor(k/2) of the other; members of a point are linked to its least near member.
A point has few members by construction (65 distinct fingerprints for k = 2), and each link
made there is again within k bits.  No all-pairs step remains for a large group.

Edge cases: a null or blank text has fingerprint zero and links like any other; null ids never
become a component id unless the whole component has none; rows that share an id or a text are
all returned; further columns pass through the UDF untouched and are not returned; an empty
table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import stored
from rivulet.llm.components import connected_components

MAX_BUCKET = 24  # members of a variant up to which its pairs are compared one by one
BITS = 64


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one UTF-8 text.  ``bytes.lower`` and ``bytes.split`` act on
    ASCII letters and on exactly the six white-space bytes of the contract."""
    import functools

    import numpy as np
    import xxhash

    w = raw.lower().split()
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    pieces = map(b" ".join, zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
    hashes = np.fromiter(map(functools.partial(xxhash.xxh64_intdigest, seed=42), pieces), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    def compute(texts: pa.Array) -> pa.Array:
        import numpy as np
        raw = texts.cast(pa.binary()).to_pylist()
        values = np.array([fingerprint(x, shingle) if x else 0 for x in raw], dtype=np.uint64)
        return pa.array(values.view(np.int64), type=pa.int64())

    return F.arrow_udf(compute, "bigint")(text)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def variants(max_bits: int) -> list[tuple[int, int, int | None]]:
    """``(tag, mask, wildcard bit or None)`` of every variant of a fingerprint."""
    n = max(2, max_bits // 2 + 1)
    out = []
    for s in range(n):
        lo, hi = BITS * s // n, BITS * (s + 1) // n
        whole = sum(1 << b for b in range(lo, hi))
        out.append((len(out), whole, None))
        for b in range(lo, hi):
            out.append((len(out), whole & ~(1 << b), b))
    return out


WHOLE = 2  # the side of a variant without a wildcard


def _indexed(prints: DataFrame, max_bits: int) -> DataFrame:
    fp = F.col("fp")
    rows = [F.struct(F.lit(tag).cast("smallint").alias("tag"), fp.bitwiseAND(F.lit(_signed(mask))).alias("masked"),
                     (F.lit(WHOLE) if bit is None else F.shiftrightunsigned(fp, bit).bitwiseAND(F.lit(1))).cast("tinyint").alias("side"))
            for tag, mask, bit in variants(max_bits)]
    return prints.select("fp", F.inline(F.array(*rows)))


def _meeting_links(hot: DataFrame, max_bits: int) -> DataFrame:
    far, near = (max_bits + 1) // 2, max_bits // 2
    flips = [(0, 0)] + [(r, sum(1 << b for b in bits)) for r in range(1, far + 1) for bits in combinations(range(BITS), r)]
    steps = F.array(*[F.struct(F.lit(_signed(x)).alias("x"), F.lit(r <= near).alias("near")) for r, x in flips])
    points = hot.select("fp", F.inline(steps)).select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("point"), "near")
    hub = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("point"))
    return points.select("fp", hub.alias("hub")).where("hub <> fp").select(F.col("fp").alias("a"), F.col("hub").alias("b"))


def fingerprint_links(prints: DataFrame, max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``prints(fp)`` distinct -> ``(a, b)``: pairs within ``max_bits`` bits that connect exactly
    the fingerprints which all such pairs connect (within a large variant not every pair)."""
    # The stored table is narrow: without a number its few bytes would be merged into one or two tasks.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = _indexed(prints.repartition(parts, "fp"), max_bits)
    sides = F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("side").cast("int")))
    counts = index.groupBy("tag", "masked").agg(F.count(F.lit(1)).alias("n"), sides.alias("sides"))
    shared = stored(counts.where(((F.col("sides") == 1 << WHOLE) & (F.col("n") > 1)) | (F.col("sides") == 3))
                    .select("tag", "masked", "n"), "simhash-variants")
    members = stored(index.join(shared, ["tag", "masked"]), "simhash-members")
    small = members.where(F.col("n") <= max_bucket)
    a, b = small.alias("a"), small.alias("b")
    met = ((F.col("a.side") == 0) & (F.col("b.side") == 1)) | (
        (F.col("a.side") == WHOLE) & (F.col("a.fp") < F.col("b.fp")))
    close = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    pairs = a.join(b, (F.col("a.tag") == F.col("b.tag")) & (F.col("a.masked") == F.col("b.masked")) & met & close)
    hot = members.where(F.col("n") > max_bucket).select("fp").distinct()
    links = pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).union(_meeting_links(hot, max_bits))
    return links.distinct()


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                   max_bits: int = 2) -> DataFrame:
    """One row per document: id, ``fp`` (bigint), ``component_id`` (the least id reachable)."""
    docs = stored(df.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text), shingle).alias("fp")), "simhash")
    prints = stored(docs.groupBy("fp").agg(F.min("id").alias("least")), "simhash-prints")
    roots = connected_components(fingerprint_links(prints.select("fp"), max_bits), "a", "b")
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(rooted.join(ids, "root").select("fp", "component_id"), "simhash-classes")
    return docs.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
