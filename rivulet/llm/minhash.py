"""MinHash near-duplicates through a signature-coordinate inverted join.

Every document has the set of its distinct word shingles (XXH64 each) and a signature of
``coordinates`` minimum hashes.  Documents with equal sets are folded to one node first.

1. *Posting.*  A node is posted under each (coordinate, value) pair of its signature, as one 64-bit key.
   Keys that one node alone has cannot collide and are dropped; a node with fewer than ``matches``
   keys left has no partner.
2. *Prefixes.*  Two nodes that agree on ``matches`` of k coordinates share a key among the k -
   matches + 1 rarest of either (keys in one global order by frequency), so only these are
   joined; the frequent keys are skipped and looked at for surviving pairs only.
3. *Stars.*  Each key's nodes are paired with the key's hub, its node with the most frequent keys, not
   with each other.  Pairs whose whole signatures collide on at least ``matches`` coordinates are
   confirmed on the full sets; confirmed pairs give components.
4. *Rest.*  Nodes that share a key share its hub, so all other pairs meet at a hub.  A hub whose nodes now
   lie in one component has nothing left to find.  At all others, the nodes outside the hub's
   component meet those of other components, block by block: a task has two blocks of bounded size, gets all
   common sizes of their full sets at once (products of 0/1 matrices for common shingles, counts by
   pairs for rare ones), looks at the collisions of similar pairs and returns a forest of links.

So every pair that agrees on ``matches`` coordinates is confirmed, or its ends are already connected;
components are exactly those of all such pairs.  With 64 coordinates and 32 matches a link of
similarity 0.8 is missed with probability 2e-8, of 0.85 with 6e-12.  Copies and near copies that
a hub connects are never compared with each other; nodes that no hub connects are, so a large group whose
members lie just below the similarity costs its unconnected members times all members, shared by tasks.

Texts are moved only for nodes of candidate pairs, whose sets are made again from the text.

Edge cases: ``A-Z`` is lower-cased; a text with fewer words than a shingle is one shingle; a null or
blank text has an empty set, is linked with nothing and is its own component; null ids never
become a component id unless the whole component has none; rows that share an id or a text are
all returned; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_batches_below, bit_table, broadcast_below, row_digest, stored, with_may_match
from rivulet.llm.components import connected_components

COORDINATES, MATCHES = 64, 32
BROADCAST_TEXTS = 200_000  # text digests (16 bytes each) that are broadcast instead of shuffling texts
_BLOCK = 1024  # shingles hashed at a time
_CELL_ROWS, _CELL_VALUES = 2048, 1 << 20  # rows and set values of a block that is compared with another at once
_DENSE_SHARE, _COLUMNS, _PAIRS, _MET = 64, 512, 1 << 22, 1 << 14  # sizes of single steps of a comparison
_BATCH_BYTES = 16 << 20


def shingle_hashes(raw: bytes, shingle: int):
    """Distinct XXH64 hashes of the word shingles of one UTF-8 text, ascending.  ``bytes.lower`` and
    ``bytes.split`` act on ASCII letters and on exactly the contract's six white-space bytes."""
    import numpy as np
    import xxhash

    w = raw.lower().split()
    if not w:
        return np.empty(0, dtype=np.uint64)
    pieces = map(b" ".join, zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, pieces), dtype=np.uint64, count=max(1, len(w) - shingle + 1)))


def _coefficients(n: int):
    """``n`` pairs (mask, odd multiplier) and a 64-bit tag per coordinate, from a fixed rule."""
    import numpy as np
    import xxhash

    made = lambda what: np.array([xxhash.xxh64_intdigest(f"{what}{i}", 42) for i in range(n)], dtype=np.uint64)
    return made("mask")[:, None], made("times")[:, None] | np.uint64(1), made("tag")


def signature(hashes, coefficients):
    """The key of every coordinate: its minimum hash, mixed with the coordinate's tag."""
    import numpy as np

    mask, times, tag = coefficients
    least = np.full(len(tag), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        x = (hashes[None, at:at + _BLOCK] ^ mask) * times
        x ^= x >> np.uint64(32)  # so that low bits of a product count too
        np.minimum(least, x.min(axis=1), out=least)
    return (least ^ tag) * np.uint64(0x9E3779B97F4A7C15)


def _summaries(shingle: int, coordinates: int):
    """Text -> (set size, 128-bit digest of the set, signature)."""

    def compute(texts: pa.Array) -> pa.Array:
        import numpy as np
        import xxhash

        coefficients = _coefficients(coordinates)
        sizes, digests, keys, offsets = [], [], [], [0]
        for raw in texts.cast(pa.binary()).to_pylist():
            hashes = shingle_hashes(raw or b"", shingle)
            sizes.append(len(hashes))
            digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
            if len(hashes):
                keys.append(signature(hashes, coefficients).view(np.int64))
            offsets.append(offsets[-1] + coordinates * (len(hashes) > 0))
        flat = np.concatenate(keys) if keys else np.empty(0, dtype=np.int64)
        signatures = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), signatures], ["n", "node", "sig"])

    return F.arrow_udf(compute, "n bigint, node binary, sig array<bigint>")


def _sets(shingle: int):
    def compute(texts: pa.Array) -> pa.Array:
        import numpy as np

        found = [shingle_hashes(raw or b"", shingle).view(np.int64) for raw in texts.cast(pa.binary()).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found) if found else np.empty(0, dtype=np.int64)))

    return F.arrow_udf(compute, "array<bigint>")


def _postings(nodes: DataFrame, matches: int) -> DataFrame:
    """``(key, node, central)`` of the prefixes: the rarest shared keys of each node that can have a partner."""
    every = nodes.select("node", F.explode("sig").alias("key"))
    shared = stored(every.groupBy("key").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1"), "minhash-keys")
    own = every.join(shared, "key").groupBy("node").agg(F.sum("freq").alias("central"),
                                                        F.sort_array(F.collect_list(F.struct("freq", "key"))).alias("keys"))  # one per coordinate
    prefix = F.slice("keys", F.lit(1), F.greatest(F.size("keys") - matches + 1, F.lit(0)))
    return stored(own.select("node", "central", F.explode(prefix).alias("k")).select("k.key", "node", "central"), "minhash-postings")


def _ratio(small: Column, large: Column, percent: int) -> Column:
    """Sizes that allow the similarity: the intersection is the smaller set at most."""
    return 100 * F.least(small, large) >= percent * F.greatest(small, large)


def _collisions(a: str, b: str) -> Column:
    return F.size(F.array_intersect(a, b))


def _similar(a: str, b: str, percent: int) -> Column:
    both = F.size(F.array_intersect(a, b)).cast("bigint")
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def _full_sets(needed: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """``(node, set)`` of the needed nodes, from one of the texts that have the set."""
    wanted = stored(needed.join(nodes.select("node", "text"), "node").select(F.col("text").alias("digest"), "node"), "minhash-wanted")
    own = texts.select(row_digest(F.col("text")).alias("digest"), "text")
    if wanted.count() > BROADCAST_TEXTS:  # other texts stay out of the shuffle
        own = with_may_match(own, F.col("digest.a"), bit_table(wanted, F.col("digest.a")), "hit").where("hit").select("digest", "text")
    own = own.join(broadcast_below(wanted, BROADCAST_TEXTS), "digest")
    own = own.groupBy("node").agg(F.min("text").alias("text"))
    return stored(own.select("node", _sets(shingle)(F.col("text")).alias("set")), "minhash-sets")


def _shared_sizes(rows, values, in_a, in_b):
    """``|a & b|`` of every two sets, as a matrix.  A pair (rows[i], values[i]) says that a set has a
    value; ``in_a`` and ``in_b`` number the sets of either side (-1: not on that side)."""
    import numpy as np

    n_a, n_b = int(in_a.max(initial=-1)) + 1, int(in_b.max(initial=-1)) + 1
    out = np.zeros((n_a, n_b), dtype=np.int32)
    own, code, total = np.unique(values, return_inverse=True, return_counts=True)
    a, b = in_a[rows], in_b[rows]
    of_a, of_b = (np.bincount(code[side >= 0], minlength=len(own)) for side in (a, b))
    both = (total > 1) & (of_a > 0) & (of_b > 0)
    pairs = of_a * of_b
    often = both & (pairs * _DENSE_SHARE >= n_a * n_b)

    place = np.cumsum(often) - 1  # common values: products of 0/1 matrices
    dense = [(side[at], place[code[at]]) for side in (a, b) for at in [np.flatnonzero(often[code] & (side >= 0))]]
    for start in range(0, int(often.sum()), _COLUMNS):
        x, y = (np.zeros((n, _COLUMNS), dtype=np.float32) for n in (n_a, n_b))
        for into, (row, column) in zip((x, y), dense):
            at = (column >= start) & (column < start + _COLUMNS)
            into[row[at], column[at] - start] = 1
        out += (x @ y.T).astype(np.int32)

    rare = both & ~often  # others: one count for each two sets that have the value
    at_a, at_b = (np.flatnonzero(rare[code] & (side >= 0)) for side in (a, b))
    at_b = at_b[np.argsort(code[at_b], kind="stable")]
    first = np.cumsum(np.where(rare, of_b, 0)) - of_b
    ends = np.cumsum(of_b[code[at_a]])
    start, done = 0, 0
    while start < len(at_a):
        stop = max(start + 1, int(np.searchsorted(ends, done + _PAIRS, side="right")))
        part = code[at_a[start:stop]]
        times = of_b[part]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        met = np.repeat(a[at_a[start:stop]], times) * n_b + b[at_b[np.repeat(first[part], times) + nth]]
        out += np.bincount(met, minlength=n_a * n_b).astype(np.int32).reshape(n_a, n_b)
        start, done = stop, int(ends[stop - 1])
    return out


def _forest(met):
    """``(row, column)`` of links that connect whatever the true entries connect: fewer than rows + columns."""
    import numpy as np

    found, new_row, new_column = [], met.any(axis=1), met.any(axis=0)
    for first in np.flatnonzero(new_row):
        todo = [first] if new_row[first] else []
        new_row[first] = False
        while todo:
            row = todo.pop()
            for column in np.flatnonzero(met[row] & new_column):
                new_column[column] = False
                found.append((row, column))
                more = np.flatnonzero(met[:, column] & new_row)
                new_row[more] = False
                found.extend((r, column) for r in more)
                todo.extend(more)
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def _cell_links(cell: pa.Table, percent: int, matches: int):
    """``(a, b)``: positions of rows of one cell, links that connect what all its links connect."""
    import numpy as np

    sets, roots = cell["set"].combine_chunks(), cell["root"].combine_chunks().dictionary_encode().indices.to_numpy()
    n = sets.value_lengths().to_numpy().astype(np.int64)
    block, apart = cell["block"].to_numpy(), cell["apart"].to_numpy()
    a = np.flatnonzero((block == cell["i"][0].as_py()) & apart)
    b = np.flatnonzero(block == cell["j"][0].as_py())
    in_a, in_b = np.full(len(n), -1, dtype=np.int64), np.full(len(n), -1, dtype=np.int64)
    in_a[a], in_b[b] = np.arange(len(a)), np.arange(len(b))
    shared = _shared_sizes(np.repeat(np.arange(len(n)), n), sets.flatten().to_numpy(), in_a, in_b)
    met = (100 + percent) * shared.astype(np.int64) >= percent * (n[a][:, None] + n[b][None, :])
    met &= roots[a][:, None] != roots[b][None, :]
    keys = cell["sig"].combine_chunks().flatten().to_numpy().reshape(len(n), -1)
    rows, columns = np.nonzero(met)
    for at in range(0, len(rows), _MET):
        r, c = rows[at:at + _MET], columns[at:at + _MET]
        met[r, c] = (keys[a[r]] == keys[b[c]]).sum(axis=1) >= matches
    links = _forest(met)
    return a[links[:, 0]], b[links[:, 1]]


def _rest_links(named: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """``(a, b)`` between components that meet at a hub.  A hub's nodes are dealt into blocks of bounded
    rows and bounded set sizes, those apart from the hub's component and the others by themselves;
    a cell is two blocks, one of them of nodes apart."""
    main = F.max(F.when(F.col("hub") == F.col("node"), F.col("root")))
    open_hubs = named.groupBy("hub").agg(F.min("root").alias("low"), F.max("root").alias("high"), main.alias("main")).where("low <> high")
    left = named.join(open_hubs.select("hub", "main"), "hub").join(nodes.select("node", "n", "sig"), "node")
    left = stored(left.select("hub", "node", "root", "n", "sig", (F.col("root") != F.col("main")).alias("apart")), "minhash-rest")

    blocks = lambda rows, size: F.ceil(F.greatest(rows / F.lit(_CELL_ROWS), size / F.lit(_CELL_VALUES)))
    own = lambda x: F.coalesce(F.sum(F.when(F.col("apart"), x)), F.lit(0))
    dealt = left.groupBy("hub").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("size"),
                                      own(F.lit(1)).alias("rows_apart"), own(F.col("n")).alias("size_apart"))
    one = blocks(F.col("rows"), F.col("size")) <= 1
    dealt = dealt.select("hub", F.when(one, 1).otherwise(blocks(F.col("rows_apart"), F.col("size_apart"))).alias("p"),
                         F.when(one, 0).otherwise(blocks(F.col("rows") - F.col("rows_apart"), F.col("size") - F.col("size_apart"))).alias("q"))
    nth = F.xxhash64("node")
    block = F.when(F.col("apart") | (F.col("q") == 0), F.pmod(nth, F.col("p"))).otherwise(F.col("p") + F.pmod(nth, F.col("q")))
    cells = left.join(dealt, "hub").select("hub", "node", "root", "sig", "apart", "p", "q", block.alias("block"))
    others = F.when(F.col("block") < F.col("p"), F.col("p") + F.col("q")).otherwise(F.col("p"))
    cells = cells.withColumn("t", F.explode(F.sequence(F.lit(0).cast("bigint"), others - 1)))
    cells = cells.join(sets, "node").select("hub", F.least("block", "t").alias("i"), F.greatest("block", "t").alias("j"),
                                            "block", "apart", "node", "root", "sig", "set")
    cells = cells.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")

    def search(batches):
        import numpy as np

        def linked(parts):
            cell = pa.Table.from_batches(parts)
            a, b = _cell_links(cell, percent, matches)
            node = cell["node"].combine_chunks()
            return pa.RecordBatch.from_arrays([node.take(pa.array(x)) for x in (a, b)], ["a", "b"])

        key, parts = None, []
        for batch in batches:
            hub, i, j = batch["hub"].dictionary_encode().indices.to_numpy(), batch["i"].to_numpy(), batch["j"].to_numpy()
            cuts = np.flatnonzero((hub[1:] != hub[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(hub)]):
                if start == stop:
                    continue
                own_key = (batch["hub"][int(start)].as_py(), i[start], j[start])
                if parts and own_key != key:
                    yield linked(parts)
                    parts = []
                key = own_key
                parts.append(batch.slice(start, stop - start))
        if parts:
            yield linked(parts)

    with arrow_batches_below(named.sparkSession, _BATCH_BYTES):
        return stored(cells.mapInArrow(search, "a binary, b binary"), "minhash-found")


def near_links(nodes: DataFrame, texts: DataFrame, shingle: int, percent: int, matches: int) -> DataFrame:
    """``(a, b)``: links that connect exactly the nodes which all links connect."""
    postings = _postings(nodes, matches)
    hubs = postings.groupBy("key").agg(F.max(F.struct("central", "node")).alias("hub"))
    members = stored(postings.join(hubs, "key").select(F.col("hub.node").alias("hub"), "node").distinct(), "minhash-members")
    sets = _full_sets(members.select("node").distinct(), nodes, texts, shingle)

    side = lambda c: nodes.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("n").alias(f"n_{c}"))
    stars = members.where("hub <> node").select(F.col("node").alias("a"), F.col("hub").alias("b")).join(side("a"), "a").join(side("b"), "b")
    stars = stars.where(_ratio(F.col("n_a"), F.col("n_b"), percent)).where(_collisions("sig_a", "sig_b") >= matches).select("a", "b")
    full = lambda c: sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}"))
    links = stars.join(full("a"), "a").join(full("b"), "b").where(_similar("set_a", "set_b", percent)).select("a", "b")
    links = stored(links, "minhash-links")

    roots = stored(connected_components(links, "a", "b"), "minhash-roots")
    named = stored(members.join(roots, "node", "left").select("hub", "node", F.coalesce("root", "node").alias("root")), "minhash-named")
    return links.union(_rest_links(named, nodes, sets, percent, matches))


def minhash_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80,
                   coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (the least id reachable) and
    ``kept`` (the id is its component's)."""
    texts = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    made = texts.select("id", row_digest(F.col("text")).alias("text"), _summaries(shingle, coordinates)(F.col("text")).alias("s"))
    docs = stored(made.select("id", "text", "s.*"), "minhash-docs")
    full = docs.where("n > 0")
    nodes = full.groupBy("node").agg(F.min("id").alias("least"), F.min(F.struct("text", "n", "sig")).alias("any"))
    nodes = stored(nodes.select("node", "least", "any.*"), "minhash-nodes")
    links = near_links(nodes, texts, shingle, percent, matches)
    roots = connected_components(links, "a", "b")
    rooted = nodes.select("node", "least").join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(rooted.join(ids, "root").select("node", "component_id"), "minhash-classes")
    grouped = full.select("id", "n", "node").join(classes, "node").select("id", "n", "component_id")
    grouped = grouped.unionByName(docs.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return grouped.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                          F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
