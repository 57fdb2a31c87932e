"""Prefix trie of conversations with subtree rollups by centroid decomposition.

A node is a distinct sequence of first turns.  Its key is the XOR of 128-bit hashes of (position,
role, text) over the sequence, so a parent's key is the child's key without its last turn's hash
and every (conversation, position) row of the path table names one node.

The parent-edge forest is decomposed in rounds.  Of each component the centroid is the deepest node
whose part of the component holds more than half of it.  The total below the centroid is one
aggregate of the component; it is added to the nodes on the path from the centroid to the
component's top (rows of the path table of one conversation, found by equality), whose sizes
shrink by what is cut off.  The centroid is done, its children's subtrees and the rest above it
are the next components, each at most half as large.  So rounds grow with the logarithm of the
largest component, however deep it is.  Components of at most ``local`` nodes are dealt out to tasks
whole and decomposed there in the same way.

Sizes need no rollup of their own: the least member of a node owns it, a conversation's own nodes are
the lower end of its path, so a node's subtree holds all own nodes of its members but those
of its owner above it.

Skew: a node's members meet only in aggregates with map-side combine.  Turns of a conversation are
ranked and hashed in chunks of ``CHUNK`` turn numbers (positions), with the counts and hashes of earlier
chunks carried over.  A digest over the ids that end at one node is by nature computed in one task; it
streams them in order.

Edge cases: turns are ordered by (turn, role, text), nulls first; a null role or text is empty; rows
without an id form one conversation, which takes no other's turns, sorts first and counts as the id
``null`` (returned as null); repeated rows are turns of their own; further columns are ignored; an
empty table has no node.  A conversation whose turns are all null or equal is ranked in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import broadcast_below, stored, text_or_empty, words

CHUNK_BITS = 12  # turns of a conversation that are ranked together
LOCAL_NODES = 4096  # component size up to which one task finishes a component
BROADCAST_COMPONENTS = 20_000
_NO_ID = -(1 << 63)  # stands for a missing id
_KEY = ["ka", "kb"]
_TOP = ["ta", "tb"]


def _carried(df: DataFrame, chunk: Column, amount: list[tuple[Column, Column, str]]) -> DataFrame:
    """``df`` plus, per ``(aggregate, combination, name)``, the value over earlier chunks of
    the conversation (null in its first chunk)."""
    named = df.withColumn("chunk", chunk)
    per = named.groupBy("c", "chunk").agg(*[total.alias(name) for total, _, name in amount])
    before = Window.partitionBy("c").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select("c", "chunk", F.row_number().over(Window.partitionBy("c").orderBy("chunk")).alias("nth"),
                       *[combined.over(before).alias(name) for _, combined, name in amount])
    return named.join(carry.where("nth > 1").drop("nth"), ["c", "chunk"], "left")


def _ranked(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(c, r, role, text)``: turns of a conversation numbered from 1."""
    rows = df.select(F.coalesce(F.col(conv).cast("bigint"), F.lit(_NO_ID)).alias("c"), F.col(turn).cast("bigint").alias("turn"),
                     text_or_empty(role).alias("role"), text_or_empty(text).alias("text"))
    chunk = F.coalesce(F.shiftright("turn", CHUNK_BITS), F.lit(-(1 << 60)))
    rows = _carried(rows, chunk, [(F.count(F.lit(1)), F.sum("earlier"), "earlier")])
    own = F.row_number().over(Window.partitionBy("c", "chunk").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    return rows.select("c", (own + F.coalesce("earlier", F.lit(0))).alias("r"), "role", "text")


def rebuilt(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """``(turns, convs)``: ``turns(c, pos, role, text)`` and ``convs(c)``.  A conversation starts
    with the first h turns of conversation ``c - c % every`` (h = crc32 of its decimal id,
    modulo ``most``), then come its own turns after its first h."""
    ranked = stored(_ranked(df, conv, turn, role, text), "trie-turns")
    has = F.col("c") != _NO_ID
    sizes = ranked.groupBy("c").agg(F.count(F.lit(1)).alias("n")).withColumns({
        "h": F.when(has, F.crc32(F.col("c").cast("string")) % most).otherwise(0),
        "base": F.when(has, F.col("c") - F.col("c") % every)})
    first = ranked.where((F.col("r") < most) & (F.col("c") % every == 0) & has)
    shared = (sizes.where("h > 0").select(F.col("c").alias("own"), "h", "base").join(first, F.col("base") == first["c"])
              .where("r <= h").select(F.col("own").alias("c"), F.col("r").alias("pos"), "role", "text"))
    bases = first.groupBy(F.col("c").alias("base")).agg(F.count(F.lit(1)).alias("there"))
    convs = stored(sizes.join(bases, "base", "left").select("c", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")), "trie-convs")
    rest = ranked.join(convs, "c").where("r > h").select("c", (F.col("taken") + F.col("r") - F.col("h")).alias("pos"), "role", "text")
    return shared.unionByName(rest), convs.select("c")


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``(c, pos, ka, kb, pa, pb, words)``: the node of every position (0: the root) of every
    conversation and that node's parent."""
    hashed = turns.select("c", "pos", F.xxhash64("pos", "role", "text").alias("ha"), F.xxhash64(F.lit(1), "pos", "text", "role").alias("hb"),
                          F.size(words(F.col("text"))).cast("bigint").alias("words"))
    amount = [(F.bit_xor(x), F.bit_xor(name), name) for x, name in (("ha", "xa"), ("hb", "xb"))]
    hashed = _carried(hashed, F.shiftright(F.col("pos") - 1, CHUNK_BITS), amount)
    run = Window.partitionBy("c", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    for key, own, carry in (("ka", "ha", "xa"), ("kb", "hb", "xb")):
        hashed = hashed.withColumn(key, F.bit_xor(own).over(run).bitwiseXOR(F.coalesce(carry, F.lit(0))))
    rows = hashed.select("c", "pos", *_KEY, F.col("ka").bitwiseXOR(F.col("ha")).alias("pa"), F.col("kb").bitwiseXOR(F.col("hb")).alias("pb"), "words")
    zero = F.lit(0).cast("bigint")
    root = convs.select("c", zero.alias("pos"), zero.alias("ka"), zero.alias("kb"), F.lit(None).cast("bigint").alias("pa"),
                        F.lit(None).cast("bigint").alias("pb"), zero.alias("words"))
    return stored(rows.unionByName(root), "trie-paths")


def _nodes(rows: DataFrame) -> DataFrame:
    """A row per node: key, parent's key, depth, least member, members, words, children, size."""
    nodes = rows.groupBy(*_KEY).agg(F.max("pos").alias("depth"), F.min("c").alias("conv"), F.count(F.lit(1)).alias("n_convs"),
                                    F.max("words").alias("words"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    nodes = stored(nodes, "trie-nodes")
    own = nodes.groupBy("conv").agg(F.count(F.lit(1)).alias("own"), F.min("depth").alias("from"))
    sizes = rows.join(own.select(F.col("conv").alias("c"), "own"), "c").groupBy(*_KEY).agg(F.sum("own").alias("below"))
    children = nodes.where("pa is not null").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count(F.lit(1)).alias("n_children"))
    full = nodes.join(children, _KEY, "left").join(sizes, _KEY).join(own.select("conv", "from"), "conv")
    return stored(full.withColumns({"size": F.col("below") - (F.col("depth") - F.col("from")),
                                    "n_children": F.coalesce("n_children", F.lit(0))}).drop("below", "from"), "trie-sized")


def decompose(parents: list[int], values: list[tuple]) -> list[list]:
    """Subtree totals of one tree by centroid decomposition.  Nodes are numbered so that a parent
    comes before its children; ``parents[0]`` is ignored."""
    totals = [[0] * len(v) for v in values]
    todo = [list(range(len(parents)))]
    size = [0] * len(parents)
    heavy = [0] * len(parents)
    mark = [-1] * len(parents)

    def add(node: int, amount) -> None:
        own = totals[node]
        for i, x in enumerate(amount):
            own[i] += x

    while todo:
        part = todo.pop()
        top = part[0]
        if len(part) == 1:
            add(top, values[top])
            continue
        for v in part:
            size[v], heavy[v], mark[v] = 1, -1, -1
        for v in reversed(part[1:]):
            p = parents[v]
            size[p] += size[v]
            if heavy[p] < 0 or size[v] > size[heavy[p]]:
                heavy[p] = v
        c = top
        while heavy[c] >= 0 and 2 * size[heavy[c]] > len(part):
            c = heavy[c]
        below = list(values[c])
        pieces: dict[int, list[int]] = {}
        mark[c] = c
        for v in part:
            if v != c and v != top and mark[parents[v]] >= 0:
                mark[v] = v if parents[v] == c else mark[parents[v]]
                pieces.setdefault(mark[v], []).append(v)
                for i, x in enumerate(values[v]):
                    below[i] += x
        add(c, below)
        at = c
        while at != top:
            at = parents[at]
            add(at, below)
        rest = [v for v in part if mark[v] < 0]
        todo += [*pieces.values(), *([rest] if rest else [])]
    return totals


def _finish(batches):
    """Rows ``(ta, tb, depth, ka, kb, pa, pb, own..., acc...)`` sorted by component and depth."""
    import numpy as np
    import pyarrow as pa

    def done(rows: list[tuple]) -> pa.RecordBatch:
        """Whole components, one after the other."""
        at, parents, values, first, out = {}, [], [], 0, []
        for i, r in enumerate(rows):
            if r[:2] != rows[first][:2]:
                out += decompose(parents, values)
                at, parents, values, first = {}, [], [], i
            at[r[3:5]] = i - first
            parents.append(at.get(r[5:7], 0))
            values.append(r[7:9])
        out += decompose(parents, values)
        found = np.array([[r[3], r[4], r[9] + t[0], r[10] + t[1]] for r, t in zip(rows, out)], dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(4)], ["ka", "kb", "n_leaves", "saved"])

    held: list[tuple] = []
    for batch in batches:
        held += zip(*(c.to_pylist() for c in batch.columns))
        if not held:
            continue
        last = held[-1][:2]
        cut = len(held)
        while cut and held[cut - 1][:2] == last:
            cut -= 1
        if cut:
            yield done(held[:cut])
            held = held[cut:]
    if held:
        yield done(held)


_SUMS = ["n_leaves", "saved"]
_STATE = [*_TOP, "depth", *_KEY, "pa", "pb", *_SUMS, "acc_n_leaves", "acc_saved", "conv", "size", "tdepth", "tsize"]


def _round(big: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One decomposition step: ``(finished centroids, nodes left with their new components)``."""
    z = big.where(2 * F.col("size") > F.col("tsize")).groupBy(*_TOP).agg(
        F.max(F.struct("depth", *_KEY, "conv", "size", "tdepth")).alias("z"))
    z = broadcast_below(stored(z.select(*_TOP, *[F.col(f"z.{x}").alias(f"z_{x}") for x in ("depth", *_KEY, "conv", "size", "tdepth")]), "trie-centroids"),
                        BROADCAST_COMPONENTS)
    at = big.join(z, _TOP)
    child = rows.select(F.col("c").alias("conv"), F.col("pos").alias("child_pos"), F.col("pa").alias("z_ka"), F.col("pb").alias("z_kb"),
                        F.col("ka").alias("child_a"), F.col("kb").alias("child_b"))
    at = at.withColumn("child_pos", F.col("z_depth") + 1).join(child, ["conv", "child_pos", "z_ka", "z_kb"], "left")
    deeper = (F.col("depth") > F.col("z_depth")) & F.col("child_a").isNotNull()
    is_z = (F.col("ka") == F.col("z_ka")) & (F.col("kb") == F.col("z_kb"))
    at = stored(at.withColumn("side", F.when(is_z, 0).when(deeper, 1).otherwise(2)), "trie-split")

    below = at.where("side < 2").groupBy("z_ka", "z_kb").agg(*[F.sum(x).alias(f"sum_{x}") for x in _SUMS])
    cut = stored(z.join(below, ["z_ka", "z_kb"]), "trie-cut")
    finished = (at.where("side = 0").join(broadcast_below(cut.select("z_ka", "z_kb", *[f"sum_{x}" for x in _SUMS]), BROADCAST_COMPONENTS), ["z_ka", "z_kb"])
                .select(*_KEY, *[(F.col(f"acc_{x}") + F.col(f"sum_{x}")).alias(x) for x in _SUMS]))
    # The path from a centroid's parent up to the top: rows of the path of its least member.
    up = cut.join(rows.select(F.col("c").alias("z_conv"), "pos", *_KEY), "z_conv").where("pos >= z_tdepth and pos < z_depth") \
        .select(*_KEY, "z_size", *[f"sum_{x}" for x in _SUMS])
    rest = at.where("side = 2").join(up.drop("z_size").withColumn("on_path", F.lit(True)), _KEY, "left")
    rest = rest.withColumns({f"acc_{x}": F.col(f"acc_{x}") + F.coalesce(f"sum_{x}", F.lit(0)) for x in _SUMS} | {
        "size": F.when(F.col("on_path"), F.col("size") - F.col("z_size")).otherwise(F.col("size")),
        "tsize": F.col("tsize") - F.col("z_size")}).select(*_STATE)
    parts = at.where("side = 1")
    tops = parts.where((F.col("child_a") == F.col("ka")) & (F.col("child_b") == F.col("kb"))).select("child_a", "child_b", F.col("size").alias("part_size"))
    parts = parts.join(tops, ["child_a", "child_b"]).withColumns(
        {"ta": F.col("child_a"), "tb": F.col("child_b"), "tdepth": F.col("z_depth") + 1, "tsize": F.col("part_size")}).select(*_STATE)
    return finished, parts.unionByName(rest)


def rollup(nodes: DataFrame, rows: DataFrame, local: int = LOCAL_NODES) -> DataFrame:
    """``(ka, kb, n_leaves, saved)``: totals over every node's subtree."""
    zero = F.lit(0).cast("bigint")
    total = nodes.agg(F.max("size").alias("tsize"))  # the root's
    state = nodes.crossJoin(F.broadcast(total)).select(  # one row
        zero.alias("ta"), zero.alias("tb"), "depth", *_KEY, "pa", "pb", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), zero.alias("acc_n_leaves"), zero.alias("acc_saved"), "conv", "size", zero.alias("tdepth"), "tsize")
    state = stored(state, "trie-state")
    done, small = [], []
    while True:
        small.append(state.where(F.col("tsize") <= local))
        big = state.where(F.col("tsize") > local)
        if big.isEmpty():
            break
        finished, left = _round(big, rows)
        done.append(stored(finished, "trie-finished"))
        state = stored(left, "trie-state")
    whole = small[0]
    for s in small[1:]:
        whole = whole.unionByName(s)
    dealt = whole.select(*_STATE[:11]).repartition(*_TOP).sortWithinPartitions(*_TOP, "depth")
    out = dealt.mapInArrow(_finish, "ka bigint, kb bigint, n_leaves bigint, saved bigint")
    for d in done:
        out = out.unionByName(d)
    return out


def _end_digests(batches):
    """Rows ``(ka, kb, c)`` sorted -> SHA-256 over the comma-joined ids of each node."""
    import hashlib

    import pyarrow as pa

    now, digest, out = None, None, ([], [], [])

    def close():
        if now is not None:
            for column, x in zip(out, (*now, digest.hexdigest())):
                column.append(x)

    for batch in batches:
        for a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
            name = b"null" if c == _NO_ID else b"%d" % c
            if (a, b) == now:
                digest.update(b"," + name)
            else:
                close()
                now, digest = (a, b), hashlib.sha256(name)
        if len(out[0]) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2])], ["ka", "kb", "ends"])
            out = ([], [], [])
    close()
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2])], ["ka", "kb", "ends"])


def prefix_trie(turns: DataFrame, convs: DataFrame, local: int = LOCAL_NODES) -> DataFrame:
    """One row per node of the trie of ``turns(c, pos, role, text)``: ``conv_id`` (least member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``."""
    rows = paths(turns, convs)
    nodes = _nodes(rows)
    totals = stored(rollup(nodes, rows, local), "trie-totals")
    ends = rows.groupBy("c").agg(F.max(F.struct("pos", *_KEY)).alias("e")).select(F.col("e.ka").alias("ka"), F.col("e.kb").alias("kb"), "c")
    ends = ends.repartition(*_KEY).sortWithinPartitions(*_KEY, "c").mapInArrow(_end_digests, "ka bigint, kb bigint, ends string")
    # Children of the root all have the same parent: they take it from a one-row table.
    named = nodes.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv").alias("parent"), F.col("depth").alias("parent_depth"))
    root = named.where("parent_depth = 0").select(F.col("parent").alias("root"))
    above = named.where("parent_depth > 0").drop("parent_depth")
    deep = nodes.join(above, ["pa", "pb"], "left").crossJoin(F.broadcast(root))  # one row
    parent = F.when(F.col("depth") == 1, F.col("root")).otherwise(F.col("parent"))
    named_id = lambda x: F.when(x != _NO_ID, x)
    out = deep.join(totals, _KEY).join(ends, _KEY, "left")
    return out.select(named_id(F.col("conv")).alias("conv_id"), "depth", named_id(parent).alias("parent_conv_id"), "n_convs", "n_children",
                      "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
