"""Mixing sources to target weights by hash-threshold histograms.

1. Token counts are summed by source; ``targets`` shares the budget by weight and caps a target
   at ``max_epochs`` times its source (water filling on the small per-source table).
2. A source takes every document ``target div size`` times.  What is left of its budget is met
   by a hash threshold: documents at or under it are taken once more.  Budgets are nested:
   under the same hash, a larger budget takes a superset.
3. Thresholds come from histograms: tokens summed by (source, top hash bits), running sums over
   the buckets find the one bucket where the budget is crossed, and only that bucket is split
   by the next bits (12, then 16, then 32 bits).  No document is sorted; each round pre-
   aggregates map-side, so a source holding a third of all rows is no hot key.
4. The filter is a comparison with the source's threshold.

The per-source table (one row per distinct source) is joined by broadcast when it is counted
to hold at most ``BROADCAST_SOURCES`` rows, else by Spark's own choice of join.

Edge cases: a null text has size 0; a null source is a source of its own, ordered last; null
ids hash like the text 'null'; the hash is of id and text, so only rows equal in both are taken alike;
sources without tokens have target 0; ties at the threshold (equal 60-bit hashes) are taken
together; an empty table gives an empty result.  Further columns pass through (internal columns
are prefixed ``_mix_``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import WORD_CLASS, broadcast_below, stored, text_or_empty

HASH_BITS = 60
LEVELS = (12, 16, 32)  # bits of each histogram level; they add up to HASH_BITS
BROADCAST_SOURCES = 100_000


def unit_hash(key: Column, text: Column, seed: str = "mix") -> Column:
    """60 bits of the md5 of ``seed:key:md5(text)``, as a non-negative bigint (the same in plain SQL)."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")), F.md5(text_or_empty(text))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """``(source, source_size)`` -> plus ``weight`` and ``target``.

    Sources weigh ``weights`` in turn (code point order, null last).  The budget is the sum of
    all sizes.  Capping and resharing until nothing is above its cap equals one water level:
    sources in order of cap / weight are capped until the level of the rest is under the next
    cap.  The windows run over the per-source table only.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.lit(list(weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    table = sizes.withColumn("weight", w.cast("bigint")).withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    by_ratio = Window.orderBy((F.col("cap").cast("double") / F.col("weight")), F.col("source").asc_nulls_last())
    before, rest = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = table.withColumns({
        "_budget": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "_weights": F.sum("weight").over(rest),
    })
    # A source is capped while its cap is at or under its share of what the ones before leave;
    # the first that is not sets the level (budget and weights) of itself and all that follow.
    capped = F.col("cap") * F.col("_weights") <= F.col("_budget") * F.col("weight")
    table = table.withColumn("_capped", capped).withColumn("_rank", F.row_number().over(by_ratio))
    table = table.withColumn("_level", F.min(F.when(~F.col("_capped"), F.struct("_rank", "_budget", "_weights"))).over(everything))
    share = F.col("_level._budget").cast("double") * F.col("weight") / F.col("_level._weights")
    target = F.when(F.col("_level").isNull() | (F.col("_rank") < F.col("_level._rank")), F.col("cap").cast("double")).otherwise(share)
    return table.select("source", "source_size", "weight", target.alias("target"))


def thresholds(docs: DataFrame, goals: DataFrame) -> DataFrame:
    """``docs(source, size, hash)``, ``goals(source, source_size, target)`` -> goals plus
    ``epochs`` (whole takes) and ``threshold`` (hash at or under which one more is taken; -1:
    none).  Three histogram rounds; each reads the stored narrow table once."""
    goals = goals.withColumn("epochs", F.when(F.col("source_size") == 0, F.lit(0).cast("bigint"))
                             .otherwise(F.floor(F.col("target") / F.col("source_size")).cast("bigint")))
    state = goals.select("source", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("_left"),
                         F.lit(0).cast("bigint").alias("_prefix")).where("_left > 0")
    shift = HASH_BITS
    for bits in LEVELS:
        width = shift
        shift -= bits
        state = stored(state, "mix-level")
        s = broadcast_below(state, BROADCAST_SOURCES).withColumnRenamed("source", "_s")
        # documents of the boundary bucket so far; at the first level that is everything
        inside = docs.join(s, docs["source"].eqNullSafe(F.col("_s"))).where(
            F.shiftright("hash", width) == F.col("_prefix"))
        hist = inside.groupBy("source", F.shiftright("hash", shift).alias("_bucket")).agg(
            F.sum("size").alias("_n"), F.first("_left").alias("_left"))
        upto = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("_sum", F.sum("_n").over(upto))
        # the bucket where the running sum first passes the budget
        crossing = hist.where(F.col("_sum") > F.col("_left")).groupBy("source").agg(
            F.min(F.struct("_bucket", "_sum", "_n", "_left")).alias("b"))
        if shift:
            state = crossing.select("source", (F.col("b._left") - (F.col("b._sum") - F.col("b._n"))).alias("_left"),
                                    F.col("b._bucket").alias("_prefix"))
        else:
            # single hashes now: take the crossing one too if that ends nearer to the budget
            over, under = F.col("b._sum") - F.col("b._left"), F.col("b._left") - (F.col("b._sum") - F.col("b._n"))
            state = crossing.select("source", (F.col("b._bucket") - F.when(over <= under, 0).otherwise(1)).alias("threshold"))
    g = goals.alias("g").join(state.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
    return g.drop("_s").withColumn("threshold", F.coalesce("threshold", F.lit(-1).cast("bigint")))


def mix_plan(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """One row per source: source, source_size, weight, target, epochs, threshold."""
    docs = stored(df.select(F.col(source).cast("string").alias("source"), word_count(text).alias("size"),
                            unit_hash(F.col(id_col), F.col(text), seed).alias("hash")), "mix-sizes")
    sizes = docs.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    return stored(thresholds(docs, stored(targets(sizes, weights, max_epochs), "mix-targets")), "mix-plan")


def word_count(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_CLASS + "+")).cast("bigint")


def mix_sources(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """``df`` plus ``size`` (words), ``source_size``, ``target`` (its source's), ``copies`` (times
    the mix takes the document, 0 to ``max_epochs``) and ``taken`` = size * copies.  Columns of
    these names that ``df`` already has are replaced."""
    plan = mix_plan(df, id_col, text, source, weights, max_epochs, seed)
    plan = plan.select(F.col("source").alias("_mix_source"),
                       F.struct("source_size", "target", "epochs", "threshold").alias("_mix_plan"))
    out = df.join(broadcast_below(plan, BROADCAST_SOURCES),
                  df[source].cast("string").eqNullSafe(F.col("_mix_source")))
    p = F.col("_mix_plan")
    once_more = F.when(unit_hash(F.col(id_col), F.col(text), seed) <= p["threshold"], 1).otherwise(0)
    out = out.withColumns({"size": word_count(text), "source_size": p["source_size"], "target": p["target"],
                           "copies": (p["epochs"] + once_more).cast("bigint")})
    return out.withColumn("taken", F.col("size") * F.col("copies")).drop("_mix_source", "_mix_plan")
