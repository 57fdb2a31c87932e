"""Connected components of a link table by alternating large-star and small-star rounds.

Each round is two aggregations with map-side combine and two joins on a node; the edge set is
written to the shared folder after each round, so lineage stays short and lost executors cost
one round at most.  Only an edge count and a checksum reach the driver.  The number of rounds
grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    inner = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.union(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node that some link names; root is the least node of its
    component.  Links may repeat, run either way and join a node to itself (self links add no
    row); links with a null end are ignored."""
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stored(edges, "components")
    mark = _mark(edges)
    while mark[0]:
        stars = _small_star(_large_star(edges).distinct()).distinct()
        edges = stored(stars, "components")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v"), F.col("v")).distinct())
