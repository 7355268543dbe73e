"""Connected components of a link table, by alternating stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): every
node links its larger neighbours, then its smaller ones, to the smallest it
knows, until only stars are left.  A node's links are never gathered: the
smallest neighbour is a partial aggregate and is joined back to the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

FEW = 200_000  # links that one task takes; as many need no shuffle


def _star(edges: DataFrame, name: str, large: bool, few: bool) -> DataFrame:
    """One step over edges (a, b), a > b; ``few`` of them stay in one partition."""
    both = edges.select("a", "b")
    if large:
        both = both.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if few:
        both = both.coalesce(1)
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), name + "-least")
    if few:
        least = least.coalesce(1)
    met = both.join(least, "a")
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    out = out.where("a <> b")
    return stored((out.coalesce(1) if few else out).distinct(), name)


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of links (a, b); no links give no rows.

    Links may repeat, run either way, or join a node to itself.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        found = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if not found["n"] or tuple(found) == state:
            break
        state = tuple(found)
        few = found["n"] <= FEW
        edges = _star(_star(edges, "large-star", True, few), "small-star", False, few)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
