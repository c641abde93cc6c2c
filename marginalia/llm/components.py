"""Connected components by alternating large-star and small-star steps.

Each step links nodes to the smallest node they know, by one aggregation and one join, so a node
with very many links is pre-aggregated and its rows are split by the join; no neighbour list is
ever gathered. Every round is stored, which cuts the lineage. The number of rounds grows with
the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Of each node, its larger neighbours to the smallest among it and its neighbours."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Of each node, itself and its smaller neighbours to the smallest of them. Here u > v."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionAll(least.select("u", F.col("m").alias("v")))


def _is_star_forest(links: DataFrame) -> bool:
    """Whether every node has one link at most and no node linked to is linked on."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionAll(
        links.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    uses = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return uses.where("out > 1 or (out > 0 and into > 0)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): every node of the ``(u, v)`` links with the smallest node it is connected to."""
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    links = materialize(_small_star(links.distinct()).where("u <> v").distinct(), "links")
    while not _is_star_forest(links):
        links = materialize(_small_star(_large_star(links)).where("u <> v").distinct(), "links")
    members = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionAll(roots)


def merged_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after more links, working on the components that they touch."""
    named = nodes.select(F.col("node"), F.col("component").alias("c"))
    of_u = links.join(named.withColumnRenamed("node", "u"), "u", "left").select(F.coalesce("c", "u").alias("u"), "v")
    both = of_u.join(named.withColumnRenamed("node", "v"), "v", "left").select("u", F.coalesce("c", "v").alias("v"))
    joined = connected_components(both)
    moved = named.join(joined.select(F.col("node").alias("c"), F.col("component").alias("d")), "c", "left")
    kept = moved.select("node", F.coalesce("d", "c").alias("component"))
    fresh = joined.join(named.select("node"), "node", "left_anti").select("node", "component")
    return materialize(kept.unionAll(fresh), "components")
