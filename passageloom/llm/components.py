"""Connected components of a table of links, by alternating large-star and small-star steps.

Defined cases: links from a node to itself, repeated links and links in both directions count once; rows with a null on
either side are no links; no links give no rows; the two columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passageloom.operators.lookup import lookup_join
from passageloom.operators.staging import stage


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    """Every node links its larger neighbours to the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
    return lookup_join(both.where("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, name: str) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them. Edges go from large to small."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")), name)
    others = lookup_join(edges, least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) of every linked node; the root is the smallest node of its component. Links are two columns of one type.

    Each round is written to the shared folder. The rounds grow with the logarithm of the longest chain, and the driver
    sees only two numbers of each. A hub never meets as a group: its links are reduced to a minimum by partial aggregates,
    and the minimum is attached by the lookup join, which splits frequent keys.
    """
    a, b = links.columns
    # The comparison drops rows with a null as well.
    edges = stage(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), name
    )
    seen = None
    while True:
        mark = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if mark == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        large = stage(_large_star(edges, name).distinct(), name)
        edges = stage(_small_star(large, name).distinct(), name)
