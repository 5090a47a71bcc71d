"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orrery.sources.storage import written


def components(edges: DataFrame) -> DataFrame:
    """`(node, component)` for every node of `edges (a, b)`; a component is named by its smallest node.

    Each step is a grouped minimum (combined before the shuffle) and a join with the written links, so a hub
    is a skewed key that adaptive execution can split. Nulls, loops and repeated links change nothing; without links
    there are no rows. The steps stop when the links no longer change, after about log(nodes) steps."""
    links = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    mark = None
    while True:
        links = written(_small_star(written(_large_star(links), "large")), "small")
        now = links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(v % 1000003)")).first()
        if mark == now:
            break
        mark = now
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour or itself. Links are `(u, v)` with u > v."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    # Seen from v, the larger neighbour is u and the smallest is v's own least neighbour, or v itself.
    return links.join(least.select(F.col("u").alias("v"), "m"), "v", "left").select(
        "u", F.coalesce("m", "v").alias("v")
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node itself, move to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved).distinct()
