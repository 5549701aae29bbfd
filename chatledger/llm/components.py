"""Connected components of a link table, by alternating star contractions.

Each round shuffles the remaining links; nothing is collected. A node with very many
neighbours is pre-aggregated for its minimum and its links are spread by Spark's skew
handling of the join. Rounds end as soon as the links are stars, which one aggregation
by node tells; links that are stars from the start need no round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.llm.common import stored

_MOST_ROUNDS = 100


def _star(links: DataFrame) -> DataFrame:
    """Links (node, root) from every neighbour of a node to the node's smallest neighbour
    or itself; ``links`` hold each pair in the directions the caller wants."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select(F.col("a"), F.least("a", "least").alias("root"))
    return links.join(least, "a")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node of the distinct links (a, b), a > b, either has one link to a
    smaller node and none from a larger one, or only links from larger ones. Contraction
    keeps what is connected, so the smaller nodes are then the roots."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down + up > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of the links (a, b), the smallest node it can reach.
    Links may repeat, point either way or to the node itself; none may be null."""
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    for _ in range(_MOST_ROUNDS):
        if _all_stars(edges):
            break
        # large star: neighbours above a node link to its smallest neighbour
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        # small star: neighbours below a node, and the node, link to the smallest one
        found = _star(large)
        small = found.select(F.col("b").alias("a"), F.col("root").alias("b")).unionAll(
            found.select("a", F.col("root").alias("b"))
        )
        edges = stored(small.where("a <> b").distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
