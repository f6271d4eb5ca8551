"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import common


def components(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """Each node with `root`, the smallest node of its component.

    `edges` has columns a < b.  Every round is written to the shared folder; a node's
    neighbours are only ever reduced to their minimum, so no list of them is gathered.
    """
    now = common.stored(edges.select("a", "b"), "links")
    before, after = None, _state(now)
    while after.n and after != before:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        now = common.stored(_star(_star(both, larger=True), larger=False), "links")
        before, after = after, _state(now)
    roots = now.groupBy(F.col("b").alias("b")).agg(F.min("a").alias("root"))
    return nodes.join(roots, nodes[node] == roots["b"], "left").select(nodes[node], F.coalesce("root", nodes[node]).alias("root"))


def _state(edges: DataFrame):
    """Number and hash sum of the edges: equal when a round changed nothing."""
    return edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """large-star: each node hangs its larger neighbours on the least node near it.
    small-star: each node hangs itself and its smaller neighbours on the least of them."""
    if larger:  # both directions are given: (a, b) for every neighbour b of a
        least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = edges.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    else:  # a < b: b looks at its smaller neighbours
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        out = edges.join(least, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).select(F.col("x").alias("a"), F.col("y").alias("b"))
    return out.where("a < b").distinct()
