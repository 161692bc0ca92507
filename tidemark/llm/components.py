"""Connected components of an edge table, by alternating stars.

Every step hangs nodes on the smallest node they see (large star over larger
neighbours, small star over smaller ones), until each component is one star. Rows
per step do not grow, and each step's result is written to the shared folder, so a
lost executor costs one step. The minimum per node is written before it is joined
back, which leaves Spark a plain join whose skewed partitions it splits when one
node has a great part of all edges.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.mixing import stored


def _star(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the smallest node that u sees, itself included."""
    low = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("low"))
    low = stored(low.select("w", F.least("w", "low").alias("low")), "star")
    return edges.join(low, F.col("u") == F.col("w")).select("u", "v", "low")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return stored(hung.filter("u != v").distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    star = _star(down)
    hung = star.select(F.col("v").alias("u"), F.col("low").alias("v")).union(
        star.select("u", F.col("low").alias("v"))
    )
    return stored(hung.filter("u != v").distinct(), "small-star")


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not the smallest of its component.

    ``edges`` are (u, v) in any direction, repeats and loops allowed; nodes without an
    edge, and the smallest node of each component, have no row. No edges: no rows.
    """
    edges = stored(edges.select("u", "v").filter("u != v").distinct(), "edges")
    before = None
    while (now := _digest(edges)) != before:
        before = now
        edges = _small_star(_large_star(edges))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
