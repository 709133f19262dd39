"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.stages import discard, saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node under the smallest one."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("a"), F.least("m", "u").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every smaller neighbour of a node, and the node, under the smallest one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; component is its least node.

    ``links`` has two id columns; order, repeats, nulls and loops do not matter.
    Alternates large and small stars until nothing changes. Each round is a
    written table, nothing is collected but one row of totals, and a node with
    any number of links is summed per task before it is shuffled.
    """
    a, b = links.columns[:2]
    edges = links.select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    ).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current = saved(edges.distinct(), "links")
    seen = None
    while True:
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()  # one row
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        following = saved(_small_star(_large_star(current)), "links")
        discard(current)
        current = following
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node")).distinct()
    return nodes.unionByName(roots.withColumn("component", F.col("node")))
