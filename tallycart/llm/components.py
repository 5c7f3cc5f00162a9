"""Connected components of an edge table, each named by its smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.session import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``edges``, by alternating star steps.

    A large star links each larger neighbour of a node to the node's least neighbour, a
    small star each smaller one; repeated until every node is linked to its component's least
    node alone. Each step is an aggregate that combines before its
    shuffle and a join back that keeps no state, so a node with very many edges is
    split like any skewed key. Steps are written to the shared folder to cut the lineage.

    Null ends and loops are dropped. An empty table has no components.
    """
    low, high = F.least(a, b).alias("u"), F.greatest(a, b).alias("v")
    now = edges.filter(f"{a} is not null and {b} is not null and {a} <> {b}")
    now = stage(now.select(low, high).distinct(), "edges")
    while _unfinished(now):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("u"), "v").distinct()
        # Small star: v's smaller neighbours u, and v itself, go to the least of them.
        head = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(head, "v")
            .select("m", F.explode(F.array("u", "v")).alias("x"))
            .filter("x <> m")
            .distinct()
        )
        now = stage(small.select(F.col("m").alias("u"), F.col("x").alias("v")), "edges")
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        now.select("u", "u").distinct()
    )


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node has two parents, or a parent has one of its own."""
    ends = F.explode(F.expr("array(struct(u as node, 0 as child, 1 as parent), struct(v as node, 1 as child, 0 as parent))"))
    roles = edges.select(ends.alias("e")).groupBy("e.node").agg(
        F.sum("e.child").alias("children"), F.max("e.parent").alias("parent")
    )
    return roles.filter("children > 1 or children + parent > 1").head() is not None
