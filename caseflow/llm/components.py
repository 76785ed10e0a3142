"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is nobody's larger end."""
    if not edges.groupBy("a").agg(F.count("*").alias("c")).where("c > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (the component's smallest node) of every node of ``edges (a long, b long)``.

    Each round hangs every node's larger neighbours, then its smaller ones, on its smallest neighbour; it ends when the
    edges are stars, and every round is written to the shared folder. Minima are combined before the shuffle and the joins
    are plain equalities on the node, which Spark splits where a node has very many edges. Loops and repeated edges are
    allowed; an empty table gives no rows.
    """
    cur = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    cur = cut(cur, "edges")
    for _ in range(max_rounds):
        if _is_star_forest(cur):
            break
        # Large star: the neighbours above a node go to the smallest of the node and its neighbours.
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # Small star: a node and its neighbours below go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        cur = cut(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
