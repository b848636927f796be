"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.shared import settle, spread_join


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on its smallest neighbour."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    hung = spread_join(both, least, ["a"], "b").filter("b > a")
    return hung.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = spread_join(down, least, ["a"], "b").filter("b <> m")
    hung = hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.withColumnRenamed("m", "b"))


def smallest_reachable(edges: DataFrame, most: int = 60) -> DataFrame:
    """``node`` and ``root``, its smallest reachable node, for nodes that have edges.

    ``edges`` has two columns of one comparable type, ``a`` and ``b``; direction,
    repeats, loops and NULL ends don't matter. Roots themselves are not listed.
    """
    edges = settle(edges.filter("a <> b").distinct())
    for _ in range(most):
        if edges.isEmpty():
            break
        edges = settle(_small_star(_large_star(edges)).filter("a <> b").distinct())
        ends = edges.selectExpr("a AS node", "1 AS hung", "0 AS root")
        ends = ends.unionByName(edges.selectExpr("b AS node", "0 AS hung", "1 AS root"))
        ends = ends.groupBy("node").agg(F.sum("hung").alias("hung"), F.max("root").alias("root"))
        if ends.filter("hung > 1 OR hung = 1 AND root = 1").isEmpty():  # stars only
            break
    else:
        raise RuntimeError(f"no stable components after {most} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
