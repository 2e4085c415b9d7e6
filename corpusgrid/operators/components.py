"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgrid.session import materialise

MAX_ROUNDS = 60  # far above the logarithm of any table's rows


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes in ``links (a, b)``; a component is named by its least node.

    Links are re-hung by turns, first all larger neighbours of a node on the least one
    around it, then the smaller ones, which halves long chains. Each step is a partial
    minimum and a join and is written to the shared folder; a round ends the loop when it
    changes no link. Links of a node to itself are allowed, and keep a lone node.
    """
    nodes = materialise(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "component-nodes")
    down = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(MAX_ROUNDS):
        hung = materialise(_hang_larger(down), "links")
        hung = materialise(_hang_smaller(hung), "links")
        if hung.exceptAll(down).isEmpty() and down.exceptAll(hung).isEmpty():
            return nodes.join(hung.select(F.col("a").alias("node"), "b"), "node", "left").select(
                "node", F.coalesce("b", "node").alias("component"))
        down = hung
    raise RuntimeError("the links did not settle")


def _hang_larger(down: DataFrame) -> DataFrame:
    """Every neighbour above a node hangs on the least of the node and its neighbours."""
    both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = down.groupBy("a").agg(F.min("b").alias("least"))  # nodes without a smaller neighbour are their own
    above = both.filter("b > a").join(least, "a", "left")
    return above.select(F.col("b").alias("a"), F.coalesce("least", "a").alias("b")).distinct()


def _hang_smaller(down: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the least of these."""
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
