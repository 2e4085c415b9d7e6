"""Connected components of links by alternating stars, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgrid.session import materialise

MAX_ROUNDS = 60


def fingerprint(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs the larger (else: the smaller and the node itself) neighbours of each node on its least one."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        hung = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return hung.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``links (u, v)``: the least node of its component.

    Minima are aggregated before the shuffle, and the written edges join as plain
    exchanges, so the centre of a large star is split and never gathered.
    """
    edges = materialise(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "links")
    before = fingerprint(edges)
    for _ in range(MAX_ROUNDS):
        edges = materialise(star(edges, True), "large-star")
        edges = materialise(star(edges, False), "small-star")
        now = fingerprint(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    centres = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(centres)
