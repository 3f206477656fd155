"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import Stage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(stage: Stage, edges: DataFrame, name: str = "cc") -> DataFrame:
    """``edges`` (a long, b long) -> (node, component): the smallest node reachable, for every node with an edge.

    Every round replaces a node's neighbours by links to its smallest one; rounds stop when the links no longer
    change, and all are then stars around the smallest node. Each round is written to the shared folder, so a lost
    executor costs one round. Minima are combined before the shuffle, so a hub is no hot key there; links of a hub
    join a written table of minima, which adaptive execution can split. NULL ends and loops are ignored; an empty
    table gives an empty result.
    """
    links = stage.put(f"{name}-0", edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    mark, step, old = _mark(links), 0, f"{name}-0"
    while mark[0]:
        # large star: the larger neighbours of a node link to the smallest of its neighbours and itself
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stage.put(f"{name}-low{step}", both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = stage.put(f"{name}-large{step}", large)
        # small star: the smaller neighbours of a node and the node itself link to the smallest of them
        low2 = stage.put(f"{name}-low2{step}", large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low2, "a").select(F.explode(F.array(F.col("b"), F.col("a"))).alias("a"), F.col("m").alias("b"))
        new = stage.put(f"{name}-{step + 1}", small.where("a <> b").distinct())
        stage.drop(old, f"{name}-low{step}", f"{name}-large{step}", f"{name}-low2{step}")
        links, old, before = new, f"{name}-{step + 1}", mark
        mark, step = _mark(links), step + 1
        if mark == before:
            break
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
