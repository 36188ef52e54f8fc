"""Connected components of a link table, all in Spark: large-star and small-star steps until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours (the larger ones, or the smaller ones) of each node onto its smallest neighbour."""
    if large:
        around = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = around.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m").toDF("a", "b"))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, label`` of every node with a link; the label is the smallest node reachable."""
    edges = scratch.store(edges.toDF("a", "b").filter("a <> b"), f"{name}-0")
    before, turn = None, 0
    while True:
        turn += 1
        edges = scratch.store(_star(_star(edges, large=True), large=False), f"{name}-{turn}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "node").union(
        edges.select("b", "b").distinct().toDF("node", "label")
    )
