"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are tied to the least of them and itself.

    The least is a map-side aggregate; the join that follows has two plain
    exchanges, so Spark can split a node with very many neighbours.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").cast("string").alias("k"), F.least("u", "m").alias("m"))
    met = both.withColumn("k", F.col("u").cast("string")).join(least, "k")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(met.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links of long ids to (node, component): the least id that a node reaches."""
    edges, last = X.stored(edges.select("u", "v").where("u <> v").distinct(), "edges", narrow=True), None
    while True:
        was, edges = edges, X.stored(_stars(_stars(edges, True), False), "edges", narrow=True)
        X.discard(was)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
