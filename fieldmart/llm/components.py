"""Connected components of a table of links by alternating large and small stars, one stored table for each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Joins every node's neighbours (the larger ones, or the others and itself) to the least of all."""
    if large:
        edges = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = edges.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of any orderable type -> node, root (the least node it is linked to, itself included).

    Nodes without links don't appear. The rounds end when the edges stay as they are, which takes about the logarithm of the
    longest chain.
    """
    edges, mark = links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u != v"), None
    while True:
        edges = stored(_stars(_stars(edges, True), False), "stars")
        row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
