"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of the edges (a, b: long) and the smallest node it is connected with.

    Each round points nodes to the smallest neighbour of their neighbours (large star) and of
    themselves (small star), so distances shrink geometrically; only edges are shuffled, and each round
    is written to the shared folder.  Loops and repeated edges are fine; no edges give no rows.
    """
    flat = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    flat, before = stash(flat), None
    while True:
        both = flat.unionByName(flat.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        flat = stash(small)
        state = flat.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    roots = flat.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return flat.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
