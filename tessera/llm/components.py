"""Connected components of an edge table, without bringing it to one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import discard, written


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Of edges (u, v) long: a written table (node, component), the smallest node reachable from each.

    Alternating stars: every node's larger neighbours, then its smaller ones, are tied to the smallest
    neighbour, until nothing changes; rounds grow with the logarithm of the longest path. Minima are combined before
    the shuffle, and a hub's rows are split by adaptive skew joins. Each round is written, the one before removed.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = written(e, "links")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        new = small.where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        new = written(new, "links")
        discard(e)
        e = new
        now = _mark(e)
        if now == mark:
            break
        mark = now
    out = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    out = written(out, "components")
    discard(e)
    return out
