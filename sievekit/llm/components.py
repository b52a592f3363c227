"""Connected components of links, by shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def connected_components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) of every node of ``links``
    (u, v: bigint).  Neighbours are pointed at ever smaller ones, in turn from
    above and from below, until nothing changes; every step is an aggregation
    with map-side combining and an equi-join, written to the shared folder."""
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    before, last = None, None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(down.select("e.*").where("u <> v").distinct(), "edges")
        if last is not None:
            discard(last)
        last = edges
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
