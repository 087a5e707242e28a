"""Connected components by alternating large-star and small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spool


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to the least of its neighbourhood.
    The minimum is pre-aggregated before the shuffle; a hub's edges are split by AQE's skew join."""
    flipped = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    least = flipped.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = flipped.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def connected_components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """node, root for every node of ``edges`` (u, v); root is the least node of its component.
    Null ends and loops are left out. Each round is written to the shared folder."""
    edges = spool(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    mark = None
    for _ in range(limit):
        edges = spool(_star(_star(edges, True), False), "components")
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.expr("xxhash64(u, v) >> 20"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components didn't settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
