"""Connected components of an edge table by alternating large-star and small-star steps; nothing goes to the driver but sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, stored


def _least(edges: DataFrame, of: str, other: str) -> DataFrame:
    """edges with m, the least neighbour of `of` or itself; joined by a form of the key, so that AQE can split a hub."""
    m = edges.groupBy(of).agg(F.least(F.min(other), F.first(of)).alias("m")).select(F.xxhash64(of).alias("_h"), F.col(of).alias("_v"), "m")
    e = edges.withColumn("_h", F.xxhash64(of))
    return e.join(m, (e["_h"] == m["_h"]) & (e[of] == m["_v"])).select(of, other, "m")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the least node reachable. Nodes without edge (or with a null end) are not returned; loops and repeats are harmless."""
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct(), "edges")
    state = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both, "u", "v").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(now.where("u = v")).distinct()
        m = _least(large, "u", "v")
        small = m.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v"))).distinct()
        before, now = now, stored(small, "edges")
        discard(before)
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if got == state:
            break
        state = got
    return now.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()).groupBy("node").agg(F.min("component").alias("component"))
