"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from featureflow.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return r.n, r.x


def _stars(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low2 = large.groupBy("u").agg(F.min("v").alias("m"))
    return (large.join(low2, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def connected_components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """Rows (node, component) for every node on an edge; component is the smallest node reachable.

    Each round links every node to the smallest neighbour seen from it, so a chain shrinks by
    logarithmic steps and a hot node only meets aggregates and joins that Spark can split.
    Rounds end when the edges no longer change; each round is written to the shared folder.
    Null ends and self links are ignored; no edges give an empty result.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
                     (F.col(a).isNull() | F.col(b).isNull()).alias("nul")).where("not nul and u <> v").drop("nul").distinct()
    e = stored(e, name)
    seen = _signature(e)
    while seen[0]:
        e = stored(_stars(e), name)
        now = _signature(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
