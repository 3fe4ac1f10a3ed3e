"""Distributed connected components by alternating large and small stars.

Defined cases: edges with a null end and loops are ignored; repeated edges count once; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, materialized, spread_join


def _with_min(edges: DataFrame, key: str, other: str, rows: int) -> DataFrame:
    """edges with `m`, the least `other` of their key. A hub's edges are spread over the tasks."""
    least = edges.groupBy(key).agg(F.min(other).alias("m"), F.count(F.lit(1)).alias("copies")).withColumnRenamed(key, "k")
    return spread_join(edges, least, {key: "k"}, "m", "copies", rows, F.col(other)).select(key, other, "m")


def components(edges: DataFrame, label: str = "components", most_rounds: int = 60) -> DataFrame:
    """edges: a, b (long). Returns node, component (the least node reachable) for all nodes of edges.

    Every round ends in a written table, so a lost executor costs one round. Rounds end when the
    edges are stars around the least nodes, which is when their number and sums no longer change.
    """
    e = edges.where("a is not null and b is not null").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e, before = materialized(e, label), None
    rows = 2 * e.count()
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_min(both, "u", "v", rows).select("v", F.least("m", "u").alias("m"), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialized(large, label)
        small = _with_min(large, "u", "v", rows)
        step = materialized(small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), label)
        dropped(e, large)
        e = step
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, rows = now, 2 * now[0]
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
