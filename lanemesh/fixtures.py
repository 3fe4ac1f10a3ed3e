"""Road-like tables made from the general test tables, so that operators can be run and checked on them.

F1 points from customers, F2 lines from embeddings, F3 match intervals and F5 ways from line items, F4
edges from events, F6 restrictions from orders, F7 groups from parts, F8 a lookup from nations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .functions import geodesy as geo


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _at(key: str) -> Column:
    return geo.point(F.expr(f"-79 + ({key} * 7919 % 700000) / 100000D"), F.expr(f"40.5D + ({key} * 104729 % 450000) / 100000D"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """c_custkey, a, b."""
    return table(spark, sf_dir, "customer").select("c_custkey", _at("c_custkey").alias("a"), _at("(c_custkey + 1)").alias("b"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, flat, line of 32 points."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    flat = F.transform("e", lambda x, i: F.when(i % 2 == 0, -74 + 0.1 * x).otherwise(42.6 + 0.1 * x))
    return e.select("vec_id", flat.alias("flat")).withColumn("line", geo.from_lonlats(F.col("flat")))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """intervals along references."""
    start = F.expr("(l_partkey % 40) / 100D")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("reference_id"), F.col("l_returnflag").alias("target_map"), F.col("l_partkey").alias("target_map_id"), "l_linenumber", "l_suppkey",
        start.alias("start_dist"), (start + F.col("l_quantity") / 100).alias("end_dist"))


def event_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """per user the edges from each event to the next, by time."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.lag("event_id").over(w).alias("before"), F.row_number().over(w).alias("ordinal"))
    return e.where("before is not null").select(F.col("user_id").alias("grp"), F.col("event_id").cast("string").alias("edge_id"), F.col("before").cast("string").alias("from_node"), F.col("event_id").cast("string").alias("to_node"), "ordinal")


def way_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """way, node, pos (from 0)."""
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("way"), F.col("l_partkey").alias("node"), (F.row_number().over(w) - 1).alias("pos"))


def raw_restrictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, f, v, t."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("f"), (F.col("o_custkey") % 2000).alias("v"), (F.col("o_orderkey") + 1).alias("t"))
