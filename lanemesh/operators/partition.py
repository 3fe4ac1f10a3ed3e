"""Splitting references at all ends of intervals and saying which interval covers which piece."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import offsets


def breakpoints(intervals: DataFrame, key: str = "reference_id", lengths: DataFrame | None = None, decimals: int | None = None) -> DataFrame:
    """key, at: distinct ends, with 0 and the length of each reference where `lengths` (key, length_km) is given."""
    r = (lambda c: F.round(c, decimals)) if decimals is not None else (lambda c: c)
    at = intervals.select(key, F.explode(F.array(r(F.col("start_dist")), r(F.col("end_dist")))).alias("at")).where("at is not null")
    if lengths is not None:
        at = at.unionByName(lengths.select(key, F.explode(F.array(F.lit(0.0), r(F.col("length_km")))).alias("at")))
    return at.distinct()


def segments(points: DataFrame, key: str = "reference_id") -> DataFrame:
    """key, start_dist, end_dist, segment_index (from 1), total_segments."""
    line = W.partitionBy(key).orderBy("at")
    return (
        points.withColumn("end_dist", F.lead("at").over(line)).withColumn("segment_index", F.row_number().over(line))
        .withColumn("total_segments", F.count(F.lit(1)).over(W.partitionBy(key)) - 1)
        .where("end_dist is not null").withColumnRenamed("at", "start_dist")
    )


def covers(start: Column, end: Column, seg_start: Column, seg_end: Column, compat: bool = True) -> Column:
    """Does an interval cover a piece? compat: its ends are rounded, the piece's aren't, so that one whose start
    is rounded up loses its first piece, and one whose end is rounded up gets the next.
    """
    s, e = (F.round(start, 6), F.round(end, 6)) if compat else (start, end)
    return (s <= seg_start) & (s < seg_end) & (e > seg_start)


def tagged(pieces: DataFrame, intervals: DataFrame, key: str = "reference_id", compat: bool = True) -> DataFrame:
    """Pieces with the intervals that cover them: an equi-join on the reference with a range residual."""
    clash = {"start_dist", "end_dist"}
    tags = intervals.select(F.col(key).alias("tag_key"), F.col("start_dist").alias("tag_start"), F.col("end_dist").alias("tag_end"), *(c for c in intervals.columns if c not in {key, *clash}))
    on = (F.col(key) == F.col("tag_key")) & covers(F.col("tag_start"), F.col("tag_end"), F.col("start_dist"), F.col("end_dist"), compat)
    return pieces.join(tags, on).drop("tag_key", "tag_start", "tag_end")


def with_geometry(pieces: DataFrame, references: DataFrame) -> DataFrame:
    """Adds geometry and node_ids to pieces: vertices in range, and a made-up one where a split has none."""
    refs = references.select("reference_id", "vertices", F.col("geometry").alias("line"))
    df = pieces.join(refs, "reference_id").where("vertices is not null")

    def at(c: str) -> Column:
        have = F.filter("vertices", lambda v: v["poff"] == F.col(c))
        p = offsets.point_along(F.col("line"), F.col(c))
        made = F.array(F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"), F.lit(None).cast("string").alias("node_id")))
        return F.when(F.size(have) == 0, made).otherwise(F.transform(have, lambda v: F.struct(v["lon"].alias("lon"), v["lat"].alias("lat"), v["node_id"].alias("node_id"))))

    inner = F.transform(F.filter("vertices", lambda v: (v["poff"] > F.col("start_dist")) & (v["poff"] < F.col("end_dist"))), lambda v: F.struct(v["lon"].alias("lon"), v["lat"].alias("lat"), v["node_id"].alias("node_id")))
    df = df.withColumn("all", F.concat(at("start_dist"), inner, at("end_dist")))
    return df.withColumn("geometry", F.transform("all", lambda v: F.struct(v["lon"].alias("lon"), v["lat"].alias("lat")))).withColumn("node_ids", F.transform("all", lambda v: v["node_id"])).drop("all", "vertices", "line")


def violations(pieces: DataFrame, references: DataFrame) -> DataFrame:
    """References whose pieces don't join end to end or don't give the reference's nodes back: reference_id, reason."""
    own = pieces.groupBy("reference_id").agg(F.sort_array(F.collect_list(F.struct("segment_index", "start_dist", "end_dist", "node_ids"))).alias("p"))
    joined = own.join(references.select("reference_id", F.col("node_ids").alias("want"), "length_km"), "reference_id")
    gap = F.exists(F.sequence(F.lit(2), F.greatest(F.size("p"), F.lit(2))), lambda i: F.try_element_at("p", i)["start_dist"] != F.element_at("p", (i - 1).cast("int"))["end_dist"])
    nodes = F.filter(F.flatten(F.transform("p", lambda x: x["node_ids"])), lambda n: n.isNotNull())
    from ..functions.scalars import deduped_neighbours

    reason = (
        F.when(F.coalesce(gap, F.lit(False)), "gap between pieces")
        .when((F.element_at("p", 1)["start_dist"] != 0) | (F.element_at("p", -1)["end_dist"] != F.col("length_km")), "ends not covered")
        .when(deduped_neighbours(nodes) != F.col("want"), "nodes differ")
    )
    return joined.select("reference_id", reason.alias("reason")).where("reason is not null")
