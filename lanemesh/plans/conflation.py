"""Conflation: intervals of all maps along each reference, cut up, tagged, levelled and numbered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SPLIT_BUFFER_KM
from ..functions import geodesy as geo
from ..functions import scalars as s
from ..operators import grouping, numbering, offsets, overlaps, partition

#: Priority among intervals of one map: the order of the match key, or primary before rank before length.
PRIORITY = {"compat": ["from_node", "to_node", "target_map_id"], "rank": ["not_primary", "rank", "minus_length", "target_map_id"]}


def target_intervals(references: DataFrame, matches: DataFrame, priority: str = "compat", threshold: float = SPLIT_BUFFER_KM) -> DataFrame:
    df = offsets.match_intervals(references, matches)
    df = df.withColumn("not_primary", ~F.coalesce("is_primary", F.lit(True))).withColumn("minus_length", F.col("start_dist") - F.col("end_dist"))
    keep = df.select(
        "reference_id", "from_node", "to_node", "target_map", "target_map_id", "matched_id", "is_primary", "rank", "meso_id", "mega_id", "matched_micro_idx",
        "matched_meso_idx", "matched_meso_bearing", "matched_mega_direction", "matched_micro_id", "not_primary", "minus_length", "start_dist", "end_dist")
    return overlaps.resolve(keep, PRIORITY[priority], threshold)


def conflated(references: DataFrame, matches: DataFrame, priority: str = "compat", compat: bool = True) -> tuple[DataFrame, DataFrame]:
    """(segments, tags). Segments: one row a piece, numbered from 1 by network level and place. Tags: which
    target-map feature covers a piece, with the piece's index within that feature. compat: see partition.covers.
    """
    own = target_intervals(references, matches, priority)
    roads = offsets.osm_intervals(references)
    ends = own.select("reference_id", "start_dist", "end_dist").unionByName(roads.select("reference_id", "start_dist", "end_dist"))
    usable = references.where("vertices is not null")
    points = partition.breakpoints(ends.join(usable.select("reference_id"), "reference_id", "left_semi"), lengths=usable)
    pieces = partition.with_geometry(partition.segments(points), usable)
    base = usable.select("reference_id", "geometry_id", "reversed", "direction", F.col("from_node").alias("from_intersection"), F.col("to_node").alias("to_intersection"))
    pieces = pieces.join(base, "reference_id")

    road = partition.tagged(pieces.select("reference_id", "segment_index", "start_dist", "end_dist"), roads.select("reference_id", "start_dist", "end_dist", "target_map_id", "matched_id", "rank", "one_way", "ordinal"), compat=compat)
    road = road.groupBy("reference_id", "segment_index").agg(F.max_by(F.struct("target_map_id", "matched_id", "rank", "one_way"), "ordinal").alias("osm"))
    pieces = pieces.join(road, ["reference_id", "segment_index"], "left")
    pieces = pieces.withColumn("network_level", s.network_level(F.col("osm.rank"), F.col("osm.one_way"))).withColumn("geoprox_key", geo.geoprox_key(F.col("geometry")))
    order = ["network_level", "geoprox_key", "reference_id", "segment_index"]
    segments = numbering.number_globally(pieces, order, "id")

    tags = partition.tagged(segments.select("id", "reference_id", "segment_index", "start_dist", "end_dist"), own.drop("not_primary", "minus_length", "from_node", "to_node").withColumn("tag_from", F.col("start_dist")), compat=compat)
    # As ends are rounded, an interval can reach into the next piece; of several of a map the last one counts.
    tags = grouping.first_of(tags, ["id", "target_map"], [F.col("tag_from").desc(), F.col("target_map_id").desc()]).drop("tag_from")
    tags = tags.withColumn("map_id", F.coalesce("matched_micro_id", "matched_id"))
    tags = numbering.index_within(tags, ["target_map", "map_id"], ["matched_meso_idx", "matched_micro_idx", "segment_index", "id"], "map_idx")
    return segments, tags
