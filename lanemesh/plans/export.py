"""What leaves the system: the NDJSON of the conflation map, and its parts for other tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import grouping, hull
from ..sources import writers
from . import matching, quality


def flat_map(segments: DataFrame, tags: DataFrame, maps: list[str]) -> DataFrame:
    """id, split_seg, networklevel, dir, geometry and for each map its id and index."""
    stem = s.id_stem(F.col("map_id"))
    wide = tags.groupBy("id").pivot("target_map", maps).agg(F.max_by(F.struct(stem.alias("mid"), F.col("map_idx").alias("idx")), F.struct("target_map_id", "map_idx")))
    ris = grouping.modal(tags.where(F.col("target_map").startswith("ris")), ["id"], "matched_mega_direction", "mega_dir")
    df = segments.join(wide, "id", "left").join(ris, "id", "left")
    return df.select(
        "id", s.split_label(F.col("segment_index"), F.col("total_segments")).alias("split_seg"), F.col("network_level").alias("networklevel"),
        *(c for m in maps for c in (F.col(f"`{m}`.mid").alias(f"{s.map_label(m)}id"), F.col(f"`{m}`.idx").alias(f"{s.map_label(m)}idx"))),
        F.coalesce("mega_dir", "direction").alias("dir"), "geometry",
    )


def feature_rows(flat: DataFrame) -> DataFrame:
    """value: a GeoJSON feature a row."""
    properties: list[str | Column] = [c for c in flat.columns if c != "geometry"]
    return flat.select(writers.feature_json(properties, writers.geometry_json(F.col("geometry")), F.col("id")).alias("value"))


def unmatched_rows(targets: DataFrame, matches: DataFrame) -> DataFrame:
    """value: a feature for each target without a match."""
    keys = ["target_map", "target_map_id"]
    left = targets.join(matches.select(*keys).distinct(), keys, "left_anti")
    return left.select(writers.feature_json(keys, writers.geometry_json(F.col("geometry")), F.col("target_map_id")).alias("value"))


def multiline_rows(targets: DataFrame, matches: DataFrame) -> DataFrame:
    """value: a feature for each matched target, its own line and those of its matches."""
    df = matching.as_multilines(targets, matches)
    return df.select(writers.feature_json(["target_map", "target_map_id"], writers.multiline_json(F.col("lines")), F.col("target_map_id")).alias("value"))


def polygon_rows(targets: DataFrame, matches: DataFrame) -> DataFrame:
    """value: a feature for each matched target with a concave hull of its points and its matches' points."""
    keys = ["target_map", "target_map_id"]
    df = matching.as_multilines(targets, matches).select(*keys, F.flatten("lines").alias("points"))
    return hull.hulls(df, keys).select(writers.feature_json(keys, writers.polygon_json(F.col("rings")), F.col("target_map_id")).alias("value"))


def release(flat: DataFrame, by_feature: DataFrame, path: str) -> None:
    """A folder of what a release holds: the map's lines, its network levels' lines, and the quality reports."""
    writers.write_lines(feature_rows(flat), f"{path}/conflation_map")
    feature = writers.feature_json([c for c in flat.columns if c != "geometry"], writers.geometry_json(F.col("geometry")), F.col("id"))
    flat.select("networklevel", feature.alias("value")).write.partitionBy("networklevel").option("compression", "gzip").text(f"{path}/by_network_level")
    writers.write_report(by_feature, f"{path}/lengths_by_feature")
    writers.write_report(quality.lengths_summary(by_feature), f"{path}/lengths_summary")


def for_shapefile(flat: DataFrame) -> DataFrame:
    """Names of at most ten characters."""
    return flat.withColumnRenamed("networklevel", "networklev")


def at_zoom(flat: DataFrame, zoom: int) -> DataFrame:
    return flat.where(s.shown_at_zoom(F.col("networklevel"), F.lit(zoom)))
