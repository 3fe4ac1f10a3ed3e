"""Directed references from base-network tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geodesy as geo
from ..functions import scalars as s
from ..operators import grouping, offsets


def geometry_metadata(geometries: DataFrame, metadata: DataFrame) -> DataFrame:
    g = grouping.first_of(geometries, ["id"], ["id"]).withColumnRenamed("id", "geometry_id")
    m = grouping.first_of(metadata, ["geometryId"], ["geometryId"]).withColumnRenamed("geometryId", "geometry_id")
    return g.join(m.select("geometry_id", "osmMetadata"), "geometry_id")


def reference_candidates(geometries: DataFrame, metadata: DataFrame, references: DataFrame) -> DataFrame:
    """A directed candidate for every reference and geometry: back references are turned round, sections and nodes included.

    A geometry without a forward reference makes back references.
    """
    gm = geometry_metadata(geometries, metadata).withColumn("line", geo.from_lonlats(F.col("lonlats")))
    r = references.select(F.col("id").alias("reference_id"), F.col("geometryId").alias("geometry_id"))
    df = r.join(gm, "geometry_id").withColumn("reversed", ~F.coalesce(F.col("reference_id") == F.col("forwardReferenceId"), F.lit(False)))
    sections = F.col("osmMetadata.waySections")
    turned = F.transform(F.reverse(sections), lambda w: w.withField("nodeIds", F.reverse(w["nodeIds"])))
    pick = lambda back, ahead: F.when(F.col("reversed"), back).otherwise(ahead)
    return df.select(
        "reference_id", "geometry_id", "reversed",
        pick(F.col("toIntersectionId"), F.col("fromIntersectionId")).alias("from_node"), pick(F.col("fromIntersectionId"), F.col("toIntersectionId")).alias("to_node"),
        pick(geo.reversed_line(F.col("line")), F.col("line")).alias("geometry"), pick(turned, sections).alias("way_sections"), F.col("osmMetadata.name").alias("name"),
    ).where(F.size("geometry") >= 2)


def reference_features(geometries: DataFrame, metadata: DataFrame, references: DataFrame, area: list[list[list[tuple[float, float]]]] | None = None, compat: bool = True) -> DataFrame:
    """One reference a row, of several candidates the chosen one, with direction, nodes, length and vertices.

    area: parts of rings (lon, lat), as `readers.area` gives them; references not within one of the parts are left out.
    """
    df = reference_candidates(geometries, metadata, references)
    if area:
        df = df.where(geo.within_area(F.col("geometry"), area))
    df = df.withColumn("n_vertices", F.size("geometry"))
    fields = [c for c in df.columns if c not in ("reference_id", "n_vertices")]
    chosen = grouping.selected_candidates(df.select("reference_id", "geometry_id", "reversed", "n_vertices", F.struct(*fields).alias("candidate")), "reference_id", "geometry_id")
    bearing = geo.final_bearing(geo.first(F.col("geometry")), geo.last(F.col("geometry")))
    return offsets.with_vertices(chosen.withColumn("direction", s.micro_direction(bearing, compat)))
