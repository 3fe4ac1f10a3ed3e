"""Writers: NDJSON, GeoJSON, CSV reports and OSM XML, all by Spark's own sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import xml_safe

# What the head of an OSM export says of its elements.
STAMP = 'version="-1" timestamp="1969-12-31T23:59:59Z" changeset="-1"'


def geometry_json(line: Column) -> Column:
    return F.struct(F.lit("LineString").alias("type"), F.transform(line, lambda p: F.array(p["lon"], p["lat"])).alias("coordinates"))


def multiline_json(lines: Column) -> Column:
    return F.struct(F.lit("MultiLineString").alias("type"), F.transform(lines, lambda line: F.transform(line, lambda p: F.array(p["lon"], p["lat"]))).alias("coordinates"))


def polygon_json(rings: Column) -> Column:
    """Rings are closed by their first points."""
    closed = lambda ring: F.concat(ring, F.slice(ring, 1, 1))
    return F.struct(F.lit("Polygon").alias("type"), F.transform(rings, lambda ring: F.transform(closed(ring), lambda p: F.array(p["lon"], p["lat"]))).alias("coordinates"))


def feature_json(properties: list[str | Column], geometry: Column, ident: Column | None = None) -> Column:
    """A GeoJSON feature as text; null properties are left out."""
    fields = [F.lit("Feature").alias("type"), *([ident.alias("id")] if ident is not None else []), F.struct(*properties).alias("properties"), geometry.alias("geometry")]
    return F.to_json(F.struct(*fields))


def write_lines(df: DataFrame, path: str, column: str = "value", gzip: bool = True) -> None:
    df.select(F.col(column).alias("value")).write.option("compression", "gzip" if gzip else "none").text(path)


def feature_collection(features: DataFrame, column: str = "value") -> DataFrame:
    """One row, the FeatureCollection of some features as text (none for no features); for exports that fit in a file."""
    return features.agg(F.array_join(F.sort_array(F.collect_list(column)), ",").alias("f")).where("f <> ''").select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")).alias("value"))


def write_report(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def xml_node() -> Column:
    return F.format_string(f'  <node id="%d" {STAMP} lat="%s" lon="%s"/>', F.col("id"), F.col("lat").cast("string"), F.col("lon").cast("string"))


def xml_relation() -> Column:
    member = lambda kind, role: F.format_string(f'    <member type="{kind}" ref="%s" role="{role}"/>', F.col("members")[role].cast("string"))
    tag = F.format_string('    <tag k="restriction" v="%s"/>', F.col("restriction"))
    return F.concat_ws("\n", F.format_string(f'  <relation id="%d" {STAMP}>', F.col("id")), member("node", "via"), member("way", "to"), member("way", "from"), F.lit('    <tag k="type" v="restriction"/>'), tag, F.lit("  </relation>"))


def xml_way() -> Column:
    nodes = F.array_join(F.transform("nodes", lambda n: F.format_string('    <nd ref="%s"/>', n.cast("string"))), "\n")
    tags = F.array_join(F.transform(F.array_sort(F.map_entries("tags")), lambda t: F.format_string('    <tag k="%s" v="%s"/>', t["key"], xml_safe(t["value"]))), "\n")
    return F.concat_ws("\n", F.format_string(f'  <way id="%d" {STAMP}>', F.col("id")), F.nullif(nodes, F.lit("")), F.nullif(tags, F.lit("")), F.lit("  </way>"))


def osm_document(nodes: DataFrame, restrictions: DataFrame, ways: DataFrame, bounds: tuple[float, float, float, float] | None = None) -> DataFrame:
    """part, id, value: the pieces of an OSM XML file; ordered by part and id they are the file."""
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<osm version="0.6" generator="lanemesh">'
    if bounds:
        head += '\n  <bounds minlon="{}" minlat="{}" maxlon="{}" maxlat="{}"/>'.format(*bounds)
    spark = nodes.sparkSession
    ends = spark.createDataFrame([(0, 0, head), (4, 0, "</osm>")], "part int, id long, value string")
    piece = lambda df, part, c: df.select(F.lit(part).alias("part"), F.col("id").cast("long").alias("id"), c.alias("value"))
    return ends.unionByName(piece(nodes, 1, xml_node())).unionByName(piece(restrictions, 2, xml_relation())).unionByName(piece(ways, 3, xml_way()))


def write_osm(document: DataFrame, path: str) -> None:
    """Text files that make up the document in the order of their names (a range sort)."""
    document.orderBy("part", "id").select("value").write.text(path)
