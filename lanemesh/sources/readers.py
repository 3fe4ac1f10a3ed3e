"""Readers. All take explicit schemas; paths may be in any store that Spark reads."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants, schemas
from ..functions import geodesy as geo
from ..functions import scalars


def feature_lines(spark: SparkSession, path: str, fields: tuple[str, ...], parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(features, rejects) of newline-delimited GeoJSON, gzipped or not.

    Features have one column a property (text), `geometry` as a line and `source_file`. Rejects are lines
    that aren't JSON and features without a line of two points. Gzip can't be split, so `parts` deals rows out.
    """
    raw = spark.read.schema(schemas.feature_schema(fields)).option("columnNameOfCorruptRecord", "_corrupt").option("pathGlobFilter", "*.ndjson*").option("recursiveFileLookup", "true").json(path)
    raw = raw.withColumn("source_file", F.col("_metadata.file_name"))
    if parts:
        raw = raw.repartition(parts)
    line = F.transform("geometry.coordinates", lambda p: geo.point(p[0], p[1]))
    df = raw.withColumn("line", line)
    good = F.col("_corrupt").isNull() & F.coalesce(F.size("line") >= 2, F.lit(False))
    features = df.where(good).select(*(F.col(f"properties.`{f}`").alias(f) for f in fields), F.col("line").alias("geometry"), "source_file")
    rejects = df.where(~good).select("source_file", F.col("_corrupt").alias("line"), F.when(F.col("_corrupt").isNotNull(), "not JSON").otherwise("no line").alias("reason"))
    return features, rejects


def map_name(source_file: Column, prefix: str) -> Column:
    """`npmrds_2019` from `npmrds.2019.ndjson.gz`; null for other names."""
    year = F.regexp_extract(source_file, rf"^{prefix}\.(\d{{4}})\.ndjson(\.gz)?$", 1)
    return F.when(year != "", F.concat(F.lit(f"{prefix}_"), year))


def lower_keys(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.lower() for c in df.columns))


def header_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all text, trimmed, names in lower case."""
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).option("nullValue", "\0").csv(path)
    return lower_keys(raw)


def feature_collection(spark: SparkSession, path: str, feature: str) -> DataFrame:
    """Features of whole GeoJSON FeatureCollection files, a row each."""
    return spark.read.schema(f"type string, features array<struct<{feature}>>").option("multiLine", True).json(path).select(F.explode("features").alias("f")).select("f.*")


def area(spark: SparkSession, path: str) -> list[list[list[tuple[float, float]]]]:
    """Parts, each a list of rings without their closing point, of one GeoJSON Polygon or MultiPolygon, or a Feature of it."""
    found = json.loads(spark.read.option("wholetext", True).text(path).first()[0])
    found = found.get("geometry", found)
    if found["type"] not in ("Polygon", "MultiPolygon"):
        raise ValueError(f"not an area: {found['type']}")
    parts = [found["coordinates"]] if found["type"] == "Polygon" else found["coordinates"]
    return [[[(p[0], p[1]) for p in (ring[:-1] if ring[0] == ring[-1] else ring)] for ring in part] for part in parts]


def county_lookup(spark: SparkSession) -> DataFrame:
    """county, county_code, region_code: 62 rows, so safe to broadcast."""
    return spark.createDataFrame(constants.counties(), "county string, county_code string, region_code string")


def osm_elements(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, ways, restrictions) of OSM XML."""

    def scan(tag: str, schema: str) -> DataFrame:
        return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)

    def last_wins(c: str, key: str, value: str) -> Column:
        # The last of several equal keys: drop those that come up again later.
        arr = F.col(c)
        keep = F.filter(arr, lambda t, i: ~F.exists(F.slice(arr, i + 2, F.size(arr)), lambda u: u[key] == t[key]))
        entries = F.map_from_entries(F.transform(keep, lambda t: F.struct(t[key].alias("key"), t[value].cast("string").alias("value"))))
        return F.when(arr.isNotNull(), entries).otherwise(F.create_map().cast("map<string,string>"))

    nodes = scan("node", schemas.OSM_NODE).select(F.col("_id").alias("id"), F.col("_lon").alias("lon"), F.col("_lat").alias("lat"), last_wins("tag", "_k", "_v").alias("tags"))
    ways = scan("way", schemas.OSM_WAY).select(F.col("_id").alias("id"), F.transform("nd", lambda n: n["_ref"]).alias("nodes"), last_wins("tag", "_k", "_v").alias("tags"))
    relations = scan("relation", schemas.OSM_RELATION).select(F.col("_id").alias("id"), last_wins("member", "_role", "_ref").alias("members"), last_wins("tag", "_k", "_v").alias("tags"))
    restrictions = relations.where(F.col("tags")["type"] == "restriction").select("id", F.col("members"), F.col("tags")["restriction"].alias("restriction"))
    return nodes, ways, restrictions


def tiles(spark: SparkSession, path: str, kind: str, loaded: DataFrame | None = None) -> DataFrame:
    """Decoded base-network tiles of one kind (`geometry`, `metadata` or `reference`) as JSON lines, named `<tile id>.<kind>.<level>.json`.

    loaded: a ledger (tile_id) of tiles that were loaded before and are skipped.
    """
    schema = {"geometry": schemas.GEOMETRY_TILE, "metadata": schemas.METADATA_TILE, "reference": schemas.REFERENCE_TILE}[kind]
    raw = spark.read.schema(schema).option("pathGlobFilter", f"*.{kind}.*").option("recursiveFileLookup", "true").json(path)
    tile_id, _ = scalars.tile_parts(F.col("_metadata.file_name"))
    raw = raw.withColumn("tile_id", tile_id)
    return raw if loaded is None else raw.join(loaded.select("tile_id").distinct(), "tile_id", "left_anti")


def missing_tiles(lines: DataFrame, have: DataFrame, zoom: int = 12) -> DataFrame:
    """tile_id of tiles that lines pass through and that `have` (tile_id) lacks."""
    seen = lines.select(F.explode(geo.tiles_of(F.col("geometry"), zoom)).alias("tile_id")).distinct()
    return seen.join(have.select("tile_id").distinct(), "tile_id", "left_anti")


def sibling_tiles(names: DataFrame, kind: str, have: DataFrame) -> DataFrame:
    """name of files of another kind that go with the geometry tiles in `names` and aren't in `have` (name)."""
    wanted = names.select(F.regexp_replace("name", r"\.geometry\.", f".{kind}.").alias("name")).distinct()
    return wanted.join(have.select("name").distinct(), "name", "left_anti")


def node_dump(spark: SparkSession, path: str) -> DataFrame:
    """id, lon, lat, tags of a dump with fields split by pipes, the last one JSON."""
    parts = F.split("value", r"\|", 4)
    return spark.read.text(path).select(
        parts[0].try_cast("long").alias("id"), parts[1].try_cast("double").alias("lon"), parts[2].try_cast("double").alias("lat"), F.from_json(parts[3], "map<string,string>").alias("tags"))


def traffic_signals(nodes: DataFrame) -> DataFrame:
    """Nodes with a tag that speaks of signals."""
    text = F.to_json("tags")
    return nodes.where(text.contains("signal") & ~text.contains("null"))
