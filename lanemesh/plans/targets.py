"""Loading target maps: normalised identifiers, ranks and bearings, then the order within meso groups."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import geodesy as geo
from ..functions import scalars as s
from ..operators import grouping
from ..sources import readers


@dataclass(frozen=True)
class TargetMapSpec:
    """What differs between target maps: fields, county column, derived columns, and how meso groups are ordered."""

    prefix: str
    fields: tuple[str, ...]
    county: str
    columns: Callable[[], dict[str, Column]]
    usable: Callable[[], Column]
    order: Callable[[], Column]
    needs: tuple[str, ...]
    directed: bool


def _npmrds_columns() -> dict[str, Column]:
    c = F.col
    return {
        "target_map_id": c("tmc"),
        "meso_id": s.npmrds_meso_id(c("tmc"), c("tmclinear"), c("lineartmc"), c("county_code")),
        "macro_id": s.npmrds_macro_id(c("county_region"), c("roadnumber")),
        "mega_id": s.npmrds_mega_id(c("roadnumber")),
        "is_primary": s.npmrds_is_primary(c("isprimary")),
        "rank": s.npmrds_rank(c("f_system")),
        "region_code": c("county_region"),
        "direction": s.npmrds_direction(c("direction")),
        **{n: s.num_or_null(c(n)) for n in schemas.NPMRDS_NUMBERS if n not in ("f_system", "isprimary")},
    }


def _ris_columns() -> dict[str, Column]:
    c = F.col
    return {
        "target_map_id": (s.num_or_null(c("objectid")) - 1).cast("long").cast("string"),
        "meso_id": F.concat(c("county_code"), F.lit("|"), c("gis_id")),
        "macro_id": c("gis_id"),
        "mega_id": c("dot_id"),
        "is_primary": s.ris_is_primary(c("overlap_hi")),
        "rank": s.ris_rank(c("functional")),
        "region_code": s.pad_left(c("region"), 2),
        "direction": s.ris_direction(c("direction")),
        "beg_mp": s.num_or_null(c("beg_mp")),
    }


NPMRDS = TargetMapSpec(
    "npmrds", tuple(dict.fromkeys((*schemas.NPMRDS_TEXT, *schemas.NPMRDS_NUMBERS))), "county", _npmrds_columns,
    lambda: ~(s.is_something(F.col("tmclinear")) & s.is_something(F.col("lineartmc")) & ~F.col("lineartmc").endswith(F.col("tmclinear"))),
    lambda: F.lit(0), ("direction", "road_order"), True,
)
RIS = TargetMapSpec(
    "ris", schemas.RIS_TEXT, "county_nam", _ris_columns,
    lambda: s.is_something(F.col("dot_id")) & s.is_something(F.col("gis_id")) & s.is_something(F.col("fips_co")) & s.num_or_null(F.col("beg_mp")).isNotNull() & s.num_or_null(F.col("objectid")).isNotNull(),
    lambda: F.when(F.col("direction") == 1, F.col("beg_mp")).otherwise(-F.col("beg_mp")), ("direction", "beg_mp"), False,
)


def enriched(features: DataFrame, spec: TargetMapSpec, target_map: Column, only_county: str | None = None) -> DataFrame:
    """Features with the columns of schemas.TARGET_FEATURE. Rows of unknown counties or without what ids need are left out."""
    counties = readers.county_lookup(features.sparkSession).withColumnsRenamed({"county": "__county", "region_code": "county_region"})
    df = features.where(spec.usable()).withColumn("__name", s.county_name(F.col(spec.county)))
    df = df.join(F.broadcast(counties), F.col("__name") == F.col("__county")).drop("__county", "__name")
    if only_county:
        df = df.where(F.col("county_code") == only_county)
    made = spec.columns()
    df = df.select(*(c for c in df.columns if c not in made), *(v.alias(k) for k, v in made.items()))
    df = df.withColumn("target_map", target_map).withColumn("micro_bearing", geo.line_bearing(F.col("geometry"))).withColumn("geoprox_key", geo.geoprox_key(F.col("geometry")))
    return grouping.first_of(df, ["target_map", "target_map_id"], ["geoprox_key", F.xxhash64(F.to_json("geometry"))])


def with_meso(df: DataFrame, spec: TargetMapSpec) -> DataFrame:
    """Adds meso_idx, meso_bearing and meso_sort_method."""
    keyed = df.withColumn("__meso", F.concat_ws("\u0001", "target_map", "meso_id")).withColumn("__meso", F.when(F.col("meso_id").isNotNull(), F.col("__meso")))
    out = grouping.meso_indexed(keyed, "__meso", "direction", spec.order(), list(spec.needs))
    return out.withColumn("meso_sort_method", F.when(F.col("meso_idx").isNotNull(), "DIRECTION_AND_PROPERTIES")).drop("__meso")


def load(spark: SparkSession, path: str, spec: TargetMapSpec, only_county: str | None = None, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(target features, rejects) of all of a map's yearly files under `path`."""
    features, rejects = readers.feature_lines(spark, path, spec.fields, parts)
    features = features.withColumn("__map", readers.map_name(F.col("source_file"), spec.prefix)).where("__map is not null")
    return with_meso(enriched(features, spec, F.col("__map"), only_county).drop("__map"), spec), rejects


def with_identification(features: DataFrame, csv: DataFrame, key: str = "tmc") -> DataFrame:
    """Features with the identification table's attributes for their id where they have none (rows of one id are laid over each other)."""
    columns = [c for c in csv.columns if c not in (key, "__row")]
    merged = grouping.overlay_last(csv if "__row" in csv.columns else csv.withColumn("__row", F.monotonically_increasing_id()), [key], "__row", columns)
    extra = merged.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = features.join(extra, F.col(key) == F.col("__key"), "left")
    return joined.select(*(F.when(s.is_something(F.col(c)), F.col(c)).otherwise(F.col(f"__{c}")).alias(c) if c in columns else F.col(c) for c in features.columns), *(F.col(f"__{c}").alias(c) for c in columns if c not in features.columns))


def in_order(df: DataFrame, county_code: str | None = None) -> DataFrame:
    """Features, of one county if asked for, by region, county and place."""
    own = df if county_code is None else df.where(F.col("county_code") == county_code)
    return own.orderBy("county_region", "county_code", "geoprox_key", "target_map", "target_map_id")


def save(df: DataFrame, path: str) -> None:
    df.write.partitionBy("target_map").mode("overwrite").parquet(path)


def target_maps(df: DataFrame) -> DataFrame:
    return df.select("target_map").distinct().orderBy("target_map")
