"""Quality of a conflation map: lengths in and out, and how many features make chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import QA_RATIO
from ..functions import geodesy as geo
from ..operators import chains


def lengths_by_feature(targets: DataFrame, segments: DataFrame, tags: DataFrame) -> DataFrame:
    """target_map, target_map_id, in_miles, out_miles, ratio. Pieces of two-way roads count half for RIS maps."""
    into = targets.select("target_map", "target_map_id", geo.length_miles(F.col("geometry")).alias("in_miles"))
    pieces = tags.select("id", "target_map", "target_map_id").distinct().join(segments.select("id", geo.length_miles(F.col("geometry")).alias("m"), F.coalesce("osm.one_way", F.lit(False)).alias("one_way")), "id")
    half = F.col("target_map").rlike(r"^ris_\d{4}$") & ~F.col("one_way")
    out = pieces.groupBy("target_map", "target_map_id").agg(F.sum(F.when(half, F.col("m") / 2).otherwise(F.col("m"))).alias("out_miles"))
    df = into.join(out, ["target_map", "target_map_id"], "left").withColumn("out_miles", F.coalesce("out_miles", F.lit(0.0)))
    return df.withColumn("ratio", F.when(F.col("in_miles") > 0, (F.col("in_miles") - F.col("out_miles")) / F.col("in_miles")))


def lengths_summary(by_feature: DataFrame, most: float = QA_RATIO) -> DataFrame:
    passing = F.coalesce(F.abs("ratio") <= most, F.lit(False))
    out = by_feature.groupBy("target_map").agg(F.sum("in_miles").alias("total_miles"), F.sum(F.when(passing, F.col("in_miles")).otherwise(0.0)).alias("passing_miles"))
    return out.withColumn("passing_ratio", F.when(F.col("total_miles") > 0, F.col("passing_miles") / F.col("total_miles")))


def chain_success(matches: DataFrame, target_map: str) -> DataFrame:
    """One row, success_ratio: of all matched ids, those whose pieces in `target_map` make chains."""
    ids = matches.select("target_map_id").distinct()
    own = matches.where(F.col("target_map") == target_map).select("target_map_id", F.col("reference_id").alias("edge_id"), "from_node", "to_node")
    good = chains.forms_chains(own, ["target_map_id"])
    return ids.join(good, "target_map_id", "left").agg(F.avg(F.coalesce(F.col("ok").cast("int"), F.lit(0))).alias("success_ratio"))
