"""Matches of target maps to references: ids, order within features, meso and mega levels.

The matcher itself is outside; its output is a table of pieces with reference_id, from_node, to_node,
the target feature's id and a line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geodesy as geo
from ..functions import scalars as s
from ..lineage import checkpointed
from ..operators import chains, grouping, numbering

KEYS = ["target_map", "target_map_id"]


def restored(matcher_output: DataFrame, prefix: str = "pp_") -> DataFrame:
    """Names that the matcher prefixed and put in lower case, back to the target features' names."""
    return matcher_output.toDF(*(c.removeprefix(prefix) if c.startswith(prefix) else c for c in matcher_output.columns))


def numbered(matches: DataFrame) -> DataFrame:
    """Distinct matches with edge_id and an ordinal that orders the pieces of a feature."""
    df = matches.dropDuplicates([c for c in matches.columns if c != "geometry"]) if "geometry" not in matches.columns else matches.dropDuplicates()
    order = W.partitionBy(*KEYS).orderBy("reference_id", "from_node", "to_node", F.xxhash64("geometry"))
    return df.withColumn("ordinal", F.row_number().over(order)).withColumn("edge_id", F.col("ordinal").cast("string"))


def associated(targets: DataFrame, matches: DataFrame, directed: bool) -> DataFrame:
    """Matches of known targets with matched ids.

    Pieces that make one chain (two, if the map isn't directed) are numbered along it; else they get
    letters in the order they came. Of parallel pieces the longest goes into chains. A piece in both
    chains belongs to the later one.
    """
    known = matches.join(targets.select(*KEYS).distinct(), KEYS, "left_semi")
    edges = chains.with_edge_nodes(numbered(known), KEYS)
    thin = chains.without_parallels(edges, KEYS, F.size("geometry"))
    # The chain maker takes pieces by size, as the last of several ways on is the one followed.
    ordered = thin.withColumn("__o", F.row_number().over(W.partitionBy(*KEYS).orderBy(F.size("geometry"), "ordinal")))
    walked = chains.sorted_chains(ordered.drop("ordinal").withColumnRenamed("__o", "ordinal"), KEYS, both_ways=not directed)
    placed = grouping.first_of(walked.where("edge_id is not null"), [*KEYS, "edge_id"], [F.col("chain").desc()]).drop("error")
    joined = edges.join(placed, [*KEYS, "edge_id"], "left").join(walked.where("error is not null").select(*KEYS, "error"), KEYS, "left")

    chain = W.partitionBy(*KEYS, "chain").orderBy("idx").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    bearing = F.round(geo.final_bearing(F.first(geo.first(F.col("geometry"))).over(chain), F.last(geo.last(F.col("geometry"))).over(chain))).cast("int")
    df = joined.withColumn("matched_micro_bearing", F.when(F.col("chain").isNotNull(), bearing))
    proto = F.concat_ws("|", "target_map_id", F.col("matched_micro_bearing").cast("string"))
    all_ = W.partitionBy(*KEYS)
    letters = s.unsorted_match_id(F.col("target_map_id"), F.row_number().over(all_.orderBy("ordinal")) - 1, F.count(F.lit(1)).over(all_))
    df = df.withColumn("matched_micro_proto_id", F.when(F.col("chain").isNotNull(), proto))
    df = df.withColumn("matched_id", F.when(F.col("chain").isNotNull(), s.sorted_match_id(proto, F.col("idx"), F.col("chain_length"))).when(F.col("error").isNotNull(), letters))
    return df.where("matched_id is not null").withColumnRenamed("idx", "matched_micro_idx").withColumn("is_sorted", F.col("chain").isNotNull()).drop("chain", "chain_length", "error", "edge_id")


def with_meso(matches: DataFrame) -> DataFrame:
    """Adds matched_meso_bearing and matched_meso_idx: micro chains of a (meso id, bearing) put together into chains.

    Where that fails, the bearing follows the target's, and there is no index.
    """
    group = ["target_map", "meso_id", "meso_bearing"]
    usable = matches.where("meso_id is not null and meso_bearing is not null and matched_micro_proto_id is not null")
    ends = usable.groupBy(*group, "matched_micro_proto_id").agg(F.min_by("from_node", "matched_micro_idx").alias("from_node"), F.max_by("to_node", "matched_micro_idx").alias("to_node"))
    edges = ends.withColumnRenamed("matched_micro_proto_id", "edge_id").withColumn("ordinal", F.row_number().over(W.partitionBy(*group).orderBy("edge_id")))
    walked = grouping.first_of(chains.sorted_chains(edges, group, both_ways=True).where("edge_id is not null"), [*group, "edge_id"], [F.col("chain").desc()])
    places = walked.select(*group, F.col("edge_id").alias("matched_micro_proto_id"), F.col("chain").alias("meso_chain"), F.col("idx").alias("meso_at"))
    df = matches.join(places, [*group, "matched_micro_proto_id"], "left")
    line = W.partitionBy(*group, "meso_chain").orderBy("meso_at", "matched_micro_idx")
    whole = line.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    bearing = F.round(geo.final_bearing(F.first(geo.first(F.col("geometry"))).over(whole), F.last(geo.last(F.col("geometry"))).over(whole))).cast("int")
    fallback = s.fallback_meso_bearing(F.col("micro_bearing"), F.col("matched_micro_bearing"), F.col("meso_bearing"))
    in_chain = F.col("meso_chain").isNotNull()
    failed = F.max(in_chain.cast("int")).over(W.partitionBy(*group)) == 0
    df = df.withColumn("matched_meso_bearing", F.when(in_chain, bearing).when(failed & F.col("meso_id").isNotNull() & F.col("meso_bearing").isNotNull(), fallback))
    return df.withColumn("matched_meso_idx", F.when(in_chain, F.row_number().over(line) - 1)).drop("meso_chain", "meso_at")


def with_mega(matches: DataFrame) -> DataFrame:
    """Adds matched_mega_direction along the main axis of all pieces of a road, and matched_micro_id."""
    boxed = matches.where("mega_id is not null").withColumn("b", geo.bbox(F.col("geometry")))
    axis = boxed.groupBy("target_map", "mega_id").agg(F.min("b.west").alias("west"), F.min("b.south").alias("south"), F.max("b.east").alias("east"), F.max("b.north").alias("north"))
    axis = axis.select("target_map", "mega_id", geo.north_south(F.struct("west", "south", "east", "north")).alias("north_south"))
    df = matches.join(axis, ["target_map", "mega_id"], "left")
    direction = F.when(F.col("mega_id").isNotNull(), s.mega_direction(F.col("matched_meso_bearing"), F.col("north_south")))
    df = df.withColumn("matched_mega_direction", direction)
    return df.withColumn("matched_micro_id", s.micro_id(F.col("target_map_id"), F.col("matched_meso_idx"), F.col("matched_mega_direction"))).drop("north_south")


def published(new: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New matches of features without any so far, one for each key of five columns."""
    key = ["reference_id", "from_node", "to_node", "target_map", "target_map_id"]
    out = grouping.first_of(new, key, [F.xxhash64("geometry")])
    return out if existing is None else out.join(existing.select(*KEYS).distinct(), KEYS, "left_anti")


def as_multilines(targets: DataFrame, matches: DataFrame) -> DataFrame:
    """target_map, target_map_id, lines: a target's line and those of its matches."""
    lines = matches.groupBy(*KEYS).agg(F.sort_array(F.collect_list("geometry")).alias("m"))
    return targets.select(*KEYS, "geometry").join(lines, KEYS).select(*KEYS, F.concat(F.array("geometry"), "m").alias("lines"))


def retried(targets: DataFrame, match: Callable[[DataFrame, int, str], DataFrame], attempts: int = 4, passes: tuple[str, ...] = ("motorway", "surface")) -> DataFrame:
    """match(features, attempt, pass) -> matches, called on what is unmatched so far; vertices are doubled after the second attempt.

    Each attempt makes a pass over motorways and then one over surface roads. A pass's matches are
    checkpointed, so the matcher runs once for each. Features are told apart by map and id.
    """
    left, found = targets, None
    for attempt in range(attempts):
        for kind in passes:
            got = checkpointed(match(left, attempt, kind))
            found = got if found is None else found.unionByName(got)
            left = left.join(got.select(*KEYS).distinct(), KEYS, "left_anti")
        if attempt == 1:
            left = left.withColumn("geometry", geo.doubled(F.col("geometry")))
    return found.dropDuplicates()


def batched(targets: DataFrame, size: int = 64, iteration: int = 1) -> DataFrame:
    """Adds match_batch_id, from 1 in the order of places, and match_iteration_id."""
    placed = numbering.number_globally(targets, ["county_region", "county_code", "geoprox_key", *KEYS], "__n")
    return placed.withColumn("match_batch_id", F.expr(f"(__n - 1) div {size} + 1")).withColumn("match_iteration_id", F.lit(iteration)).drop("__n")


def batch_counts(batches: DataFrame, matches: DataFrame) -> DataFrame:
    """match_batch_id, features, matched (features with a match), matches."""
    per = matches.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    joined = batches.join(per, KEYS, "left")
    return joined.groupBy("match_batch_id").agg(F.count(F.lit(1)).alias("features"), F.count("n").alias("matched"), F.coalesce(F.sum("n"), F.lit(0)).alias("matches"))


def progress(matches: DataFrame) -> DataFrame:
    """target_map, matched: how many features of each map have a match."""
    return matches.groupBy("target_map").agg(F.count_distinct("target_map_id").alias("matched"))
