"""OSM elements of the conflation map: nodes, ways with tags, restrictions, and the node index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import NODE_DECIMALS
from ..operators import grouping, numbering


def base_nodes(references: DataFrame) -> DataFrame:
    """id, lon, lat of the base network; the first of each id."""
    v = references.where("vertices is not null").select("reference_id", F.posexplode("vertices").alias("i", "v")).where("v.node_id is not null")
    rows = v.select(F.col("v.node_id").cast("long").alias("id"), F.round("v.lon", NODE_DECIMALS).alias("lon"), F.round("v.lat", NODE_DECIMALS).alias("lat"), "reference_id", "i")
    return grouping.first_of(rows, ["id"], ["reference_id", "i"]).select("id", "lon", "lat")


def valid_segments(segments: DataFrame) -> DataFrame:
    """Pieces with a node for each vertex, of which only the ends may be made up."""
    inner = F.slice("node_ids", 2, F.greatest(F.size("node_ids") - 2, F.lit(0)))
    return segments.where(F.size("node_ids") == F.size("geometry")).where(F.forall(inner, lambda n: n.isNotNull()))


def generated_nodes(segments: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, segments): made-up ends take the node at their rounded place or a new one, numbered on from the largest id."""
    seg = valid_segments(segments)
    rounded = lambda p, f: F.round(p[f], NODE_DECIMALS)
    ends = [("a", F.element_at("node_ids", 1), F.element_at("geometry", 1)), ("b", F.element_at("node_ids", -1), F.element_at("geometry", -1))]
    places = None
    for _, node, p in ends:
        one = seg.where(node.isNull()).select(rounded(p, "lon").alias("lon"), rounded(p, "lat").alias("lat"))
        places = one if places is None else places.unionByName(one)
    there = grouping.first_of(nodes, ["lon", "lat"], ["id"])
    new = places.distinct().join(there, ["lon", "lat"], "left_anti")
    new = numbering.number_globally(new, ["lon", "lat"], "id", after=nodes.agg(F.max("id"))).select("id", "lon", "lat")
    all_ = nodes.unionByName(new)
    at = grouping.first_of(all_, ["lon", "lat"], ["id"])
    for name, node, p in ends:
        look = at.select(F.col("lon").alias(f"lon_{name}"), F.col("lat").alias(f"lat_{name}"), F.col("id").cast("string").alias(f"id_{name}"))
        on = (rounded(p, "lon") == F.col(f"lon_{name}")) & (rounded(p, "lat") == F.col(f"lat_{name}"))
        seg = seg.join(look, on, "left").drop(f"lon_{name}", f"lat_{name}")
    n = F.size("node_ids")
    filled = F.transform("node_ids", lambda x, i: F.coalesce(x, F.when(i == 0, F.col("id_a")).when(i == n - 1, F.col("id_b"))))
    return all_, seg.withColumn("node_ids", filled).drop("id_a", "id_b")


def _not_in(m):
    return lambda k, v: ~F.map_contains_key(m, k)


def way_tags(raw_tags, own, map_tags):
    """Raw tags but `oneway`, then own properties with a prefix, then map ids; always one-way. Later keys win."""
    none = F.create_map().cast("map<string,string>")
    raw = F.map_filter(F.coalesce(raw_tags, none), lambda k, v: k != "oneway")
    prefixed = F.transform_keys(F.coalesce(own, none), lambda k, v: F.concat(F.lit("conflation_map:"), k))
    parts = [raw, prefixed, F.coalesce(map_tags, none), F.create_map(F.lit("oneway"), F.lit("yes"))]
    out = parts[0]
    for later in parts[1:]:
        out = F.map_concat(F.map_filter(out, _not_in(later)), later)
    return out


def generated_ways(segments: DataFrame, tags: DataFrame, raw_ways: DataFrame) -> DataFrame:
    """id, nodes, raw_osm_id, start_node, end_node, tags."""
    named = lambda end, c: F.struct(F.concat("target_map", F.lit(end)).alias("key"), F.col(c).cast("string").alias("value"))
    one = grouping.first_of(tags, ["id", "target_map"], [F.col("target_map_id").desc(), F.col("map_idx").desc()])
    per = one.groupBy("id").agg(F.map_from_entries(F.flatten(F.sort_array(F.collect_list(F.array(named("_id", "map_id"), named("_idx", "map_idx")))))).alias("map_tags"))
    own = F.map_from_arrays(
        F.array(*map(F.lit, ("referenceId", "segmentIndex", "totalSegments", "networklevel", "startDist", "endDist"))),
        F.array(*(F.col(c).cast("string") for c in ("reference_id", "segment_index", "total_segments", "network_level", "start_dist", "end_dist"))))
    raw = raw_ways.select(F.col("id").cast("string").alias("raw_id"), F.col("tags").alias("raw_tags"))
    df = segments.join(per, "id", "left").join(raw, F.col("osm.target_map_id") == F.col("raw_id"), "left")
    return df.select(
        "id", F.transform("node_ids", lambda n: n.cast("long")).alias("nodes"), F.col("osm.target_map_id").cast("long").alias("raw_osm_id"),
        F.element_at("node_ids", 1).cast("long").alias("start_node"), F.element_at("node_ids", -1).cast("long").alias("end_node"), way_tags(F.col("raw_tags"), own, F.col("map_tags")).alias("tags"))


def restrictions(raw: DataFrame, ways: DataFrame) -> DataFrame:
    """id, members, restriction: raw restrictions moved to the generated way that ends, or starts, at the via node; the first of several."""
    r = raw.where("restriction is not null").select("id", F.col("members")["from"].cast("long").alias("f"), F.col("members")["via"].cast("long").alias("v"), F.col("members")["to"].cast("long").alias("t"), "restriction").where("f is not null and v is not null and t is not null")
    into = ways.groupBy(F.col("raw_osm_id").alias("f"), F.col("end_node").alias("v")).agg(F.min("id").alias("from_way"))
    out_of = ways.groupBy(F.col("raw_osm_id").alias("t"), F.col("start_node").alias("v")).agg(F.min("id").alias("to_way"))
    df = r.join(into, ["f", "v"]).join(out_of, ["t", "v"])
    members = F.create_map(F.lit("from"), F.col("from_way"), F.lit("via"), F.col("v"), F.lit("to"), F.col("to_way"))
    return numbering.number_globally(df, ["id"], "new_id").select(F.col("new_id").alias("id"), members.alias("members"), "restriction")


def node_index(ways: DataFrame) -> DataFrame:
    """node, owners: for each node a map of the ways through it to its positions there."""
    return grouping.inverted(ways.select("id", F.posexplode("nodes").alias("at", "node")), "id", "node", "at")


def check_unique(df: DataFrame, key: str = "id") -> DataFrame:
    """Keys that occur more than once; loads that don't ignore duplicates need none of them."""
    return df.groupBy(key).count().where("count > 1")


