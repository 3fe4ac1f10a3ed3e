"""Queries that run whole plans on a network made from the test tables, each with DuckDB SQL that gives the same rows.

The network: each customer is a road of six vertices northwards, of two way sections, the later one one-way for
odd keys; every third road has a back reference too. Each order is a target feature matched from its reference's
first vertex to a later one, so that features of one map overlap; two vertices are 8 m apart, less than an interval
may be long. The SQL works in vertex numbers, so it shares no arithmetic along lines with the plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .constants import EASTBOUND, NORTHBOUND, SPLIT_BUFFER_KM
from .functions import geodesy as geo
from .operators import chains
from .plans import conflation, osm, references
from .queries import ORACLES, QUERIES, _NET, _net, km, query

__all__ = ["ORACLES", "QUERIES"]

MAPS = ["npmrds_2019", "ris_2019"]
#: How far north of the first each vertex is, in hundred-thousandths of a degree.
STEPS = (0, 200, 500, 507, 907, 1107)

# ---- The network as tables


def tiles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Geometries, metadata and references."""
    c = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    text = lambda sql: F.expr(f"CAST({sql} AS STRING)")
    back = F.when(F.col("k") % 3 == 0, F.concat(F.lit("b"), text("k")))
    lonlats = F.flatten(F.array(*(F.array(F.expr("-79 + (k * 7919 % 700000) / 100000D"), F.expr(f"(4050000 + k * 104729 % 450000 + {d}) / 100000D")) for d in STEPS)))
    geometries = c.select(
        F.concat(F.lit("g"), text("k")).alias("id"), lonlats.alias("lonlats"), F.concat(F.lit("f"), text("k")).alias("forwardReferenceId"), back.alias("backReferenceId"),
        F.concat(F.lit("i"), text("2 * k")).alias("fromIntersectionId"), F.concat(F.lit("i"), text("2 * k + 1")).alias("toIntersectionId"))

    def section(way: str, nodes: range, cls, one_way):
        return F.struct(text(way).alias("wayId"), F.array(*(text(f"k * 10 + {n}") for n in nodes)).alias("nodeIds"), cls.alias("roadClass"), one_way.alias("oneWay"))

    odd = F.col("k") % 2 == 1
    sections = F.array(section("2 * k", range(3), F.lit("Primary"), F.lit(False)), section("2 * k + 1", range(2, 6), F.when(odd, "Residential").otherwise("Secondary"), odd))
    metadata = c.select(F.concat(F.lit("g"), text("k")).alias("geometryId"), F.struct(F.concat(F.lit("Road "), text("k")).alias("name"), sections.alias("waySections")).alias("osmMetadata"))
    both = geometries.select("id", F.explode(F.array("forwardReferenceId", "backReferenceId")).alias("r")).where("r is not null")
    return geometries, metadata, both.select(F.col("r").alias("id"), F.col("id").alias("geometryId"))


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.reference_features(*tiles(spark, sf_dir))


def matched(spark: SparkSession, sf_dir: str, refs: DataFrame) -> DataFrame:
    """Orders as matches: of each the part of its reference up to a vertex."""
    o = fx.table(spark, sf_dir, "orders").select(
        F.expr("CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 4 > 1 THEN 'b' ELSE 'f' END || CAST(o_custkey AS STRING)").alias("reference_id"),
        F.expr(f"CASE WHEN o_orderkey % 2 = 0 THEN '{MAPS[0]}' ELSE '{MAPS[1]}' END").alias("target_map"), F.expr("CAST(o_orderkey AS STRING)").alias("target_map_id"),
        F.expr("CAST(o_orderkey DIV 8 % 5 + 1 AS INT)").alias("last"), F.expr("CAST(o_orderkey AS STRING) || '|0|0'").alias("matched_id"), F.lit(True).alias("is_primary"), F.lit(1.0).alias("rank"),
        F.lit(None).cast("string").alias("meso_id"), F.lit(None).cast("string").alias("mega_id"), F.lit(None).cast("int").alias("matched_micro_idx"),
        F.expr("CAST(o_orderkey DIV 4 % 4 AS INT)").alias("matched_meso_idx"), F.lit(None).cast("int").alias("matched_meso_bearing"),
        F.expr("CAST(o_orderkey DIV 2 % 4 + 1 AS INT)").alias("matched_mega_direction"), F.expr("CASE WHEN o_orderkey DIV 2 % 3 > 0 THEN 'm' || CAST(o_custkey % 20 AS STRING) || '|1' END").alias("matched_micro_id"))
    lines = refs.select("reference_id", "from_node", "to_node", "geometry")
    return o.join(lines, "reference_id").withColumn("geometry", F.slice("geometry", F.lit(1), F.col("last") + 1)).drop("last")


# ---- The network in SQL: v has the vertices of references in their direction, iv what is left of the matches

VERTICES = f"""r AS (SELECT c_custkey AS k, 'f' || c_custkey AS reference_id, false AS rev FROM customer UNION ALL SELECT c_custkey, 'b' || c_custkey, true FROM customer WHERE c_custkey % 3 = 0),
q AS (SELECT k, reference_id, rev, i, CASE WHEN rev THEN 5 - i ELSE i END AS j FROM r, range(6) t(i)),
w AS (SELECT *, k * 10 + j AS node, -79 + (k * 7919 % 700000) / 100000::DOUBLE AS x, (4050000 + k * 104729 % 450000 + {list(STEPS)}[j + 1]) / 100000::DOUBLE AS y FROM q),
d AS (SELECT *, CASE WHEN i > 0 THEN {km('x', 'lag(y) OVER z', 'x', 'y')} ELSE 0 END AS step FROM w WINDOW z AS (PARTITION BY reference_id ORDER BY i)),
v AS (SELECT *, sum(step) OVER (PARTITION BY reference_id ORDER BY i) AS poff FROM d)"""
MATCHES = f"""{VERTICES}, offs AS (SELECT reference_id, list(poff ORDER BY i) AS o FROM v GROUP BY ALL),
m AS (SELECT CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 4 > 1 THEN 'b' ELSE 'f' END || o_custkey AS reference_id, CASE WHEN o_orderkey % 2 = 0 THEN '{MAPS[0]}' ELSE '{MAPS[1]}' END AS target_map, o_orderkey::VARCHAR AS target_map_id,
  o_orderkey // 8 % 5 + 1 AS e, o_orderkey // 4 % 4 AS meso, o_orderkey // 2 % 4 + 1 AS mega, CASE WHEN o_orderkey // 2 % 3 > 0 THEN 'm' || o_custkey % 20 || '|1' ELSE o_orderkey || '|0|0' END AS map_id FROM orders)"""
INTERVALS = f"""{MATCHES}, mo AS (SELECT m.*, o, list(e) OVER (PARTITION BY reference_id, target_map ORDER BY target_map_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM m JOIN offs USING (reference_id)),
ms AS (SELECT *, list_reduce(list_prepend(0::BIGINT, coalesce(prior, []::BIGINT[])), lambda a, x: CASE WHEN x > a AND o[x + 1] - o[a + 1] >= {SPLIT_BUFFER_KM} THEN x ELSE a END) AS s FROM mo),
iv AS (SELECT * FROM ms WHERE e > s AND o[e + 1] - o[s + 1] >= {SPLIT_BUFFER_KM})"""


# ---- Plans


@query(f"""WITH {VERTICES} SELECT reference_id, 'g' || k AS geometry_id, rev AS reversed, 'i' || (2 * k + rev::BIGINT) AS from_node, 'i' || (2 * k + 1 - rev::BIGINT) AS to_node, 'Road ' || k AS name,
CASE WHEN rev THEN {EASTBOUND} ELSE {NORTHBOUND} END::INTEGER AS direction, string_agg(node::VARCHAR, ',' ORDER BY i) AS nodes, round(sum(step), 5) AS length_km, round(max(CASE WHEN i = 2 THEN poff END), 5) AS third_at FROM v GROUP BY ALL""")
def reference_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.round(F.element_at("vertices", 3)["poff"], 5).alias("third_at")
    return roads(spark, sf_dir).select("reference_id", "geometry_id", "reversed", "from_node", "to_node", "name", F.col("direction").cast("int").alias("direction"), F.array_join("node_ids", ",").alias("nodes"), F.round("length_km", 5).alias("length_km"), at)


@query(f"""WITH {INTERVALS} SELECT reference_id, target_map, target_map_id, round(o[s + 1], 5) AS start_dist, round(o[e + 1], 5) AS end_dist FROM iv""")
def target_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches as intervals along references, snapped to vertices, without overlaps, none shorter than the split buffer."""
    refs = roads(spark, sf_dir)
    out = conflation.target_intervals(refs, matched(spark, sf_dir, refs))
    return out.select("reference_id", "target_map", "target_map_id", F.round("start_dist", 5).alias("start_dist"), F.round("end_dist", 5).alias("end_dist"))


@query("""WITH p AS (SELECT c_custkey AS k, round(-79 + (c_custkey * 7919 % 700000) / 100000::DOUBLE, 7) AS ax, round(40.5 + (c_custkey * 104729 % 450000) / 100000::DOUBLE, 7) AS ay,
  round(-79 + ((c_custkey + 1) * 7919 % 700000) / 100000::DOUBLE, 7) AS bx, round(40.5 + ((c_custkey + 1) * 104729 % 450000) / 100000::DOUBLE, 7) AS by_ FROM customer),
s AS (SELECT k, ax, ay, bx, CASE WHEN k % 5 = 0 THEN round(by_ + 10, 7) ELSE by_ END AS by_ FROM p),
n AS (SELECT ax AS x, ay AS y, min(k) AS id FROM p GROUP BY ALL), f AS (SELECT DISTINCT bx AS x, by_ AS y FROM s WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.x = bx AND n.y = by_)),
g AS (SELECT x, y, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY x, y) AS id FROM f), u AS (SELECT * FROM n UNION ALL SELECT * FROM g)
SELECT k, k AS start_node, u.id AS end_node FROM s JOIN u ON u.x = bx AND u.y = by_""")
def generated_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up ends of pieces take the node at their place, or a new one with the next id."""
    p = fx.points(spark, sf_dir)
    far = F.when(F.col("c_custkey") % 5 == 0, geo.point(F.col("b.lon"), F.round(F.round("b.lat", 7) + 10, 7))).otherwise(F.col("b"))
    key = F.col("c_custkey").cast("string")
    segments = p.select("c_custkey", F.array("a", far).alias("geometry"), F.array(key, F.lit(None).cast("string")).alias("node_ids"))
    nodes = p.select(F.col("c_custkey").alias("id"), F.round("a.lon", 7).alias("lon"), F.round("a.lat", 7).alias("lat"))
    out = osm.generated_nodes(segments, nodes)[1]
    at = lambda i: F.element_at("node_ids", i).cast("long")
    return out.select(F.col("c_custkey").alias("k"), at(1).alias("start_node"), at(-1).alias("end_node"))


@query(f"WITH {VERTICES} SELECT DISTINCT node AS id, round(x, 7) AS lon, round(y, 7) AS lat FROM v")
def base_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return osm.base_nodes(roads(spark, sf_dir))


# ---- Chains with forks: orders as features of up to seven edges among six nodes. A step is one of 36 signs.

FORKS = f"""{_NET}, src AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM n o WHERE o.grp = n.grp AND o.b = n.a AND o.id <> n.id AND NOT (o.a = n.b))),
st AS (SELECT g.grp, g.n AS n_edges, coalesce(s.n, 0) AS n_sources FROM (SELECT grp, count(*) AS n FROM n GROUP BY grp) g LEFT JOIN (SELECT grp, count(*) AS n FROM src GROUP BY grp) s USING (grp)),
walk AS (SELECT grp, [id] AS ids, [a * 6 + b] AS steps, b AS at FROM src JOIN st USING (grp) WHERE n_sources <= 2
  UNION ALL SELECT w.grp, list_append(w.ids, n.id), list_append(w.steps, n.a * 6 + n.b), n.b FROM walk w JOIN n ON n.grp = w.grp AND n.a = w.at AND NOT list_contains(w.ids, n.id) AND NOT list_contains(w.steps, n.b * 6 + n.a)),
ch AS (SELECT grp, ids, array_to_string(list_transform(steps, lambda x: substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', (x + 1)::INTEGER, 1)), '') AS steps FROM walk w
  WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.grp = w.grp AND n.a = w.at AND NOT list_contains(w.ids, n.id) AND NOT list_contains(w.steps, n.b * 6 + n.a)))"""


def _steps(walked: DataFrame, edges: DataFrame) -> DataFrame:
    """grp, steps, error: a row for each chain, or for each group with an error."""
    sign = F.substr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (F.col("from_node") * 6 + F.col("to_node") + 1).cast("int"), F.lit(1)).alias("sign")
    places = walked.where("edge_id is not null").join(edges.dropDuplicates(["grp", "edge_id"]).select("grp", F.col("edge_id").cast("string").alias("edge_id"), sign), ["grp", "edge_id"])
    steps = places.groupBy("grp", "chain").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "sign"))), lambda x: x["sign"]), "").alias("steps"))
    return steps.select("grp", "steps", F.lit(None).cast("string").alias("error")).unionByName(walked.where("error is not null").select("grp", F.lit(None).cast("string").alias("steps"), "error"))


@query(f"""WITH RECURSIVE {FORKS} SELECT grp, steps, NULL::VARCHAR AS error FROM ch JOIN st USING (grp) WHERE n_edges > 1
UNION ALL SELECT grp, substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', (a * 6 + b + 1)::INTEGER, 1), NULL FROM n JOIN st USING (grp) WHERE n_edges = 1
UNION ALL SELECT grp, NULL, CASE WHEN n_sources = 0 THEN '{chains.NO_SOURCE}' ELSE '{chains.MANY_SOURCES_2}' END FROM st WHERE n_edges > 1 AND n_sources NOT BETWEEN 1 AND 2""")
def chains_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ways from sources on, forks included."""
    edges = _net(spark, sf_dir).withColumn("ordinal", F.col("edge_id"))
    return _steps(chains.sorted_chains(edges, ["grp"], both_ways=True, all_chains=True), edges)


@query(f"""WITH RECURSIVE {FORKS}, cn AS (SELECT grp, count(*) AS n_chains FROM ch GROUP BY grp),
er AS (SELECT grp, CASE WHEN n_sources = 0 THEN '{chains.NO_SOURCE}' WHEN n_sources > 2 THEN '{chains.MANY_SOURCES_2}' WHEN n_chains > 2 THEN '{chains.MANY_CHAINS_2}' END AS error FROM st LEFT JOIN cn USING (grp)),
two AS (SELECT grp, steps, row_number() OVER (PARTITION BY grp ORDER BY len(steps), ids) AS nth FROM ch JOIN er USING (grp) WHERE error IS NULL)
SELECT s.grp, s.steps, NULL::VARCHAR AS error FROM two s WHERE NOT EXISTS (SELECT 1 FROM two l WHERE l.grp = s.grp AND l.nth > s.nth AND regexp_matches(l.steps, regexp_replace(s.steps, '(.)', '\\1.*', 'g')))
UNION ALL SELECT grp, NULL, error FROM er WHERE error IS NOT NULL""")
def chains_forked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to two chains a feature, none that lies within the other, or an error."""
    edges = _net(spark, sf_dir).withColumn("ordinal", F.col("edge_id"))
    return _steps(chains.sorted_chains(edges, ["grp"], both_ways=True), edges)
