"""A small network, hand-made, from tiles and target maps to OSM, exports and quality."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lanemesh import __main__ as command_line
from lanemesh.functions import geodesy as geo
from lanemesh.operators import chains, partition
from lanemesh.plans import conflation, export, matching, osm, quality, references, targets
from lanemesh.sources import readers, writers
from lanemesh.streaming import incremental

# A street of four vertices from west to east with both directions, and a one-way street north from its end.
A, B, C, D, E = (-73.80, 42.60), (-73.79, 42.60), (-73.78, 42.60), (-73.77, 42.60), (-73.77, 42.62)


def flat(*ps):
    return [x for p in ps for x in p]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("net")
    way = lambda w, nodes, cls, one: {"wayId": w, "nodeIds": nodes, "roadClass": cls, "oneWay": one}
    tiles = {
        "12-1-1.geometry.8.json": [
            {"id": "g1", "lonlats": flat(A, B, C, D), "forwardReferenceId": "r1", "backReferenceId": "r2", "fromIntersectionId": "i1", "toIntersectionId": "i2"},
            {"id": "g2", "lonlats": flat(D, E), "forwardReferenceId": "r3", "backReferenceId": None, "fromIntersectionId": "i2", "toIntersectionId": "i3"}],
        "12-1-1.metadata.8.json": [
            {"geometryId": "g1", "osmMetadata": {"name": "Main", "waySections": [way("100", ["1", "2"], "Primary", False), way("101", ["2", "3", "4"], "Secondary", False)]}},
            {"geometryId": "g2", "osmMetadata": {"name": "North", "waySections": [way("102", ["4", "5"], "Residential", True)]}}],
        "12-1-1.reference.8.json": [{"id": "r1", "geometryId": "g1"}, {"id": "r2", "geometryId": "g1"}, {"id": "r3", "geometryId": "g2"}],
    }
    (d / "tiles").mkdir()
    for name, rows in tiles.items():
        (d / "tiles" / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    line = lambda *ps: {"type": "LineString", "coordinates": [list(p) for p in ps]}
    n = [
        {"type": "Feature", "geometry": line(A, B, C), "properties": {"tmc": "120P1", "tmclinear": "7", "county": "Albany", "roadnumber": "US 9", "direction": "E", "road_order": "1", "f_system": "3"}},
        {"type": "Feature", "geometry": line(C, D), "properties": {"tmc": "120P2", "tmclinear": "7", "county": "ALBANY", "roadnumber": "US 9", "direction": "Eastbound", "road_order": "2", "f_system": ""}},
        {"type": "Feature", "geometry": line(C), "properties": {"tmc": "120P3", "county": "Albany"}},
        {"type": "Feature", "geometry": line(C, D), "properties": {"tmc": "120P4", "county": "Nowhere"}},
    ]
    (d / "maps").mkdir()
    (d / "maps" / "npmrds.2019.ndjson").write_text("".join(json.dumps(r) + "\n" for r in n) + "not json\n")
    r = [{"type": "Feature", "geometry": line(D, E), "properties": {"objectid": "11", "region": "1", "county_nam": "St. Lawrence", "fips_co": "89", "dot_id": "d1", "gis_id": "g", "beg_mp": "0.5", "overlap_hi": None, "functional": "14", "direction": "P"}}]
    (d / "maps" / "ris.2019.ndjson").write_text("".join(json.dumps(x) + "\n" for x in r))
    return f"file://{d}"


@pytest.fixture(scope="module")
def maps(spark, folder):
    a, rejects = targets.load(spark, f"{folder}/maps", targets.NPMRDS)
    b, _ = targets.load(spark, f"{folder}/maps", targets.RIS)
    return a.cache(), b.cache(), rejects


def test_target_maps(maps):
    a, b, rejects = maps
    rows = {r.target_map_id: r for r in a.collect()}
    assert set(rows) == {"120P1", "120P2"}
    one, two = rows["120P1"], rows["120P2"]
    assert (one.target_map, one.meso_id, one.macro_id, one.mega_id, one.county_code) == ("npmrds_2019", "36001|7", "01|US 9", "US 9", "36001")
    assert (one.meso_idx, two.meso_idx, one.meso_bearing, one.rank, two.rank, one.is_primary) == (0, 1, 90, 3.0, 10.0, True)
    (r,) = b.collect()
    assert (r.target_map_id, r.county_code, r.region_code, r.rank, r.direction, r.micro_bearing, r.is_primary) == ("10", "36089", "01", 4.0, 1, 0, True)
    assert {x.reason for x in rejects.collect()} == {"not JSON", "no line"}


@pytest.fixture(scope="module")
def refs(spark, folder):
    read = lambda kind: readers.tiles(spark, f"{folder}/tiles", kind)
    return references.reference_features(read("geometry"), read("metadata"), read("reference")).cache()


def test_references(refs):
    rows = {r.reference_id: r for r in refs.collect()}
    assert [v.node_id for v in rows["r1"].vertices] == ["1", "2", "3", "4"] and [v.node_id for v in rows["r2"].vertices] == ["4", "3", "2", "1"]
    assert (rows["r1"].direction, rows["r3"].direction, rows["r2"].reversed, rows["r2"].from_node) == (3, 1, True, "i2")
    assert rows["r1"].vertices[-1].poff == rows["r1"].length_km and rows["r1"].vertices[-1].noff == 0
    assert abs(rows["r1"].length_km - 2.4555) < 0.01


@pytest.fixture(scope="module")
def matched(spark, maps):
    a, b, _ = maps
    half = lambda p, q: ((p[0] + q[0]) / 2, (p[1] + q[1]) / 2)
    rows = [("r1", "i1", "i2", "npmrds_2019", "120P1", [A, B, half(B, C)]), ("r1", "i1", "i2", "npmrds_2019", "120P2", [half(B, C), C, D]), ("r3", "i2", "i3", "ris_2019", "10", [D, E])]
    raw = spark.createDataFrame([(*r[:5], [tuple(p) for p in r[5]]) for r in rows], "reference_id string, from_node string, to_node string, target_map string, target_map_id string, geometry array<struct<lon:double,lat:double>>")
    props = [F.col(c) for c in ("target_map", "target_map_id", "is_primary", "rank", "meso_id", "mega_id", "micro_bearing", "meso_bearing")]
    out = None
    for t, directed in ((a, True), (b, False)):
        m = matching.associated(t, raw.join(t.select(*props), ["target_map", "target_map_id"]), directed)
        out = m if out is None else out.unionByName(m)
    return matching.published(matching.with_mega(matching.with_meso(out))).cache()


def test_matching(matched):
    rows = {r.target_map_id: r for r in matched.collect()}
    assert rows["120P1"].matched_id == "120P1|90|0" and rows["10"].matched_id == "10|0|0"
    # Both pieces of the street run between the same nodes: the later one stands for both in the meso chain.
    assert rows["120P2"].matched_mega_direction == 3 and rows["120P1"].matched_meso_bearing is None and rows["10"].matched_mega_direction == 1


def test_conflation_osm_exports_and_quality(spark, refs, matched, maps, folder):
    segments, tags = conflation.conflated(refs, matched, compat=False)
    seg, tags = segments.cache(), tags.cache()
    by_ref = {}
    for r in seg.collect():
        by_ref.setdefault(r.reference_id, []).append(r)
    for r in refs.collect():  # pieces tile each reference
        p = sorted(by_ref[r.reference_id], key=lambda x: x.segment_index)
        assert p[0].start_dist == 0 and p[-1].end_dist == r.length_km and all(x.end_dist == y.start_dist for x, y in zip(p, p[1:]))
        assert [x.segment_index for x in p] == list(range(1, len(p) + 1)) and p[0].total_segments == len(p)
    assert len(by_ref["r1"]) == 3  # cut at the change of way and half way between vertices
    assert sorted(r.id for r in seg.collect()) == list(range(1, seg.count() + 1))
    assert partition.violations(seg, refs).count() == 0
    levels = {r.reference_id: r.network_level for r in seg.collect() if r.segment_index == 1}
    assert levels == {"r1": 2.0, "r2": 3.0, "r3": 5.5}
    t = {(r.reference_id, r.segment_index): (r.target_map_id, r.map_idx) for r in tags.collect()}
    assert t == {("r1", 1): ("120P1", 0), ("r1", 2): ("120P1", 1), ("r1", 3): ("120P2", 0), ("r3", 1): ("10", 0)}

    nodes, filled = (x.cache() for x in osm.generated_nodes(seg, osm.base_nodes(refs)))
    ids = {r.id for r in nodes.collect()}
    assert ids == {1, 2, 3, 4, 5, 6}  # one made-up node after the largest id
    raw = spark.createDataFrame([(100, {"name": "Main", "oneway": "no"})], "id long, tags map<string,string>")
    ways = osm.generated_ways(filled, tags, raw).cache()
    w = {r.id: r for r in ways.collect()}
    first = next(r for r in seg.collect() if r.reference_id == "r1" and r.segment_index == 1)
    assert w[first.id].nodes == [1, 2] and w[first.id].tags["name"] == "Main" and w[first.id].tags["oneway"] == "yes" and w[first.id].tags["npmrds_2019_idx"] == "0"
    members = lambda f, v, to: {"from": str(f), "via": str(v), "to": str(to)}
    rules = spark.createDataFrame([(7, members(101, 4, 102), "no_left_turn"), (8, members(1, 2, 3), "x"), (9, None, "x")], "id long, members map<string,string>, restriction string")
    (rule,) = osm.restrictions(rules, ways).collect()
    assert rule.id == 1 and rule.members["via"] == 4
    index = {r.node: dict(r.owners) for r in osm.node_index(ways).collect()}
    assert set(index) == ids

    doc = writers.osm_document(nodes, osm.restrictions(rules, ways), ways, (-74.0, 42.0, -73.0, 43.0))
    text = "\n".join(r.value for r in doc.orderBy("part", "id").collect())
    import xml.etree.ElementTree as et

    root = et.fromstring(text.encode())
    assert len(root.findall("node")) == 6 and len(root.findall("way")) == seg.count() and len(root.findall("relation")) == 1
    writers.write_osm(doc, f"{folder}/out.osm")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/back.osm")
    n, ws, rs = readers.osm_elements(spark, f"{folder}/back.osm")
    assert n.count() == 6 and ws.count() == seg.count() and rs.collect()[0].members["via"] == "4"

    flat_ = export.flat_map(seg, tags, ["npmrds_2019", "ris_2019"])
    f = [json.loads(r.value) for r in export.feature_rows(flat_).collect()]
    one = next(x for x in f if x["id"] == first.id)
    assert one["properties"]["split_seg"] == "1:3" and one["properties"]["tmc19id"] == "120P1" and one["geometry"]["type"] == "LineString"
    assert "networklev" in export.for_shapefile(flat_).columns and export.at_zoom(flat_, 10).count() == 2
    assert len(json.loads(writers.feature_collection(export.feature_rows(flat_)).first().value)["features"]) == seg.count()

    a, b, _ = maps
    both = a.select("target_map", "target_map_id", "geometry").unionByName(b.select("target_map", "target_map_id", "geometry"))
    q = {r.target_map_id: r for r in quality.lengths_by_feature(both, seg, tags).collect()}
    assert abs(q["10"].ratio) < 1e-6 and 0.2 < q["120P1"].ratio < 0.3
    s = {r.target_map: r for r in quality.lengths_summary(quality.lengths_by_feature(both, seg, tags)).collect()}
    assert s["ris_2019"].passing_ratio == 1.0 and s["npmrds_2019"].passing_ratio == 0.0
    assert quality.chain_success(matched, "npmrds_2019").first().success_ratio == pytest.approx(2 / 3)


def test_incremental_tiles(spark, folder):
    out, mark = f"{folder}/loaded", f"{folder}/mark"
    for _ in range(2):
        incremental.load_new_tiles(spark, f"{folder}/tiles", "geometry", out, mark).awaitTermination(60)
    assert spark.read.parquet(out).count() == 2


def test_missing_and_sibling_tiles(spark):
    lines = spark.createDataFrame([([A, E],)], "geometry array<struct<lon:double,lat:double>>")
    all_ = {r.tile_id for r in readers.missing_tiles(lines, spark.createDataFrame([], "tile_id string")).collect()}
    have = spark.createDataFrame([(sorted(all_)[0],)], "tile_id string")
    assert {r.tile_id for r in readers.missing_tiles(lines, have).collect()} == all_ - {sorted(all_)[0]}
    names = spark.createDataFrame([("12-1-1.geometry.8.pbf",), ("12-1-2.geometry.8.pbf",)], "name string")
    there = spark.createDataFrame([("12-1-1.metadata.8.pbf",)], "name string")
    assert [r.name for r in readers.sibling_tiles(names, "metadata", there).collect()] == ["12-1-2.metadata.8.pbf"]


def test_identification_and_retries(spark, tmp_path):
    (tmp_path / "t.csv").write_text("TMC, Road , Direction\na, x ,N\na,,S\nb,y,\n")
    csv = readers.header_csv(spark, f"file://{tmp_path}/t.csv")
    assert csv.columns == ["tmc", "road", "direction"]
    f = spark.createDataFrame([("a", None), ("b", "own"), ("c", "z")], "tmc string, road string")
    got = {r.tmc: (r.road, r.direction) for r in targets.with_identification(f, csv).collect()}
    assert got["b"][0] == "own" and got["a"][1] == "S" and got["c"] == ("z", None)
    t = spark.createDataFrame([("m", "1", [A, B]), ("m", "2", [B, C]), ("n", "1", [A, C])], "target_map string, target_map_id string, geometry array<struct<lon:double,lat:double>>")
    seen = []

    def match(left, attempt, kind):
        seen.append((attempt, kind, left.count(), max([len(r.geometry) for r in left.collect()], default=0)))
        return left.where((F.col("target_map_id") == str(attempt + 1)) & (F.col("target_map") == ("m" if kind == "motorway" else "n"))).select("target_map", "target_map_id")

    assert sorted(map(tuple, matching.retried(t, match).collect())) == [("m", "1"), ("m", "2"), ("n", "1")]
    assert seen[:4] == [(0, "motorway", 3, 2), (0, "surface", 2, 2), (1, "motorway", 1, 2), (1, "surface", 0, 0)]


def test_batches_and_counts(spark):
    rows = [("m", str(i), "01", "36001", f"{i:04x}") for i in range(10)] + [("n", "0", "00", "36003", "ff")]
    t = spark.createDataFrame(rows, "target_map string, target_map_id string, county_region string, county_code string, geoprox_key string")
    b = matching.batched(t, 4)
    got = {(r.target_map, r.target_map_id): r.match_batch_id for r in b.collect()}
    assert got[("n", "0")] == 1 and got[("m", "2")] == 1 and got[("m", "3")] == 2 and got[("m", "9")] == 3
    matches = spark.createDataFrame([("m", "0"), ("m", "0"), ("m", "8")], "target_map string, target_map_id string")
    assert sorted(map(tuple, matching.batch_counts(b, matches).collect())) == [(1, 4, 1, 2), (2, 4, 0, 0), (3, 3, 1, 1)]
    assert [tuple(r) for r in matching.progress(matches).collect()] == [("m", 2)]
    assert [r.target_map_id for r in targets.in_order(t, "36001").collect()] == [str(i) for i in range(10)]
    assert targets.in_order(t).first().target_map == "n"


def test_areas_and_tiles(spark, tmp_path):
    square = lambda x, y, d: [[x, y], [x + d, y], [x + d, y + d], [x, y + d], [x, y]]
    area = {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[square(0, 0, 10), square(4, 4, 2)], [square(20, 0, 5)]]}}
    (tmp_path / "a.json").write_text(json.dumps(area))
    parts = readers.area(spark, f"file://{tmp_path}/a.json")
    assert [len(p) for p in parts] == [2, 1] and len(parts[0][0]) == 4
    lines = {"inside": [(1, 1), (3, 3)], "through the hole": [(1, 5), (9, 5)], "in the hole": [(4.5, 4.5), (5, 5)], "second part": [(21, 1), (22, 2)], "between parts": [(9, 1), (21, 1)], "outside": [(30, 30), (31, 31)]}
    points = lambda ps: [(float(x), float(y)) for x, y in ps]
    df = spark.createDataFrame([(n, points(ps)) for n, ps in lines.items()], "name string, line array<struct<lon:double,lat:double>>")
    assert {r.name for r in df.where(geo.within_area(F.col("line"), parts)).collect()} == {"inside", "second part"}
    dent = [(0, 0), (10, 0), (10, 10), (5, 2), (0, 10)]  # a line over the dent has both ends inside
    cut = spark.createDataFrame([(points([(1, 6), (9, 6)]),), (points([(1, 1), (9, 1)]),)], "line array<struct<lon:double,lat:double>>")
    assert [r[0] for r in cut.select(geo.within(F.col("line"), F.array(*(geo.point(F.lit(x), F.lit(y)) for x, y in dent)))).collect()] == [False, True]
    far = spark.createDataFrame([([(-74.0, 42.0), (-73.5, 42.0)],)], "geometry array<struct<lon:double,lat:double>>")
    none = spark.createDataFrame([], "tile_id string")
    assert sorted(int(r.tile_id.split("-")[1]) for r in readers.missing_tiles(far, none).collect()) == list(range(1206, 1212))


def test_forks_and_their_errors(spark):
    """Walks with forks against a walk of all simple paths; whether groups form chains, by joins and by walking."""
    rng = random.Random(5)
    edges = [(g, f"{g}-{k}", str(rng.randrange(6)), str(rng.randrange(6)), k) for g in range(150) for k in range(rng.randint(1, 6))]
    df = spark.createDataFrame(edges, "grp long, edge_id string, from_node string, to_node string, ordinal int").repartition(3)
    walked = {}
    for r in chains.sorted_chains(df, ["grp"], both_ways=True, all_chains=True).collect():
        walked.setdefault(r.grp, []).append(r)
    joined = {r.grp: r.ok for r in chains.forms_chains(df, ["grp"]).collect()}
    assert joined == {g: rows[0].error is None for g, rows in walked.items()}
    for both in (True, False):
        got = {}
        for r in chains.sorted_chains(df, ["grp"], both_ways=both).collect():
            got.setdefault(r.grp, []).append(r)
        for g, rows in got.items():
            own = [chains.Edge(*e[1:4]) for e in edges if e[0] == g]
            starts = [e for e in own if not any(o.leads_to(e) and not o.opposes(e) for o in own)]

            def paths(chain):
                on = [e for e in own if chain[-1].leads_to(e) and not any(e.id == c.id or e.opposes(c) for c in chain)]
                return [p for e in on for p in paths([*chain, e])] if on else [[c.id for c in chain]]

            all_, most = [p for s in starts for p in paths([s])], 2 if both else 1
            if not starts or len(starts) > most or len(all_) > most:
                assert rows[0].error == (chains.NO_SOURCE if not starts else (chains.MANY_SOURCES_2 if both else chains.MANY_SOURCES_1) if len(starts) > most else chains.MANY_CHAINS_2 if both else chains.MANY_CHAINS_1)
            else:
                ids = {}
                for r in sorted(rows, key=lambda r: r.idx):
                    ids.setdefault(r.chain, []).append(r.edge_id)
                assert all(c in all_ for c in ids.values()) and max(map(len, all_)) in map(len, ids.values())


def test_many_forks_end_early():
    ladder = [chains.Edge(f"{k}{x}", k, k + 1) for k in range(40) for x in "ab"]
    assert chains.sort_edges([chains.Edge("s", -1, 0), *ladder], True) == ([], chains.MANY_CHAINS_2)


def test_output_plans(spark):
    t = spark.createDataFrame([("m", "1", [A, B, C]), ("m", "2", [A, C])], "target_map string, target_map_id string, geometry array<struct<lon:double,lat:double>>")
    m = spark.createDataFrame([("m", "1", [A, B]), ("m", "1", [B, C])], t.schema)
    (left,) = export.unmatched_rows(t, m).collect()
    assert json.loads(left.value)["properties"]["target_map_id"] == "2"
    (lines,) = export.multiline_rows(t, m).collect()
    assert [len(x) for x in json.loads(lines.value)["geometry"]["coordinates"]] == [3, 2, 2]
    for r in export.polygon_rows(t, m).collect():
        ring = json.loads(r.value)["geometry"]["coordinates"][0]
        assert ring[0] == ring[-1]


def test_command_line():
    args = command_line.parser().parse_args(["load-target-map", "ris", "in", "out", "--county", "36001"])
    assert (args.command, args.map, args.county) == ("load-target-map", "ris", "36001")


def test_doubled_and_within(spark):
    df = spark.createDataFrame([([A, B],)], "line array<struct<lon:double,lat:double>>")
    (p,) = df.select(geo.doubled(F.col("line")).alias("d")).collect()
    assert len(p.d) == 3 and abs(p.d[1].lon - (A[0] + B[0]) / 2) < 1e-6
