"""What the second round found: long chains, many small groups, lines read once, keys past a million, ends on tile borders."""

import collections
import datetime
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lanemesh.functions import geodesy as geo
from lanemesh.operators import chains, offsets, overlaps
from lanemesh.plan_queries import QUERIES as PLAN_QUERIES
from lanemesh.queries import ORACLES, QUERIES


def equals_sql(spark, tmp_path, name, table, rows, kinds):
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    want = con.sql(ORACLES[name]).df()
    got = QUERIES[name](spark, str(tmp_path)).toPandas()[list(want.columns)]
    plain = lambda df: sorted(map(tuple, df.astype(object).values.tolist()))
    assert plain(got) == plain(want)
    return got


def test_chains_longer_than_recursion_allows(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at, 1) for i in range(300)] + [(1000 + i, at, 2) for i in range(2)] + [(2000, at, 3)]
    got = equals_sql(spark, tmp_path, "chains_recursive", "events", rows, "event_id long, ts timestamp, user_id long")
    assert len(got) == 300 and got["idx"].max() == 298


def test_chains_rings_and_merges(spark, monkeypatch):
    monkeypatch.setattr(chains, "RING_CHECK", 2)
    kinds = "grp int, edge_id string, from_node string, to_node string"
    ring = [(1, "a", "x", "y"), (1, "b", "y", "z"), (1, "c", "z", "x")]
    merged = [(2, "a", "p", "r"), (2, "b", "q", "r"), (2, "c", "r", "s"), (2, "d", "s", "t"), (3, "a", None, "u"), (3, "b", "u", None)]
    got = sorted(map(tuple, chains.simple_chains(spark.createDataFrame(ring + merged, kinds)).collect()))
    assert got == [(2, "a", 0), (2, "b", 0), (2, "c", 1), (2, "c", 1), (2, "d", 2), (2, "d", 2), (3, "a", 0), (3, "b", 1)]
    with pytest.raises(ValueError):
        chains.simple_chains(spark.createDataFrame([*ring, (1, "s", "w", "x")], kinds)).collect()


def test_overlaps_of_many_groups_in_one_call(spark):
    draw = random.Random(5)
    at = lambda: draw.randrange(60) / 100
    # One reference has many intervals, most have few; some have no map, and a map can come without a reference.
    refs = [None if n % 50 == 7 else n // 3 if n % 4 else 0 for n in range(600)]
    rows = [(r, draw.choice(["a", "b", None]), draw.choice([*range(9), None]), n, f"x{n}", at(), at()) for n, r in enumerate(refs)]
    df = spark.createDataFrame(rows, "reference_id long, target_map string, rank int, n int, tag string, start_dist double, end_dist double")
    groups = collections.defaultdict(list)
    for r in rows:
        if r[5] < r[6]:
            groups[r[:2]].append(r)
    want = []
    for g in groups.values():
        g.sort(key=lambda r: (r[2] is None, r[2] or 0, r[3]))
        want += [(*g[i][:5], a, b) for i, a, b in overlaps.fold([r[5:] for r in g], 0.02)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        out = overlaps.resolve(df, ["rank", "n"], 0.02)
        got = list(map(tuple, out.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert "FlatMapGroups" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert overlaps.resolve(df.where("n < 0"), ["n"]).count() == 0


def test_target_intervals_measure_each_line_once(spark):
    out = PLAN_QUERIES["target_intervals"](spark, "/root/testdata/sf0.001")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("ATAN2(") < 10


def test_matches_without_points_are_ignored(spark):
    road = [(i / 1000, 42.0) for i in range(4)]
    cases = {"whole": road, "later": road[1:3], "reversed": road[::-1], "one point": road[:1], "none": [], "null": None, "no numbers": [(None, None), (None, None)]}
    df = spark.createDataFrame([(n, road, m) for n, m in cases.items()], "name string, geometry array<struct<lon:double,lat:double>>, match_geometry array<struct<lon:double,lat:double>>")
    far = spark.createDataFrame([("no line", None, road), ("a point", road[:1], road)], df.schema)
    df = df.unionByName(far).withColumn("length_km", geo.length_km(F.col("geometry"))).coalesce(1)
    got = {r["name"]: r["raw"] and tuple(round(v / r["length_km"], 4) for v in r["raw"]) for r in offsets.raw_offsets(df).collect()}
    assert got == {"whole": (0, 0), "later": (0.3333, 0.3333)} | dict.fromkeys(["reversed", "one point", "none", "null", "no numbers", "no line", "a point"])


def test_longest_with_order_keys_past_a_million(spark, tmp_path):
    rows = [(5, 1, 1, 50.0, 2_000_000), (5, 2, 1, 49.0, 100), (6, 1, 1, 3.0, 7), (6, 1, 2, 3.0, 7), (6, 2, 1, 2.0, 1), (7, 1, 1, 4.0, 9_000_000)]
    equals_sql(spark, tmp_path, "geometry_merge_longest", "lineitem", rows, "l_partkey long, l_linenumber int, l_suppkey long, l_quantity double, l_orderkey long")


def test_tiles_of_lines_that_end_on_a_border(spark, tmp_path):
    on_border = [k for k in range(700_000) if k * 7919 % 700_000 % 140_625 == 25_000]
    keys = sorted({k + d for k in on_border for d in (-1, 0)})
    assert len(on_border) == 5
    equals_sql(spark, tmp_path, "tile_cover", "customer", [(k,) for k in keys], "c_custkey long")
