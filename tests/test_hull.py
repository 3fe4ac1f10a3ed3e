from lanemesh.operators import hull


def area(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))) / 2


def test_grid_and_notch():
    s = 0.0001  # about 8 by 11 m
    grid = [(-73.8 + s * i, 42.6 + s * j) for i in range(6) for j in range(6)]
    (ring,) = hull.concave_hull(grid)
    assert ring[0] == ring[-1] and abs(area([((x + 73.8) / s, (y - 42.6) / s) for x, y in ring]) - 25) < 1e-3
    notched = [p for p in grid if not (p[0] > -73.8 + 1.5 * s and 42.6 + 1.5 * s < p[1] < 42.6 + 3.5 * s)]
    rings = hull.concave_hull(notched, 0.0145)
    assert sum(area([((x + 73.8) / s, (y - 42.6) / s) for x, y in r]) for r in rings) < 25


def test_nothing_to_enclose(spark):
    assert hull.concave_hull([(0.0, 0.0), (1.0, 1.0)]) is None and hull.concave_hull([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]) is None
    s = 0.0001
    df = spark.createDataFrame([("a", [(0.0, 0.0), (s, 0.0), (0.0, s)]), ("b", [(0.0, 0.0)]), ("c", None)], "k string, points array<struct<lon:double,lat:double>>")
    (row,) = hull.hulls(df, ["k"]).collect()
    assert row.k == "a" and len(row.rings[0]) == 4
