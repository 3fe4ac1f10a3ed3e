"""Concave hulls of small point sets: a Delaunay triangulation less the triangles with long edges.

There is no such expression in Spark, so rows go through Arrow; a row's points are those of one road
feature and its match.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import EARTH_KM

Point = tuple[float, float]
MAX_EDGE_KM = 0.03
RINGS = pa.list_(pa.list_(pa.struct([("lon", pa.float64()), ("lat", pa.float64())])))


def km(a: Point, b: Point) -> float:
    dx = math.radians(b[0] - a[0]) * math.cos(math.radians((a[1] + b[1]) / 2))
    return EARTH_KM * math.hypot(dx, math.radians(b[1] - a[1]))


def circumcircle(a: Point, b: Point, c: Point) -> tuple[float, float, float] | None:
    """Centre and squared radius; None for points on a line."""
    d = 2 * (a[0] * (b[1] - c[1]) + b[0] * (c[1] - a[1]) + c[0] * (a[1] - b[1]))
    if abs(d) < 1e-18:
        return None
    aa, bb, cc = (p[0] ** 2 + p[1] ** 2 for p in (a, b, c))
    x = (aa * (b[1] - c[1]) + bb * (c[1] - a[1]) + cc * (a[1] - b[1])) / d
    y = (aa * (c[0] - b[0]) + bb * (a[0] - c[0]) + cc * (b[0] - a[0])) / d
    return x, y, (a[0] - x) ** 2 + (a[1] - y) ** 2


def triangles(points: list[Point]) -> list[tuple[int, int, int]]:
    """Delaunay triangles by inserting points one at a time."""
    n = len(points)
    cx, cy = sum(p[0] for p in points) / n, sum(p[1] for p in points) / n
    far = 50 * max(max(abs(p[0] - cx), abs(p[1] - cy)) for p in points) + 1e-9
    # Moved to the middle, so that squares don't lose digits.
    all_ = [(p[0] - cx, p[1] - cy) for p in points] + [(-far, -far), (far, -far), (0.0, far)]
    have = {(n, n + 1, n + 2): circumcircle(*all_[n:])}
    for i, p in enumerate(all_[:n]):
        bad = [t for t, c in have.items() if c and (p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2 < c[2]]
        rim = Counter(tuple(sorted(e)) for t in bad for e in ((t[0], t[1]), (t[1], t[2]), (t[2], t[0])))
        for t in bad:
            del have[t]
        for (u, v), times in rim.items():
            if times == 1 and (c := circumcircle(all_[u], all_[v], p)):
                have[u, v, i] = c
    return [t for t in have if max(t) < n]


def concave_hull(points: list[Point], max_edge_km: float = MAX_EDGE_KM) -> list[list[Point]] | None:
    """Closed rings around the triangles whose edges are all short enough; None if there are none."""
    unique = list(dict.fromkeys(points))
    if len(unique) < 3:
        return None
    keep = [t for t in triangles(unique) if all(km(unique[a], unique[b]) <= max_edge_km for a, b in ((t[0], t[1]), (t[1], t[2]), (t[2], t[0])))]
    rim = Counter(tuple(sorted(e)) for t in keep for e in ((t[0], t[1]), (t[1], t[2]), (t[2], t[0])))
    nexts: dict[int, list[int]] = {}
    for (u, v), times in sorted(rim.items()):
        if times == 1:
            nexts.setdefault(u, []).append(v)
            nexts.setdefault(v, []).append(u)
    rings = []
    while nexts:
        start = min(nexts)
        ring, at = [start], start
        while nexts.get(at):
            to = nexts[at].pop()
            nexts[to].remove(at)
            ring.append(to)
            at = to
            if at == start:
                break
        nexts = {k: v for k, v in nexts.items() if v}
        rings.append([unique[k] for k in ring])
    return rings or None


def hulls(df: DataFrame, keys: list[str], points: str = "points", max_edge_km: float = MAX_EDGE_KM) -> DataFrame:
    """keys, rings (array of arrays of points): rows without a hull are left out."""
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [concave_hull(list(zip(x, y)), max_edge_km) if x else None for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            rings = [r and [[{"lon": p[0], "lat": p[1]} for p in ring] for ring in r] for r in found]
            out = pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(rings, RINGS)], names=[*keys, "rings"])
            yield out.filter(pa.array([r is not None for r in found]))

    flat = df.select(*keys, F.transform(points, lambda p: p["lon"]).alias("x"), F.transform(points, lambda p: p["lat"]).alias("y"))
    return flat.mapInArrow(run, f"{kinds}, rings array<array<struct<lon:double,lat:double>>>")
