"""Geometry on the sphere as Column expressions. A line is an array of structs (lon, lat) in degrees."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EARTH_KM, MILES_PER_KM


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def distance_km(a: Column, b: Column) -> Column:
    """Great-circle distance by haversines."""
    lat = F.radians(b["lat"] - a["lat"]) / 2
    lon = F.radians(b["lon"] - a["lon"]) / 2
    h = F.pow(F.sin(lat), 2) + F.pow(F.sin(lon), 2) * F.cos(F.radians(a["lat"])) * F.cos(F.radians(b["lat"]))
    return 2 * EARTH_KM * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def initial_bearing(a: Column, b: Column) -> Column:
    lon, la, lb = F.radians(b["lon"] - a["lon"]), F.radians(a["lat"]), F.radians(b["lat"])
    return F.degrees(F.atan2(F.sin(lon) * F.cos(lb), F.cos(la) * F.sin(lb) - F.sin(la) * F.cos(lb) * F.cos(lon)))


def final_bearing(a: Column, b: Column) -> Column:
    """Direction of arrival, 0 to 360."""
    return (initial_bearing(b, a) + 180) % 360


def first(line: Column) -> Column:
    return F.try_element_at(line, F.lit(1))


def last(line: Column) -> Column:
    return F.try_element_at(line, F.lit(-1))


def line_bearing(line: Column) -> Column:
    return F.round(final_bearing(first(line), last(line))).cast("int")


def segment_lengths(line: Column) -> Column:
    """Length of each step of a line, in km."""
    return F.transform(F.arrays_zip(F.slice(line, 1, F.greatest(F.size(line) - 1, F.lit(0))).alias("a"), F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0))).alias("b")), lambda s: distance_km(s["a"], s["b"]))


def length_km(line: Column) -> Column:
    return F.when(line.isNotNull(), F.aggregate(segment_lengths(line), F.lit(0.0), lambda acc, x: acc + x))


def length_miles(line: Column) -> Column:
    return length_km(line) * MILES_PER_KM


def from_lonlats(flat: Column) -> Column:
    """Pairs of a flat array lon, lat, lon, lat, ..."""
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size(flat) / 2).cast("int") - 1), lambda i: point(flat[i * 2], flat[i * 2 + 1]))
    return F.when(F.size(flat) >= 2, pairs).otherwise(F.array().cast("array<struct<lon:double,lat:double>>"))


def reversed_line(line: Column) -> Column:
    return F.reverse(line)


def midpoint(a: Column, b: Column) -> Column:
    """Half way on the great circle."""
    la, lb, lon = F.radians(a["lat"]), F.radians(b["lat"]), F.radians(b["lon"] - a["lon"])
    x, y = F.cos(lb) * F.cos(lon), F.cos(lb) * F.sin(lon)
    lat = F.atan2(F.sin(la) + F.sin(lb), F.sqrt(F.pow(F.cos(la) + x, 2) + F.pow(y, 2)))
    return point(a["lon"] + F.degrees(F.atan2(y, F.cos(la) + x)), F.degrees(lat))


def doubled(line: Column) -> Column:
    """The line with a midpoint in every step."""
    steps = F.transform(line, lambda p, i: F.when(i == 0, F.array(p)).otherwise(F.array(midpoint(F.try_element_at(line, F.greatest(i, F.lit(1)).cast("int")), p), p)))
    return F.flatten(steps)


def destination(a: Column, bearing: Column, km: Column) -> Column:
    d, b, la = km / EARTH_KM, F.radians(bearing), F.radians(a["lat"])
    lat = F.asin(F.sin(la) * F.cos(d) + F.cos(la) * F.sin(d) * F.cos(b))
    lon = F.radians(a["lon"]) + F.atan2(F.sin(b) * F.sin(d) * F.cos(la), F.cos(d) - F.sin(la) * F.sin(lat))
    return point(F.degrees(lon), F.degrees(lat))


def bbox(line: Column) -> Column:
    lons, lats = F.transform(line, lambda p: p["lon"]), F.transform(line, lambda p: p["lat"])
    return F.struct(F.array_min(lons).alias("west"), F.array_min(lats).alias("south"), F.array_max(lons).alias("east"), F.array_max(lats).alias("north"))


def north_south(box: Column) -> Column:
    """Is the box taller than wide, on the ground?"""
    tall = distance_km(point(box["west"], box["south"]), point(box["west"], box["north"]))
    wide = distance_km(point(box["west"], box["south"]), point(box["east"], box["south"]))
    return tall > wide


def geoprox_key(line: Column) -> Column:
    """Hexadecimal digits of the first point's scaled lon and lat in turn; a lat that is too short gives zeros."""
    digits = lambda x: F.lower(F.hex(F.floor(F.abs(x * 100000) + 0.5).cast("long")))

    def turns(d: Column) -> Column:
        lat = F.rpad(d["lat"], F.greatest(F.length(d["lon"]), F.length(d["lat"])), F.lit("0"))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(d["lon"])), lambda i: F.concat(F.substr(d["lon"], i, F.lit(1)), F.substr(lat, i, F.lit(1)))), "")

    return let(F.struct(digits(first(line)["lon"]).alias("lon"), digits(first(line)["lat"]).alias("lat")), turns)


def node_key(p: Column, decimals: int) -> Column:
    return F.concat_ws("|", F.round(p["lon"], decimals).cast("string"), F.round(p["lat"], decimals).cast("string"))


def tile_of(p: Column, zoom: int = 12) -> Column:
    """Web-Mercator tile `z-x-y` of a point."""
    n = float(1 << zoom)
    x = F.floor((p["lon"] + 180) / 360 * n)
    lat = F.radians(p["lat"])
    y = F.floor((1 - F.log(F.tan(lat) + 1 / F.cos(lat)) / math.pi) / 2 * n)
    return F.concat_ws("-", F.lit(str(zoom)), x.cast("string"), y.cast("string"))


def tiles_of(line: Column, zoom: int = 12) -> Column:
    """The Web-Mercator tiles that a line passes through, as `z-x-y`, each once.

    Between the places where a step crosses the grid it is in one tile, which its middle there tells. A tile that
    a step's end only touches isn't passed through.
    """
    n = float(1 << zoom)

    def placed(p: Column) -> Column:
        lat = F.radians(p["lat"])
        return F.struct(((p["lon"] + 180) / 360 * n).alias("x"), ((1 - F.log(F.tan(lat) + 1 / F.cos(lat)) / math.pi) / 2 * n).alias("y"))

    def crossings(a: Column, b: Column) -> Column:
        low, high = F.ceil(F.least(a, b)), F.floor(F.greatest(a, b))
        at = F.transform(F.sequence(low, F.greatest(low, high)), lambda k: (k - a) / F.nullif(b - a, F.lit(0.0)))
        return F.when((low <= high) & (a != b), at).otherwise(F.array().cast("array<double>"))

    def of_step(s: Column) -> Column:
        a, b = s["a"], s["b"]
        cuts = F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), crossings(a["x"], b["x"]), crossings(a["y"], b["y"])))
        middles = let(cuts, lambda c: F.transform(F.filter(F.arrays_zip(c.alias("t"), F.slice(c, 2, F.size(c)).alias("u")), lambda z: z["t"] < z["u"]), lambda z: (z["t"] + z["u"]) / 2))
        name = lambda x, y: F.concat_ws("-", F.lit(str(zoom)), F.floor(x).cast("string"), F.floor(y).cast("string"))
        return F.transform(middles, lambda t: name(a["x"] + t * (b["x"] - a["x"]), a["y"] + t * (b["y"] - a["y"])))

    grid = F.transform(line, placed)
    steps = lambda g: F.arrays_zip(g.alias("a"), F.slice(g, 2, F.size(g)).alias("b"))
    return let(grid, lambda g: F.array_distinct(F.flatten(F.transform(F.filter(steps(g), lambda s: s["b"].isNotNull()), of_step))))


def in_ring(p: Column, ring: Column) -> Column:
    """Ray casting: does a ray eastward cross the ring an odd number of times?"""
    n = F.size(ring)
    cross = lambda q, i: ((q["lat"] > p["lat"]) != (F.element_at(ring, ((i + 1) % n + 1).cast("int"))["lat"] > p["lat"])) & (
        p["lon"] < (F.element_at(ring, ((i + 1) % n + 1).cast("int"))["lon"] - q["lon"]) * (p["lat"] - q["lat"]) / (F.element_at(ring, ((i + 1) % n + 1).cast("int"))["lat"] - q["lat"]) + q["lon"]
    )
    return F.size(F.filter(ring, cross)) % 2 == 1


def crosses(line: Column, ring: Column) -> Column:
    """Does a step of the line cut through a side of the ring?"""
    side = lambda a, b, p: F.signum((b["lon"] - a["lon"]) * (p["lat"] - a["lat"]) - (b["lat"] - a["lat"]) * (p["lon"] - a["lon"]))
    n = F.size(ring)

    def cut(a: Column, b: Column) -> Column:
        def by(p: Column, i: Column) -> Column:
            q = F.element_at(ring, ((i + 1) % n + 1).cast("int"))
            return (side(a, b, p) * side(a, b, q) < 0) & (side(p, q, a) * side(p, q, b) < 0)

        return F.size(F.filter(ring, by)) > 0

    steps = F.arrays_zip(F.slice(line, 1, F.greatest(F.size(line) - 1, F.lit(0))).alias("a"), F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0))).alias("b"))
    return F.exists(steps, lambda s: cut(s["a"], s["b"]))


def within(line: Column, ring: Column) -> Column:
    """The whole line inside the ring: its points, and no step through a side. The boxes are compared first."""
    a, b = bbox(line), bbox(ring)
    inside = (a["west"] >= b["west"]) & (a["east"] <= b["east"]) & (a["south"] >= b["south"]) & (a["north"] <= b["north"])
    return inside & F.forall(line, lambda p: in_ring(p, ring)) & ~crosses(line, ring)


def meets(line: Column, ring: Column) -> Column:
    """Is a point of the line inside the ring, or does a step cut through it?"""
    return F.exists(line, lambda p: in_ring(p, ring)) | crosses(line, ring)


def within_area(line: Column, area: list[list[list[tuple[float, float]]]]) -> Column:
    """The line inside one of the area's parts, each a ring and the rings of its holes."""
    rings = lambda part: [F.array(*(point(F.lit(x), F.lit(y)) for x, y in r)) for r in part]
    found = F.lit(False)
    for part in area:
        outer, *holes = rings(part)
        clear = within(line, outer)
        for hole in holes:
            clear = clear & ~meets(line, hole)
        found = found | clear
    return found
