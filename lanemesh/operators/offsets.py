"""Linear referencing: vertices with offsets, places along a line, snapping, offsets of OSM ways.

Tables: references (reference_id, geometry, node_ids, way_sections, length_km, vertices) and matches
(reference_id, ..., geometry). Everything is an expression over one row, so nothing is shuffled but
for the join of matches to references on the reference id. Distances along all lines of a batch are
running sums of one Arrow function, in proportion to their vertices.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import EARTH_KM, LENGTH_RATIO, SPLIT_BUFFER_KM
from ..functions import geodesy as geo
from ..functions import scalars

VERTEX = "struct<lon:double,lat:double,node_id:string,poff:double,noff:double>"


def cumulative(lengths: Column) -> Column:
    """Running sums, beginning with 0."""
    return F.aggregate(lengths, F.array(F.lit(0.0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def distances_along(lines: pa.Array) -> pa.Array:
    """For each point of each line its distance from the line's first point, in km."""
    sizes = pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(lines)
    lon, lat = (np.radians(pc.struct_field(flat, c).to_numpy(zero_copy_only=False).astype(np.float64)) for c in ("lon", "lat"))
    step = np.zeros(len(flat))
    if len(flat) > 1:
        h = np.sin((lat[1:] - lat[:-1]) / 2) ** 2 + np.sin((lon[1:] - lon[:-1]) / 2) ** 2 * np.cos(lat[:-1]) * np.cos(lat[1:])
        step[1:] = 2 * EARTH_KM * np.arctan2(np.sqrt(h), np.sqrt(1 - h))
    ends = np.cumsum(sizes)
    begin = ends - sizes
    step[begin[sizes > 0]] = 0.0
    along = np.empty(len(flat))
    for a, b in zip(begin[sizes > 0].tolist(), ends[sizes > 0].tolist()):
        np.cumsum(step[a:b], out=along[a:b])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(along), mask=pc.is_null(lines) if lines.null_count else None)


def distinct_vertices(line: Column) -> Column:
    return scalars.deduped_neighbours(line)


def with_vertices(references: DataFrame) -> DataFrame:
    """Adds node_ids, length_km and vertices; these are null where the numbers of nodes and vertices differ.

    The node of a vertex is the one at its place before adjacent duplicates were dropped. The last
    vertex gets the line's length itself.
    """
    df = references.withColumn("node_ids", scalars.node_sequence(F.col("way_sections"))).withColumn("length_km", geo.length_km(F.col("geometry")))
    df = df.withColumn("__along", distances_along(F.transform("geometry", lambda p: geo.point(p["lon"], p["lat"]))))

    def numbered(x: Column) -> Column:
        every = F.transform(x["line"], lambda p, i: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"), i.alias("i"), F.element_at(x["along"], i + 1).alias("poff")))
        before = lambda i: F.try_element_at(x["line"], F.greatest(i, F.lit(1)).cast("int"))
        return F.filter(every, lambda p, i: (i == 0) | (before(i)["lon"] != p["lon"]) | (before(i)["lat"] != p["lat"]))

    kept = geo.let(F.struct(F.col("geometry").alias("line"), F.col("__along").alias("along")), numbered)

    def finished(x: Column) -> Column:
        last = F.size(x["v"]) - 1

        def vertex(v: Column, i: Column) -> Column:
            poff = F.when((i == last) & (i > 0), x["total"]).otherwise(v["poff"])
            return F.struct(v["lon"].alias("lon"), v["lat"].alias("lat"), F.try_element_at(x["nodes"], v["i"] + 1).alias("node_id"), poff.alias("poff"), (x["total"] - poff).alias("noff"))

        return F.when(x["nodes"].isNotNull() & (F.size(x["nodes"]) == F.size(x["v"])), F.transform(x["v"], vertex))

    return df.withColumn("vertices", geo.let(F.struct(kept.alias("v"), F.col("length_km").alias("total"), F.col("node_ids").alias("nodes")), finished)).drop("__along")


def measured(line: Column) -> Column:
    """A line as an array of (lon, lat, s), s being the distance along it."""
    return geo.let(F.struct(line.alias("p"), cumulative(geo.segment_lengths(line)).alias("s")), lambda x: F.transform(x["p"], lambda p, i: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"), F.element_at(x["s"], i + 1).alias("s"))))


def nearest_km(line: Column, p: Column) -> Column:
    """Distance along the line to its point nearest to p, in a plane tangent at p; ties go to the first."""

    def search(x: Column) -> Column:
        scale = F.cos(F.radians(x["p"]["lat"]))

        def place(i: Column) -> Column:
            a, b = F.element_at(x["m"], i), F.element_at(x["m"], i + 1)
            ax, ay = (a["lon"] - x["p"]["lon"]) * scale, a["lat"] - x["p"]["lat"]
            dx, dy = (b["lon"] - a["lon"]) * scale, b["lat"] - a["lat"]
            ends = F.struct(ax.alias("ax"), ay.alias("ay"), dx.alias("dx"), dy.alias("dy"), a["s"].alias("sa"), b["s"].alias("sb"))

            def foot(e: Column) -> Column:
                span = e["dx"] * e["dx"] + e["dy"] * e["dy"]
                t = F.when(span == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(e["ax"] * e["dx"] + e["ay"] * e["dy"]) / F.nullif(span, F.lit(0.0)))))
                return geo.let(t, lambda t: F.struct((F.pow(e["ax"] + t * e["dx"], 2) + F.pow(e["ay"] + t * e["dy"], 2)).alias("d"), (e["sa"] + t * (e["sb"] - e["sa"])).alias("at")))

            return geo.let(ends, foot)

        return F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size(x["m"]) - 1, F.lit(1))), place))["at"]

    return F.when(F.size(line) >= 2, geo.let(F.struct(measured(line).alias("m"), p.alias("p")), search))


def _along(m: Column, km: Column) -> Column:
    k = F.greatest(F.lit(1), F.least(F.size(m) - 1, F.size(F.filter(m, lambda v: v["s"] <= km))))
    a, b = F.element_at(m, k), F.element_at(m, k + 1)
    inside = geo.destination(a, geo.initial_bearing(a, b), km - a["s"])
    end = lambda v: geo.point(v["lon"], v["lat"])
    return F.when(km <= 0, end(F.element_at(m, 1))).when(km >= F.element_at(m, -1)["s"], end(F.element_at(m, -1))).otherwise(inside)


def point_along(line: Column, km: Column) -> Column:
    """The point at a distance along the line, the ends beyond them."""
    return geo.let(F.struct(measured(line).alias("m"), km.alias("km")), lambda x: _along(x["m"], x["km"]))


def tail(line: Column, km: Column) -> Column:
    """The part of a line from a distance on; null beyond its end."""

    def cut(x: Column) -> Column:
        later = F.transform(F.filter(x["m"], lambda v: v["s"] > x["km"]), lambda v: geo.point(v["lon"], v["lat"]))
        return F.when(x["km"] <= F.element_at(x["m"], -1)["s"], F.concat(F.array(_along(x["m"], x["km"])), later))

    return geo.let(F.struct(measured(line).alias("m"), km.alias("km")), cut)


def _haversine(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray) -> np.ndarray:
    ax, ay, bx, by = map(np.radians, (ax, ay, bx, by))
    h = np.sin((by - ay) / 2) ** 2 + np.sin((bx - ax) / 2) ** 2 * np.cos(ay) * np.cos(by)
    return 2 * EARTH_KM * np.arctan2(np.sqrt(h), np.sqrt(1 - h))


def _lines(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """lon and lat of all points, and of each line its first point's place and its size."""
    size = pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(lines)
    lon, lat = (pc.struct_field(flat, c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("lon", "lat"))
    return lon, lat, np.cumsum(size) - size, size


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts of rows: each item's row, and its number in it."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Running sums, row by row."""
    out = np.empty(len(values))
    ends = np.cumsum(counts)
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        np.cumsum(values[a:b], out=out[a:b])
    return out


def _nearest(steps: tuple[np.ndarray, ...], sums: np.ndarray, counts: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    """nearest_km of lines, each of one step (ax, ay, bx, by) at least; sums: distances along the line to the steps' ends."""
    row, nth = _spread(counts)
    begin = np.cumsum(counts) - counts
    before = np.where(nth == 0, 0.0, np.r_[0.0, sums[:-1]])
    px, py = px[row], py[row]
    scale = np.cos(np.radians(py))
    ax, ay, bx, by = steps
    dx, dy = (bx - ax) * scale, by - ay
    ax, ay = (ax - px) * scale, ay - py
    span = dx * dx + dy * dy
    t = np.where(span == 0, 0.0, np.clip(-(ax * dx + ay * dy) / np.where(span == 0, 1.0, span), 0.0, 1.0))
    d = (ax + t * dx) ** 2 + (ay + t * dy) ** 2
    at = before + t * (sums - before)
    return np.minimum.reduceat(np.where(d == np.minimum.reduceat(d, begin)[row], at, np.inf), begin)


def _destination(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, km: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The point so many km from a on the way to b."""
    lon, la, lb, d = np.radians(bx - ax), np.radians(ay), np.radians(by), km / EARTH_KM
    bearing = np.radians(np.degrees(np.arctan2(np.sin(lon) * np.cos(lb), np.cos(la) * np.sin(lb) - np.sin(la) * np.cos(lb) * np.cos(lon))))
    lat = np.arcsin(np.sin(la) * np.cos(d) + np.cos(la) * np.sin(d) * np.cos(bearing))
    out = np.radians(ax) + np.arctan2(np.sin(bearing) * np.sin(d) * np.cos(la), np.cos(d) - np.sin(la) * np.sin(lat))
    return np.degrees(out), np.degrees(lat)


@F.arrow_udf(T.StructType([T.StructField("poff", T.DoubleType()), T.StructField("end", T.DoubleType())]))
def _found(lines: pa.Array, matches: pa.Array) -> pa.Array:
    """Of each match its start and end along its line; null where the match is to be ignored."""
    many = len(lines)
    x, y, first, size = _lines(lines)
    mx, my, mfirst, msize = _lines(matches)
    poff, end = np.zeros(many), np.zeros(many)
    good = np.flatnonzero((size >= 2) & (msize >= 1))
    with np.errstate(all="ignore"):
        if len(good):
            first, size, mfirst, msize = first[good], size[good], mfirst[good], msize[good]
            row, nth = _spread(size - 1)
            a = first[row] + nth
            steps = (x[a], y[a], x[a + 1], y[a + 1])
            length = _haversine(*steps)
            sums = _sums(length, size - 1)
            begin = np.cumsum(size - 1) - (size - 1)
            s = _nearest(steps, sums, size - 1, mx[mfirst], my[mfirst])
            mrow, mnth = _spread(msize - 1)
            m = mfirst[mrow] + mnth
            start = s + np.bincount(mrow, _haversine(mx[m], my[m], mx[m + 1], my[m + 1]), len(good)) / 2

            # The rest of each line: the point at `start`, which lies in step k, and the vertices behind it.
            total = sums[begin + size - 2]
            passed = 1 + np.add.reduceat((sums <= start[row]).astype(np.int64), begin)
            k = begin + np.minimum(passed, size - 1) - 1
            behind = np.where(k > begin, sums[k - 1], 0.0)
            px, py = _destination(*(c[k] for c in steps), start - behind)
            px, py = np.where(start <= 0, steps[0][begin], px), np.where(start <= 0, steps[1][begin], py)
            left = size - passed
            stop = start.copy()
            some = np.flatnonzero(left > 0)
            if len(some):
                rrow, rnth = _spread(left[some])
                b = begin[some][rrow] + passed[some][rrow] - 1 + rnth
                rest = (np.where(rnth == 0, px[some][rrow], steps[0][b]), np.where(rnth == 0, py[some][rrow], steps[1][b]), steps[2][b], steps[3][b])
                tail_sums = _sums(_haversine(*rest), left[some])
                final = (mfirst + msize - 1)[some]
                stop[some] += _nearest(rest, tail_sums, left[some], mx[final], my[final])
            off = np.where(s > SPLIT_BUFFER_KM, s, 0.0)
            fits = (start <= total) & (s <= stop) & (stop - off > SPLIT_BUFFER_KM) & np.isfinite(stop)
            poff[good[fits]], end[good[fits]] = off[fits], stop[fits]
            good = good[fits]
    gone = np.ones(many, bool)
    gone[good] = False
    return pa.StructArray.from_arrays([pa.array(poff), pa.array(end)], names=["poff", "end"], mask=pa.array(gone))


def raw_offsets(df: DataFrame) -> DataFrame:
    """df: match_geometry, geometry, length_km. Adds raw = (poff, noff), null for matches to be ignored.

    The end is sought from half a match's length behind its start, so that loops are told apart. One Arrow
    function does it for a batch: as expressions, what follows would be worked out again wherever it is used.
    """
    line = lambda c: F.transform(c, lambda p: geo.point(p["lon"], p["lat"]))
    df = df.withColumn("__found", _found(line("geometry"), line("match_geometry")))
    found = F.struct(F.col("__found.poff").alias("poff"), (F.col("length_km") - F.col("__found.end")).alias("noff"))
    return df.withColumn("raw", F.when(F.col("__found").isNotNull(), found)).drop("__found")


def nearest_vertex(vertices: Column, field: str, at: Column, backward: bool) -> Column:
    """POFF of the nearest vertex but the first, if within half the buffer; ties go to the one met first."""
    inner = F.slice(vertices, 2, F.greatest(F.size(vertices) - 1, F.lit(0)))
    each = F.transform(inner, lambda v, i: F.struct(F.abs(v[field] - at).alias("d"), (-i if backward else i).alias("i"), v["poff"].alias("poff")))
    return geo.let(F.array_min(each), lambda best: F.when(best["d"] <= SPLIT_BUFFER_KM / 2, best["poff"]))


@F.arrow_udf(T.DoubleType())
def _snapped_end(vertices: pa.Array, poff: pa.Array, noff: pa.Array, total: pa.Array) -> pa.Array:
    """A match's end, snapped; null without offsets or vertices, or where what lies between the snapped ends is too short."""
    po, no, total = (c.to_numpy(zero_copy_only=False).astype(np.float64) for c in (poff, noff, total))
    size = pc.fill_null(pc.list_value_length(vertices), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(vertices)
    vp, vn = (pc.struct_field(flat, c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("poff", "noff"))
    start, end = po.copy(), total - no
    # As nearest_vertex: all vertices but the first, of equally near ones the first met from the match's side.
    some = np.flatnonzero(size > 1)
    with np.errstate(all="ignore"):
        if len(some):
            row, nth = _spread(size[some] - 1)
            begin = np.cumsum(size[some] - 1) - (size[some] - 1)
            at = (np.cumsum(size) - size)[some][row] + 1 + nth
            for field, want, out, pick, none in ((vp, po, start, np.minimum, len(vp)), (vn, no, end, np.maximum, -1)):
                d = np.abs(field[at] - want[some][row])
                least = np.minimum.reduceat(d, begin)
                best = pick.reduceat(np.where(d == least[row], at, none), begin)
                near = least <= SPLIT_BUFFER_KM / 2
                out[some[near]] = vp[best[near]]
        start, end = np.where(po <= SPLIT_BUFFER_KM, 0.0, start), np.where(no <= SPLIT_BUFFER_KM, total, end)
        keep = (end - start >= SPLIT_BUFFER_KM) | ((end - start) / total >= LENGTH_RATIO)
    keep &= vertices.is_valid().to_numpy(zero_copy_only=False) & ~np.isnan(po)
    return pa.array(end, mask=~keep)


def snapped(df: DataFrame) -> DataFrame:
    """df: raw, vertices, length_km. Adds start_dist and end_dist; both null where the match is to be dropped.

    The snapped start only decides about dropping: what is kept is the raw one.
    """
    df = df.withColumn("end_dist", _snapped_end("vertices", "raw.poff", "raw.noff", "length_km"))
    return df.withColumn("start_dist", F.when(F.col("end_dist").isNotNull(), F.col("raw.poff")))


def match_intervals(references: DataFrame, matches: DataFrame) -> DataFrame:
    """Matches with start_dist and end_dist along their reference; those to be dropped are gone."""
    refs = references.select("reference_id", "geometry", "length_km", "vertices")
    joined = matches.withColumnRenamed("geometry", "match_geometry").join(refs, "reference_id")
    return snapped(raw_offsets(joined)).where("start_dist is not null").drop("raw", "vertices", "geometry", "match_geometry")


def osm_intervals(references: DataFrame) -> DataFrame:
    """An interval for each way section of a reference.

    Sections share their end nodes, so a section's vertices begin where the ones before end; counting
    nodes finds them also where a loop repeats one.
    """
    df = references.where("vertices is not null and way_sections is not null")
    sizes = F.transform("way_sections", lambda w: F.size(scalars.deduped_neighbours(w["nodeIds"])) - 1)
    df = df.withColumn("steps", F.aggregate(sizes, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))))
    at = F.posexplode("way_sections").alias("k", "w")
    df = df.select("reference_id", "vertices", "steps", "direction", at)
    begin, end = (F.try_element_at("vertices", (F.element_at("steps", (F.col("k") + d).cast("int")) + 1).cast("int")) for d in (1, 2))
    return df.select(
        "reference_id", F.lit("osm").alias("target_map"), F.col("w.wayId").alias("target_map_id"),
        scalars.osm_match_id(F.col("w.wayId"), F.col("direction")).alias("matched_id"), F.lit(True).alias("is_primary"),
        scalars.road_class_rank(F.col("w.roadClass")).cast("double").alias("rank"), F.col("w.oneWay").alias("one_way"),
        begin["poff"].alias("start_dist"), end["poff"].alias("end_dist"), F.col("k").alias("ordinal"),
    ).where("start_dist < end_dist")
