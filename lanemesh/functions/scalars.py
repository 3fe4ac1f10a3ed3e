"""Scalar rules of the target maps as Column expressions. Names follow the table they are applied to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EASTBOUND, FOLLOWS_BEARING_DEGREES, NORTHBOUND, NPMRDS_DIRECTIONS, RIS_DIRECTIONS, ROAD_CLASSES, SOUTHBOUND, UNDEFINED_RANK, WESTBOUND


def lookup(table: dict, key: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[key]


def is_something(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def num_or_null(c: Column) -> Column:
    """A finite number or null; blank text counts as 0."""
    x = F.when(F.trim(c) == "", F.lit(0.0)).otherwise(c.try_cast("double"))
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def county_name(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"\.", ""), r"\s+", "_")


def upper_words(c: Column) -> Column:
    """Words in upper case, split at anything that is neither letter nor digit."""
    return F.trim(F.regexp_replace(F.upper(c), r"[^A-Z0-9]+", " "))


def npmrds_direction(c: Column) -> Column:
    return lookup(NPMRDS_DIRECTIONS, upper_words(c))


def ris_direction(c: Column) -> Column:
    return lookup(RIS_DIRECTIONS, upper_words(c))


def pad_left(c: Column, width: int, fill: str = "0") -> Column:
    """Pads but never shortens."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, fill))


def npmrds_meso_id(tmc: Column, tmclinear: Column, lineartmc: Column, county: Column) -> Column:
    """County and linear code; without one, the linear TMC less its first run of the TMC's prefix and zeros."""
    made = F.regexp_replace(lineartmc, F.concat(F.lit("^(.*?)"), F.substring(tmc, 1, 3), F.lit("0*")), F.lit("$1"))
    linear = F.when(is_something(tmclinear), tmclinear).when(is_something(lineartmc), made)
    return F.when(is_something(linear), F.concat(county, F.lit("|"), linear))


def npmrds_macro_id(region: Column, road: Column) -> Column:
    return F.when(is_something(road), F.concat(region, F.lit("|"), road))


def npmrds_mega_id(road: Column) -> Column:
    return F.when(is_something(road), road)


def npmrds_is_primary(c: Column) -> Column:
    return F.when(is_something(c), F.coalesce(num_or_null(c) != 0, F.lit(False))).otherwise(F.lit(True))


def npmrds_rank(f_system: Column) -> Column:
    return F.when(is_something(f_system), num_or_null(f_system)).otherwise(F.lit(float(UNDEFINED_RANK)))


def ris_is_primary(overlap: Column) -> Column:
    return ~F.coalesce(num_or_null(overlap) > 1, F.lit(False))


def ris_rank(functional: Column, missing: Column | None = None) -> Column:
    """The last digit of the class; null counts as 0, text that is no number as undefined. `missing`: the key was absent."""
    x = F.coalesce(num_or_null(F.coalesce(functional, F.lit("0"))) % 10, F.lit(float(UNDEFINED_RANK)))
    return x if missing is None else F.when(missing, F.lit(float(UNDEFINED_RANK))).otherwise(x)


def road_class_rank(c: Column) -> Column:
    return F.coalesce(lookup(ROAD_CLASSES, c), F.lit(ROAD_CLASSES["Other"]))


def network_level(osm_rank: Column, one_way: Column) -> Column:
    return F.coalesce(osm_rank.cast("double") + F.when(F.coalesce(one_way, F.lit(False)), 0.5).otherwise(0.0), F.lit(8.0))


def micro_direction(bearing: Column, compat: bool = True) -> Column:
    """Direction of travel of a bearing. compat: all that isn't northbound counts as eastbound."""
    north = (bearing <= 45) | (bearing > 315)
    if compat:
        return F.when(bearing.isNotNull(), F.when(north, NORTHBOUND).otherwise(EASTBOUND))
    return F.when(bearing.isNotNull(), F.when(north, NORTHBOUND).when(bearing <= 135, EASTBOUND).when(bearing <= 225, SOUTHBOUND).otherwise(WESTBOUND))


def mega_direction(bearing: Column, north_south: Column) -> Column:
    """Along a road's main axis. A missing bearing is in no range, so it falls to the last one."""
    ns = F.when((bearing <= 90) | (bearing > 270), NORTHBOUND).otherwise(SOUTHBOUND)
    ew = F.when(bearing <= 180, EASTBOUND).otherwise(WESTBOUND)
    return F.when(F.coalesce(north_south, F.lit(False)), ns).otherwise(ew)


def fallback_meso_bearing(target_micro: Column, matched_micro: Column, target_meso: Column) -> Column:
    """The target's bearing or its reverse, by the plain (not circular) difference of micro bearings."""
    follows = F.abs(target_micro - matched_micro) < FOLLOWS_BEARING_DEGREES
    return F.when(target_micro.isNotNull() & matched_micro.isNotNull(), F.when(follows, target_meso).otherwise((target_meso + 180) % 360))


def sorted_match_id(proto_id: Column, idx: Column, chain_length: Column) -> Column:
    """Index padded to the digits of the chain's last index."""
    width = F.length((chain_length - 1).cast("string"))
    return F.concat(proto_id, F.lit("|"), F.lpad(idx.cast("string"), width, F.lit("0")))


def unsorted_match_id(target_id: Column, idx: Column, n: Column) -> Column:
    """Index in letters, A for 0 to J for 9."""
    width = F.length((n - 1).cast("string"))
    return F.concat(target_id, F.lit("!"), F.translate(F.lpad(idx.cast("string"), width, F.lit("0")), "0123456789", "ABCDEFGHIJ"))


def micro_id(target_id: Column, meso_idx: Column, direction: Column) -> Column:
    return F.concat(target_id, F.when(meso_idx.isNull(), "!").otherwise("|"), direction.cast("string"))


def osm_match_id(way_id: Column, direction: Column) -> Column:
    return F.concat(way_id.cast("string"), F.lit("!"), direction.cast("string"))


def id_stem(matched_id: Column) -> Column:
    """What stands before the first | or !"""
    return F.split(matched_id, r"[|!]")[0]


def map_label(target_map: str) -> str:
    return target_map.replace("npmrds_20", "tmc").replace("ris_20", "ris")


def split_label(index: Column, total: Column) -> Column:
    return F.concat_ws(":", index.cast("string"), total.cast("string"))


def xml_safe(c: Column) -> Column:
    return F.translate(c, '<>&"', "")


def shown_at_zoom(level: Column, zoom: Column) -> Column:
    """Network levels a map tile of a zoom shows."""
    rules = ((3, 1), (10, 2), (12, 3), (13, 5))
    return reduce(lambda acc, r: acc | ((zoom >= r[0]) & (level <= r[1])), rules, (level < 1) | (zoom >= 13))


def deduped_neighbours(a: Column) -> Column:
    """An array without elements equal to the one before."""
    return F.filter(a, lambda x, i: (i == 0) | ~x.eqNullSafe(F.try_element_at(a, F.greatest(i, F.lit(1)).cast("int"))))


def node_sequence(way_sections: Column) -> Column:
    return deduped_neighbours(F.flatten(F.transform(way_sections, lambda w: w["nodeIds"])))


def hstore(c: Column) -> Column:
    """`"k"=>"v", ...` to a map."""
    return F.str_to_map(F.replace(c, F.lit('"'), F.lit("")), F.lit(", "), F.lit("=>"))


def tile_parts(name: Column) -> tuple[Column, Column]:
    """Tile id and record kind of a tile's file name, as in `12-1207-1539.geometry.8.pbf`."""
    pattern = r"([0-9]+-[0-9]+-[0-9]+)\.([a-z]+)\."
    return F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)


def merged_struct(base: dict[str, Column], patch: dict[str, Column]) -> Column:
    """A merge patch over typed fields: a patch's value wins, a null one leaves the field null or as it was absent."""
    names = list(dict.fromkeys([*base, *patch]))
    return F.struct(*(F.coalesce(patch[n], base[n]).alias(n) if n in patch and n in base else (patch.get(n, base.get(n))).alias(n) for n in names))
