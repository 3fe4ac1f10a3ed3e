"""Types of the tables that plans exchange."""

from __future__ import annotations

POINT = "struct<lon:double,lat:double>"
LINE = f"array<{POINT}>"

WAY_SECTION = "struct<wayId:string,nodeIds:array<string>,roadClass:string,oneWay:boolean,roundabout:boolean,link:boolean,name:string>"
OSM_METADATA = f"struct<name:string,waySections:array<{WAY_SECTION}>>"

#: What GeoJSON features of the two target maps hold; all attributes are read as text and coerced later.
NPMRDS_TEXT = ("tmc", "tmclinear", "lineartmc", "roadnumber", "county", "direction")
NPMRDS_NUMBERS = (
    "start_latitude", "start_longitude", "end_latitude", "end_longitude", "road_order", "f_system", "faciltype", "structype", "thrulanes", "route_numb", "route_sign",
    "route_qual", "aadt", "aadt_singl", "aadt_combi", "nhs", "nhs_pct", "strhnt_typ", "strhnt_pct", "truck", "isprimary",
)
RIS_TEXT = ("objectid", "region", "county_nam", "fips_co", "dot_id", "gis_id", "beg_mp", "overlap_hi", "functional", "direction")


def feature_schema(fields: tuple[str, ...]) -> str:
    """A GeoJSON LineString feature with text properties."""
    inner = ", ".join(f"`{f}`: string" for f in fields)
    return f"type string, geometry struct<type:string,coordinates:array<array<double>>>, properties struct<{inner}>, _corrupt string"


TARGET_FEATURE = f"""
    target_map string, target_map_id string, meso_id string, macro_id string, mega_id string, is_primary boolean,
    rank double, county_code string, region_code string, micro_bearing int, meso_idx int, meso_sort_method string,
    meso_bearing int, geoprox_key string, geometry {LINE}
"""
GEOMETRY_TILE = "id string, lonlats array<double>, forwardReferenceId string, backReferenceId string, fromIntersectionId string, toIntersectionId string"
METADATA_TILE = f"geometryId string, osmMetadata {OSM_METADATA}"
REFERENCE_TILE = "id string, geometryId string"
MATCH = f"""
    reference_id string, from_node string, to_node string, target_map string, target_map_id string, is_primary boolean,
    rank double, meso_id string, mega_id string, micro_bearing int, meso_bearing int, geometry {LINE}
"""
INTERVAL = """
    reference_id string, target_map string, target_map_id string, matched_id string, is_primary boolean, rank double,
    start_dist double, end_dist double
"""
OSM_NODE = "_id long, _lat double, _lon double, tag array<struct<_k:string,_v:string>>"
OSM_WAY = "_id long, nd array<struct<_ref:long>>, tag array<struct<_k:string,_v:string>>"
OSM_RELATION = "_id long, member array<struct<_type:string,_ref:long,_role:string>>, tag array<struct<_k:string,_v:string>>"
