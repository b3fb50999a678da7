"""WKT and GeoJSON as arrays of coordinates, and the planar containment test.

A geometry is held as ``rings``: array<array<struct<x,y>>>. Outer rings, holes and the
parts of a multipolygon sit side by side, because the even-odd rule needs no more.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounding box of San Francisco used to reject rental coordinates (fixed values).
SF_WEST, SF_EAST = -122.517, -122.355
SF_SOUTH, SF_NORTH = 37.704, 37.835


def _coordinate(text: Column) -> Column:
    parts = F.split(F.trim(text), r"\s+")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).try_cast("double").alias("x"),
        F.try_element_at(parts, F.lit(2)).try_cast("double").alias("y"),
    )


def _closed(rings: Column) -> Column:
    return (F.size(rings) > 0) & F.forall(
        rings,
        lambda r: (F.size(r) >= 4)
        & F.forall(r, lambda p: p["x"].isNotNull() & p["y"].isNotNull())
        & (F.element_at(r, 1) == F.element_at(r, -1)),
    )


def wkt_rings(wkt: Column) -> Column:
    """Polygon or multipolygon WKT -> rings; NULL on anything malformed."""
    rings = F.transform(
        F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), 1),
        lambda ring: F.transform(F.split(ring, ","), _coordinate),
    )
    headed = wkt.rlike(r"(?i)^\s*(MULTI)?POLYGON\s*\(\s*\(.*\)\s*\)\s*$")
    return F.when(headed & _closed(rings), rings)


def geojson_rings(geometry: Column) -> Column:
    """Struct<type, coordinates: JSON text> of a Polygon or MultiPolygon -> rings; NULL on anything malformed."""
    pair = "array<array<array<double>>>"
    polygon = F.from_json(geometry["coordinates"], pair)
    multi = F.flatten(F.from_json(geometry["coordinates"], f"array<{pair}>"))
    chosen = F.when(geometry["type"] == "Polygon", polygon).when(geometry["type"] == "MultiPolygon", multi)
    rings = F.transform(
        chosen,
        lambda ring: F.transform(
            ring, lambda p: F.struct(F.try_element_at(p, F.lit(1)).alias("x"), F.try_element_at(p, F.lit(2)).alias("y"))
        ),
    )
    return F.when(_closed(rings), rings)


def ring_edges(rings: Column) -> Column:
    """All edges of all rings; rings are never connected to each other."""

    def edges_of(ring: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(ring) - 1),
            lambda i: F.struct(
                F.element_at(ring, i)["x"].alias("x1"),
                F.element_at(ring, i)["y"].alias("y1"),
                F.element_at(ring, i + 1)["x"].alias("x2"),
                F.element_at(ring, i + 1)["y"].alias("y2"),
            ),
        )

    return F.flatten(F.transform(rings, edges_of))


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd rule with a ray towards +x; edges are half-open in y."""

    def crosses(e: Column) -> Column:
        straddles = (e["y1"] > y) != (e["y2"] > y)
        at = F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]) + e["x1"]
        return straddles & F.coalesce(x < at, F.lit(False))

    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != crosses(e))


def point_wkt(lon: Column, lat: Column) -> Column:
    return F.when(
        lon.isNotNull() & lat.isNotNull(),
        F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")),
    )


def geojson_point_wkt(point: Column) -> Column:
    """GeoJSON Point struct -> WKT; anything but a two-coordinate Point is NULL."""
    coords = point["coordinates"]
    usable = (point["type"] == "Point") & (F.size(coords) == 2)
    return F.when(usable, point_wkt(F.try_element_at(coords, F.lit(1)), F.try_element_at(coords, F.lit(2))))


def valid_point_wkt(lon: Column, lat: Column) -> Column:
    """Point text only for coordinates on the globe."""
    return F.when(lat.between(-90, 90) & lon.between(-180, 180), point_wkt(lon, lat))


def in_box(
    lon: Column,
    lat: Column,
    west: float = SF_WEST,
    east: float = SF_EAST,
    south: float = SF_SOUTH,
    north: float = SF_NORTH,
) -> Column:
    return F.coalesce(lon.between(west, east) & lat.between(south, north), F.lit(False))


def rings_geojson(wkt: Column, rings: Column) -> Column:
    """Rings -> GeoJSON geometry text of the type the WKT names.

    A multipolygon ring opens a new part unless it lies inside the part before it
    (its first vertex passes the containment test against that part's outer ring).
    """
    as_pairs = lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    polygon = F.to_json(F.transform(rings, as_pairs))
    parts_type = "array<array<array<struct<x:double,y:double>>>>"

    def place(parts: Column, ring: Column) -> Column:
        last = F.element_at(parts, -1)
        first_vertex = F.element_at(ring, 1)
        is_hole = inside(ring_edges(F.array(F.element_at(last, 1))), first_vertex["x"], first_vertex["y"])
        extended = F.concat(
            F.slice(parts, F.lit(1), F.size(parts) - 1), F.array(F.concat(last, F.array(ring)))
        )
        opened = F.concat(parts, F.array(F.array(ring)))
        return F.when(F.size(parts) == 0, opened).when(is_hole, extended).otherwise(opened)

    parts = F.aggregate(rings, F.array().cast(parts_type), place)
    multi = F.to_json(F.transform(parts, lambda part: F.transform(part, as_pairs)))
    is_multi = wkt.rlike(r"(?i)^\s*MULTIPOLYGON")
    return F.when(
        rings.isNotNull(),
        F.concat(
            F.when(is_multi, F.lit('{"type":"MultiPolygon","coordinates":')).otherwise(
                F.lit('{"type":"Polygon","coordinates":')
            ),
            F.when(is_multi, multi).otherwise(polygon),
            F.lit("}"),
        ),
    )


def centroid(edges: Column) -> Column:
    """Area-weighted centroid of an edge list (holes wound the other way subtract)."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, e: Column) -> Column:
        cross = e["x1"] * e["y2"] - e["x2"] * e["y1"]
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["x"] + (e["x1"] + e["x2"]) * cross).alias("x"),
            (acc["y"] + (e["y1"] + e["y2"]) * cross).alias("y"),
        )

    total = F.aggregate(edges, zero, add)
    return F.struct(
        F.try_divide(total["x"], total["a"] * 3).alias("lon"),
        F.try_divide(total["y"], total["a"] * 3).alias("lat"),
    )
