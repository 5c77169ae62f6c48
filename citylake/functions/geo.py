"""GeoJSON points and polygons as plain columns, and the point-in-polygon test.

A polygon becomes a flat array of edges over all of its rings. Crossing parity over that array handles
holes and multi-polygons alike, and the test needs neither a UDF nor a division.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from citylake.functions.columns import ColumnOrName, as_col

POINT = "coordinates array<double>"
POLYGON = "coordinates array<array<array<double>>>"
MULTI_POLYGON = "coordinates array<array<array<array<double>>>>"


def point_lon_lat(geojson: ColumnOrName) -> tuple[Column, Column]:
    """Longitude and latitude of a GeoJSON point (its coordinates are in that order)."""
    coordinates = F.from_json(as_col(geojson), POINT)["coordinates"]
    return F.get(coordinates, 0), F.get(coordinates, 1)


def polygon_rings(geojson: ColumnOrName) -> Column:
    """All rings of a Polygon or MultiPolygon; null for anything else."""
    text = as_col(geojson)
    kind = F.get_json_object(text, "$.type")
    return F.when(kind == "Polygon", F.from_json(text, POLYGON)["coordinates"]).when(
        kind == "MultiPolygon", F.flatten(F.from_json(text, MULTI_POLYGON)["coordinates"])
    )


def ring_edges(rings: Column) -> Column:
    """array<struct<x1,y1,x2,y2>> over all rings; an unclosed ring is closed."""

    def edges_of(ring: Column) -> Column:
        return F.transform(
            ring,
            lambda vertex, i: F.struct(
                vertex[0].alias("x1"),
                vertex[1].alias("y1"),
                F.coalesce(F.get(ring, i + 1), ring[0])[0].alias("x2"),
                F.coalesce(F.get(ring, i + 1), ring[0])[1].alias("y2"),
            ),
        )

    return F.flatten(F.transform(rings, edges_of))


def _turn(edge: Column, x: Column, y: Column) -> Column:
    return (edge["x2"] - edge["x1"]) * (y - edge["y1"]) - (x - edge["x1"]) * (edge["y2"] - edge["y1"])


def ray_parity(edges: Column, x: Column, y: Column) -> Column:
    """Whether an odd number of edges cross the ray from the point towards larger x."""

    def crosses(edge: Column) -> Column:
        straddles = (edge["y1"] > y) != (edge["y2"] > y)
        return straddles & ((_turn(edge, x, y) > 0) == (edge["y2"] > edge["y1"]))

    return F.size(F.filter(edges, crosses)) % 2 == 1


def path_parity(edges: Column, x: Column, y: Column, to_x: Column, to_y: Column) -> Column:
    """Whether an odd number of edges cross the path from one point level to the x of another, then straight to it.

    Then one of the points lies inside and the other does not. Only edges that touch the rectangle around the two points
    matter. The second point must not have the x of a corner. An edge as level as the path counts as below it, as it does
    where an edge ends at the height of the path.
    """

    def crosses(edge: Column) -> Column:
        start, end, turn = _turn(edge, x, y) > 0, _turn(edge, to_x, to_y) > 0, _turn(edge, to_x, y)
        corner = (turn > 0) | ((turn == 0) & (edge["x2"] > edge["x1"]))
        level = ((edge["y1"] > y) != (edge["y2"] > y)) & (start != corner)
        upright = ((edge["x1"] > to_x) != (edge["x2"] > to_x)) & (corner != end)
        return level != upright

    return F.size(F.filter(edges, crosses)) % 2 == 1


def on_edges(edges: Column, x: Column, y: Column) -> Column:
    """Whether the point lies on an edge or a corner."""

    def on_edge(edge: Column) -> Column:
        return (
            (_turn(edge, x, y) == 0)
            & x.between(F.least(edge["x1"], edge["x2"]), F.greatest(edge["x1"], edge["x2"]))
            & y.between(F.least(edge["y1"], edge["y2"]), F.greatest(edge["y1"], edge["y2"]))
        )

    return F.exists(edges, on_edge)


def edges_touch(edge: Column, x: Column, y: Column, half: Column) -> Column:
    """Whether an edge reaches into the square around a point; an edge that passes a corner closely may count."""
    beside = (F.least(edge["x1"], edge["x2"]) > x + half) | (F.greatest(edge["x1"], edge["x2"]) < x - half)
    above = (F.least(edge["y1"], edge["y2"]) > y + half) | (F.greatest(edge["y1"], edge["y2"]) < y - half)
    reach = (F.abs(edge["x2"] - edge["x1"]) + F.abs(edge["y2"] - edge["y1"])) * half
    return ~beside & ~above & (F.abs(_turn(edge, x, y)) <= reach)


def edges_contain(edges: ColumnOrName, lon: ColumnOrName, lat: ColumnOrName) -> Column:
    """True strictly inside; points on an edge or a corner are outside."""
    edges, x, y = as_col(edges), as_col(lon), as_col(lat)
    return ray_parity(edges, x, y) & ~on_edges(edges, x, y)


def contains(polygon_geojson: ColumnOrName, point_geojson: ColumnOrName) -> Column:
    """GeoJSON polygon contains GeoJSON point."""
    lon, lat = point_lon_lat(point_geojson)
    return edges_contain(ring_edges(polygon_rings(polygon_geojson)), lon, lat)


def cell_of(value: ColumnOrName, size: float) -> Column:
    return F.floor(as_col(value) / F.lit(size)).cast("int")
