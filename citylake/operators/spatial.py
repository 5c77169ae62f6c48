"""Point-in-polygon join on a quadtree of cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from citylake.functions.geo import cell_of, edges_touch, on_edges, path_parity, polygon_rings, ray_parity, ring_edges
from citylake.session import fresh_dir

# The largest level: its cells are 4^TOP as wide as the smallest ones. Polygons that need less start lower.
TOP = 5
FEW = 8  # edges with which a cell is not split further
# Where the reference point of a cell lies in it: at no place a corner with a few decimals can have.
PLACE = 0.41421356237309503


def _width(level: Column, size: float) -> Column:
    return F.lit(size) * F.pow(F.lit(4.0), level)


def _reference(cell: Column, level: Column, size: float) -> Column:
    return (cell + F.lit(PLACE)) * _width(level, size)


def _local(edges: Column, cx: Column, cy: Column, level: Column, size: float) -> Column:
    """The edges that reach into a cell; a hair of slack absorbs the rounding of its bounds."""
    width = _width(level, size)
    half = width / 2 + F.lit(size * 1e-6)
    return F.filter(edges, lambda e: edges_touch(e, (cx + 0.5) * width, (cy + 0.5) * width, half))


def cover(polygons: DataFrame, geojson: str, size: float) -> DataFrame:
    """Cells of each polygon: _polygon, level, cx, cy, the edges that reach into the cell, and whether its reference
    point lies inside.

    A cell is split into 16 only where more than FEW edges reach into it, down to width `size`; a cell without edges
    stays whole if it lies inside and goes if not. So the cells of a polygon are in proportion to its outline, and
    each carries only its own edges: whether a point is inside follows from the edges between it and the reference point.
    """
    edges = ring_edges(polygon_rings(F.col(geojson)))
    rows = polygons.select("_polygon", edges.alias("edges"))

    def places(first: str, second: str) -> Column:
        return F.concat(F.transform("edges", lambda e: e[first]), F.transform("edges", lambda e: e[second]))

    measured = rows.select(places("x1", "x2").alias("x"), places("y1", "y2").alias("y"), F.size("edges").alias("n"))
    extent = F.expr("max(greatest(array_max(x) - array_min(x), array_max(y) - array_min(y)))")
    extent, most = measured.agg(extent, F.max("n")).first()
    top = min(TOP, max(0, math.ceil(math.log(extent / size, 4)))) if extent else 0
    widest = size * 4**top

    def cells(first: str, second: str) -> Column:
        values = places(first, second)
        return F.explode(F.sequence(cell_of(F.array_min(values), widest), cell_of(F.array_max(values), widest)))

    level, cx, cy = F.col("level"), F.col("cx"), F.col("cy")
    rows = rows.withColumn("level", F.lit(top))
    rows = rows.withColumn("cx", cells("x1", "x2")).withColumn("cy", cells("y1", "y2"))
    inside = ray_parity(F.col("edges"), _reference(cx, level, size), _reference(cy, level, size))
    rows = rows.select("_polygon", "level", "cx", "cy", _local(F.col("edges"), cx, cy, level, size).alias("edges"), inside.alias("inside"))
    for upper in range(top if most and most > FEW else 0, 0, -1):
        parts = F.transform(
            F.sequence(F.lit(0), F.lit(15)),
            lambda k: F.struct((level - 1).alias("level"), (cx * 4 + k % 4).alias("cx"), (cy * 4 + F.floor(k / 4).cast("int")).alias("cy")),
        )
        split = (level == upper) & (F.size("edges") > FEW)
        part = F.explode(F.when(split, parts).otherwise(F.array(F.struct("level", "cx", "cy"))))
        rows = rows.select("_polygon", level.alias("upper"), cx.alias("ux"), cy.alias("uy"), "edges", "inside", part.alias("cell"))
        rows = rows.select("_polygon", "upper", "ux", "uy", "edges", "inside", "cell.*")
        fresh = level < F.col("upper")
        here = _reference(cx, level, size), _reference(cy, level, size)
        there = _reference(F.col("ux"), F.col("upper"), size), _reference(F.col("uy"), F.col("upper"), size)
        turned = F.col("inside") != path_parity(F.col("edges"), *here, *there)
        rows = rows.select(
            "_polygon", "level", "cx", "cy",
            F.when(fresh, _local(F.col("edges"), cx, cy, level, size)).otherwise(F.col("edges")).alias("edges"),
            F.when(fresh, turned).otherwise(F.col("inside")).alias("inside"),
        ).where("size(edges) > 0 or inside")
    return rows.where("size(edges) > 0 or inside")


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spatial_join(
    points: DataFrame,
    polygons: DataFrame,
    lon: str = "longitude",
    lat: str = "latitude",
    geojson: str = "geometry_geojson",
    cell: float = 0.01,
    how: str = "left",
) -> DataFrame:
    """Attaches the polygon that strictly contains each point; `how` is left or inner.

    One equality join per level of cells in use, at most TOP + 1 of them, each with one row per cell; the exact test
    then sees only the few edges of the cells a point lies in. `cell` is the width of the smallest cells, which only
    dense outlines need. Overlapping polygons yield one row each, as any join would; check uniqueness where that must
    not happen.
    """
    if how not in ("left", "inner"):
        raise ValueError("a spatial join is left or inner")
    numbered = _written(polygons.withColumn("_polygon", F.monotonically_increasing_id()), "polygons")
    cells = _written(cover(numbered, geojson, cell), "cover")
    part = F.struct(
        "_polygon", "edges", "inside",
        _reference(F.col("cx"), F.col("level"), cell).alias("x"),
        _reference(F.col("cy"), F.col("level"), cell).alias("y"),
    )
    grouped = cells.groupBy("level", "cx", "cy").agg(F.collect_list(part).alias("_parts"))
    located = points.withColumn("_px", cell_of(lon, cell)).withColumn("_py", cell_of(lat, cell))
    levels = sorted(r[0] for r in cells.select("level").distinct().collect()) or [0]
    for level in levels:
        right = grouped.where(F.col("level") == level).select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("_parts").alias(f"_parts{level}"))
        meets = (F.shiftright("_px", 2 * level) == F.col("_cx")) & (F.shiftright("_py", 2 * level) == F.col("_cy"))
        located = located.join(right, meets, "left").drop("_cx", "_cy")
    x, y = F.col(lon), F.col(lat)

    def holds(one: Column) -> Column:
        return (one["inside"] != path_parity(one["edges"], x, y, one["x"], one["y"])) & ~on_edges(one["edges"], x, y)

    parts = F.flatten(F.array_compact(F.array(*(f"_parts{level}" for level in levels))))
    found = F.transform(F.filter(parts, holds), lambda one: one["_polygon"])
    explode = F.explode if how == "inner" else F.explode_outer
    held = located.withColumn("_of", explode(found)).drop("_px", "_py", *(f"_parts{level}" for level in levels))
    return held.join(numbered, F.col("_of") == F.col("_polygon"), how).drop("_of", "_polygon")
