"""Where points lie: in which cube, and on which grid cell of it.

A cube row holds ``cube_id``, its ``epsg``, a box in degrees ``minx, miny, maxx, maxy`` (optionally a ``footprint`` ring),
and its grid ``x0, y0, dx, dy, nx, ny``: the first cell centre, the signed steps and the cell counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnflow.functions import rings
from firnflow.functions.projections import offset_metres, project, unproject
from firnflow.functions.urls import composite_url, epsg_code
from firnflow.operators.bounded import BROADCAST_ROWS, grid_join, join_bounded, listed_rows, plain_columns, settled
from firnflow.operators.search import BOX, data_assets

GRID = ("x0", "y0", "dx", "dy", "nx", "ny")
CELL_DEGREES = 1.0


def cubes_from_items(items: DataFrame) -> DataFrame:
    """Catalog items as cubes: the first ``.zarr`` data asset, its composite, and the projection code."""
    found = data_assets(items, ".zarr", first_only=True)
    return found.withColumns(
        {
            "zarr_url": F.col("href"),
            "composite_zarr_url": composite_url(F.col("href")),
            "epsg": epsg_code(F.col("`proj:code`")),
        }
    ).drop("href", "assets", "proj:code")


def find_cubes(cubes: DataFrame, rois: DataFrame, base_degrees: float = CELL_DEGREES, max_degrees: float = 512.0) -> DataFrame:
    """Cubes that meet each region of a table, one row per pair, with the cube's own footprint."""
    roi_box = [F.col("roi_" + n) for n in BOX]
    pairs = grid_join(rois, cubes, roi_box, [F.col(n) for n in BOX], base_degrees, max_degrees, salt_by=["roi_id"])
    if "roi_ring" in rois.columns:
        ring = F.col("footprint") if "footprint" in cubes.columns else rings.box_ring(*(F.col(n) for n in BOX))
        pairs = pairs.where(rings.rings_meet(ring, F.col("roi_ring")))
    return pairs


def find_cubes_for(cubes: DataFrame, points: Sequence[tuple[float, float]]) -> DataFrame:
    """Cubes at one point, or meeting the polygon of three or more; none for an empty list."""
    if not points:
        return cubes.limit(0)
    if len(points) == 2:
        raise ValueError("two points are neither a place nor a polygon")
    roi = rings.Region(points=tuple(points)) if len(points) == 1 else rings.polygon_region(points)
    return cubes.where(rings.region_meets_box(roi, [F.col(n) for n in BOX]))


class CubeFacts(NamedTuple):
    """What planning needs to know of a cube catalog: may its listing be broadcast, and which systems does it hold?"""

    fits: bool
    systems: list[int]


def cube_facts(cubes: DataFrame, cell_degrees: float = CELL_DEGREES, rows: int = BROADCAST_ROWS) -> CubeFacts:
    """Both in one small job.  There are 122 codes of systems, so their list is short whatever the catalog."""
    listed = F.sum(listed_rows([F.col(n) for n in BOX], cell_degrees))
    row = cubes.agg(listed.alias("listed"), F.collect_set(F.col("epsg").cast("int")).alias("systems")).first()
    return CubeFacts((row.listed or 0) <= rows, sorted(row.systems))


def _containing(
    points: DataFrame,
    cubes: DataFrame,
    lon: str,
    lat: str,
    strict: bool,
    cell_degrees: float,
    rows: int,
    fits: bool | None,
) -> DataFrame:
    here, boxes, box = _sides(cubes, lon, lat)
    pairs = grid_join(points, boxes, here, box, cell_degrees, rows=rows, salt_by=["point_id"], fits=fits)
    return pairs.where(_held(boxes, lon, lat, strict))


def _sides(cubes: DataFrame, lon: str, lat: str) -> tuple[list[Column], DataFrame, list[Column]]:
    """A place as a box, the cubes' extents under names of their own, and their boxes."""
    names = {n: "_c_" + n for n in (*BOX, "footprint") if n in cubes.columns}
    boxes = cubes.select("cube_id", *(F.col(a).alias(b) for a, b in names.items()))
    return [F.col(lon), F.col(lat), F.col(lon), F.col(lat)], boxes, [F.col("_c_" + n) for n in BOX]


def _held(boxes: DataFrame, lon: str, lat: str, strict: bool) -> Column:
    """Does the cube of a pair contain its place?  Boxes without a footprint have been tested, borders included, unless strict."""
    if "_c_footprint" in boxes.columns:
        return rings.ring_contains(F.col("_c_footprint"), F.col(lon), F.col(lat), strict)
    if not strict:
        return F.lit(True)
    x0, y0, x1, y1 = (F.col("_c_" + n) for n in BOX)
    return (F.col(lon) > x0) & (F.col(lon) < x1) & (F.col(lat) > y0) & (F.col(lat) < y1)


def first_cube(
    points: DataFrame,
    cubes: DataFrame,
    lon: str = "lon",
    lat: str = "lat",
    strict: bool = False,
    cell_degrees: float = CELL_DEGREES,
    rows: int = BROADCAST_ROWS,
    fits: bool | None = None,
) -> DataFrame:
    """Adds the lowest ``cube_id`` that contains each point; points in no cube are dropped.

    Only a number is aggregated, so the candidates shrink in hash maps before the one shuffle.
    """
    pairs = _containing(points, cubes, lon, lat, strict, cell_degrees, rows, fits)
    return pairs.groupBy(*points.columns).agg(F.min("cube_id").alias("cube_id"))


def locate(
    points: DataFrame,
    cubes: DataFrame,
    cell_degrees: float = CELL_DEGREES,
    rows: int = BROADCAST_ROWS,
    facts: CubeFacts | None = None,
) -> DataFrame:
    """Points with the attributes of their cube."""
    fits = (facts or cube_facts(cubes, cell_degrees, rows)).fits
    found = first_cube(points, cubes, cell_degrees=cell_degrees, rows=rows, fits=fits)
    keep = [c for c in cubes.columns if c not in BOX and c not in points.columns]
    # Every cube is listed at least once, so a listing that fits means that the cubes fit.
    return join_bounded(found, cubes.select(*keep), ["cube_id"], rows=rows, salt_by=["point_id"], measured=fits)


def missing_points(points: DataFrame, found: DataFrame) -> DataFrame:
    """Points for which nothing was found."""
    return points.join(found.select("point_id").distinct(), "point_id", "left_anti")


# ---- grid cells --------------------------------------------------------------------------------------------------


def nearest_index(value: Column, first: Column, step: Column, count: Column) -> Column:
    """Cell of a regular axis nearest to a coordinate; ends hold beyond the axis, ties go to the larger coordinate."""
    low = F.least(F.greatest(F.floor((value - first) / step), F.lit(0)), count - 1)
    after = F.least(low + 1, count - 1)
    # Distances to the two centres are compared: a rounded quotient ties where one of them is nearer by a hair.
    here, there = (F.abs(first + i * step - value) for i in (low, after))
    return F.when(F.when(step > 0, there <= here).otherwise(there < here), after).otherwise(low).cast("int")


def nearest_on_axis(axis: Column, value: Column) -> Column:
    """Coordinate of an irregular axis (an array) nearest to a value; ties go to the larger coordinate."""
    best = F.array_min(F.transform(axis, lambda a: F.struct(F.abs(a - value).alias("d"), (-a).alias("n"))))
    return -best["n"]


def snap(located: DataFrame, px: str = "px", py: str = "py") -> DataFrame:
    """Adds cell indices ``ix, iy``, the cell centre ``x, y`` and its distance from ``px, py``."""
    c = F.col
    indexed = located.withColumns(
        {
            "ix": nearest_index(c(px), c("x0"), c("dx"), c("nx")),
            "iy": nearest_index(c(py), c("y0"), c("dy"), c("ny")),
        }
    )
    centred = settled(indexed, {"x": c("x0") + c("ix") * c("dx"), "y": c("y0") + c("iy") * c("dy")})
    return centred.withColumn("offset_m", offset_metres(c("x") - c(px), c("y") - c(py)))


def snap_points(located: DataFrame, systems: Sequence[int] | None = None) -> DataFrame:
    """Located points projected into their cube's system, on the nearest cell, with that cell's position in degrees."""
    px, py = project(F.col("lon"), F.col("lat"), F.col("epsg"), systems)
    on_cell = snap(settled(located, {"px": px, "py": py}))
    lon, lat = unproject(F.col("x"), F.col("y"), F.col("epsg"), systems)
    return on_cell.withColumns({"returned_lon": lon, "returned_lat": lat})


def with_cell_index(rows: DataFrame, cubes: DataFrame) -> DataFrame:
    """Observations given by coordinates get the indices ``ix, iy`` of their cell, once, when they are taken in."""
    grid = cubes.select("cube_id", *GRID)
    joined = join_bounded(rows, grid, ["cube_id"], salt_by=plain_columns(rows))
    c = F.col
    return joined.withColumns(
        {
            "ix": nearest_index(c("x"), c("x0"), c("dx"), c("nx")),
            "iy": nearest_index(c("y"), c("y0"), c("dy"), c("ny")),
        }
    ).drop(*GRID)


# ---- two-step lookup in degrees and in the cube's own box ---------------------------------------------------------

# How far a point outside its cube's box is moved outward, and one on its edge inward, in metres.
OUTWARD_METRES = 10000.0
INWARD_METRES = 1.0
XY_BOX = ("xmin", "ymin", "xmax", "ymax")


def _in_xy_box(x: Column, y: Column) -> Column:
    return (x > F.col("xmin")) & (x < F.col("xmax")) & (y > F.col("ymin")) & (y < F.col("ymax"))


def _moved(x: Column, y: Column) -> tuple[Column, Column]:
    xmin, ymin, xmax, ymax = (F.col(n) for n in XY_BOX)
    out, inn = OUTWARD_METRES, INWARD_METRES
    y_out, x_out = (y < ymin) | (y > ymax), (x < xmin) | (x > xmax)
    on_y = (y == ymin) | (y == ymax)
    new_y = (
        F.when(y < ymin, y - out)
        .when(y > ymax, y + out)
        .when(x_out, y)
        .when(y == ymin, y + inn)
        .when(y == ymax, y - inn)
        .otherwise(y)
    )
    new_x = (
        F.when(y_out, x)
        .when(x < xmin, x - out)
        .when(x > xmax, x + out)
        .when(on_y, x)
        .when(x == xmin, x + inn)
        .when(x == xmax, x - inn)
        .otherwise(x)
    )
    return new_x, new_y


def locate_two_step(
    points: DataFrame, cubes: DataFrame, cell_degrees: float = CELL_DEGREES, rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Cube of points given in any system, by a strict test in degrees and then in the cube's own box.

    A point that fails the second test is looked up once more from a place moved outward (or inward, if it lies on the
    edge); the other cube is taken if the point itself lies in its box.  ``points``: ``point_id, x, y, epsg``; ``cubes`` also
    hold ``xmin, ymin, xmax, ymax`` in their own system.  Result: ``point_id, cube_id, x, y, status`` with the point in
    the system of the cube, where status is ``direct``, ``offset``, ``not_in_box_after_offset``, ``no_cube_after_offset``
    or ``no_cube``.
    """
    fits, systems = cube_facts(cubes, cell_degrees, rows)
    lon, lat = unproject(F.col("x"), F.col("y"), F.col("epsg"))  # any of the known systems
    asked = points.select("point_id", F.col("x").alias("in_x"), F.col("y").alias("in_y"), F.col("epsg").alias("in_epsg"), "x", "y", "epsg")
    placed = settled(asked, {"lon": lon, "lat": lat}).drop("x", "y", "epsg")

    def looked_up(found: DataFrame, lon: str, lat: str, n: str) -> DataFrame:
        """Every row with the lowest cube that holds its place, the point in that cube's system, and whether its box holds it."""
        here, boxes, box = _sides(cubes, lon, lat)
        pairs = grid_join(found, boxes, here, box, cell_degrees, rows=rows, salt_by=["point_id"], fits=fits, how="left")
        lowest = pairs.groupBy(*found.columns).agg(F.min(F.when(_held(boxes, lon, lat, True), F.col("cube_id"))).alias("cube_id"))
        attributes = cubes.select("cube_id", "epsg", *XY_BOX)
        joined = join_bounded(lowest, attributes, ["cube_id"], "left", rows, salt_by=["point_id"], measured=fits)
        px, py = project(F.col("lon"), F.col("lat"), F.col("epsg"), systems)
        same = F.col("in_epsg") == F.col("epsg")
        x, y = F.when(same, F.col("in_x")).otherwise(px), F.when(same, F.col("in_y")).otherwise(py)
        tested = settled(settled(joined, {"x": x, "y": y}), {"inside": _in_xy_box(F.col("x"), F.col("y"))})
        return tested.withColumnsRenamed({c: f"{c}{n}" for c in ("cube_id", "x", "y", "inside", "epsg")})

    first = looked_up(placed, "lon", "lat", "1").withColumnsRenamed({"x1": "x", "y1": "y", "epsg1": "epsg"})
    mx, my = _moved(F.col("x"), F.col("y"))
    mlon, mlat = unproject(F.col("mx"), F.col("my"), F.col("epsg"), systems)
    again = ~F.col("inside1")
    moved = settled(settled(first, {"mx": F.when(again, mx), "my": F.when(again, my)}), {"moved_lon": mlon, "moved_lat": mlat})
    # A point that needs no second place has none: it meets no cube there and comes out as it is.
    kept = moved.select("point_id", "in_x", "in_y", "in_epsg", "lon", "lat", "moved_lon", "moved_lat", "cube_id1", "x", "y", "inside1")
    second = looked_up(kept.withColumnsRenamed({"x": "x1", "y": "y1"}), "moved_lon", "moved_lat", "2")
    c = F.col
    status = (
        F.when(c("inside1").isNull(), "no_cube").when(c("inside1"), "direct").when(c("cube_id2").isNull(), "no_cube_after_offset")
        .when(c("inside2"), "offset").otherwise("not_in_box_after_offset")
    )
    direct = F.coalesce("inside1", F.lit(False))
    return second.select(
        "point_id",
        F.when(direct, c("cube_id1")).when(c("inside2"), c("cube_id2")).alias("cube_id"),
        F.when(direct, c("x1")).otherwise(c("x2")).alias("x"),
        F.when(direct, c("y1")).otherwise(c("y2")).alias("y"),
        status.alias("status"),
    )
