"""Velocity and composite series at many points at once.

``observations`` and the composite tables hold one row per cube, cell (``ix, iy``) and time; they are by far the largest
tables.  They are read once, pruned to the columns asked for and joined on ``cube_id, ix, iy``.  Where the located points
are few they are broadcast and no observation is shuffled; on a table partitioned by ``cube_id`` the join also skips the
cubes that hold no point.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnflow.functions.sensors import composite_variables, present, stored_variables, velocity_variables
from firnflow.functions.times import from_micros, micros
from firnflow.operators.bounded import BROADCAST_ROWS, is_bounded, join_bounded, join_listed, join_salted
from firnflow.operators.locate import CELL_DEGREES, GRID, cube_facts, locate, locate_two_step, snap, snap_points

CELL = ("cube_id", "ix", "iy")
POINT_COLUMNS = (
    "point_id", "lon", "lat", "cube_id", "ix", "iy", "epsg", "px", "py", "x", "y", "offset_m", "returned_lon",
    "returned_lat",
)
SNAPPED_COLUMNS = (*POINT_COLUMNS, "zarr_url", "composite_zarr_url")
# Of these, what all points of a cell share.
OF_CELL = ("epsg", "x", "y", "zarr_url", "composite_zarr_url")


def series_at(
    on_cells: DataFrame,
    table: DataFrame,
    time: Sequence[str],
    variables: Iterable[str],
    rows: int = BROADCAST_ROWS,
    measured: DataFrame | bool | None = None,
    wanted: Iterable[str] = (),
    keep: Iterable[str] = SNAPPED_COLUMNS,
) -> DataFrame:
    """Rows of a cell table at snapped points: the point's columns repeated, then the time and the variables.

    ``keep`` names the point's columns, beside its cell; fewer take less room.  ``measured`` may name the points the snapped ones come from, no fewer and quicker to count, or tell the outcome.  A variable of
    ``wanted`` that the table lacks is an error; others are left out.
    """
    names = stored_variables(table, variables, wanted)
    values = table.select(*CELL, *time, *names)
    points = on_cells.select(*CELL, *present(on_cells, (n for n in keep if n not in CELL)))
    # Times and values differ between the rows of one cell, so they spread a crowded cell in a shuffle.
    return join_listed(values, points, CELL, rows, salt_by=[*time, *names], measured=measured, shared=present(points, OF_CELL))


def time_series(
    points: DataFrame,
    cubes: DataFrame,
    observations: DataFrame,
    variables: Iterable[str] = ("v",),
    cell_degrees: float = CELL_DEGREES,
    rows: int = BROADCAST_ROWS,
    keep: Iterable[str] = SNAPPED_COLUMNS,
) -> DataFrame:
    """Velocity series of every point: its first cube, nearest cell, and all observations there.

    ``keep`` names the columns of the point that are repeated, beside its cell.
    """
    facts = cube_facts(cubes, cell_degrees, rows)
    on_cells = snap_points(locate(points, cubes, cell_degrees, rows, facts), facts.systems)
    return series_at(on_cells, observations, ["mid_date"], velocity_variables(variables), rows, points, variables, keep)


def time_series_in_system(
    points: DataFrame,
    cubes: DataFrame,
    observations: DataFrame,
    variables: Iterable[str] = ("v",),
    cell_degrees: float = CELL_DEGREES,
    rows: int = BROADCAST_ROWS,
    keep: Iterable[str] = SNAPPED_COLUMNS,
) -> DataFrame:
    """Velocity series of points given as ``point_id, x, y, epsg`` in any system, by the two-step lookup; ``keep`` as in ``time_series``."""
    found = locate_two_step(points, cubes, cell_degrees, rows).where(F.col("status").isin("direct", "offset"))
    placed = found.select("point_id", "cube_id", F.col("x").alias("px"), F.col("y").alias("py"))
    grid = cubes.select("cube_id", "epsg", *GRID)
    on_cells = snap(join_bounded(placed, grid, ["cube_id"], rows=rows, salt_by=["point_id"]))
    return series_at(on_cells, observations, ["mid_date"], velocity_variables(variables), rows, points, variables, keep)


def annual_series(
    points: DataFrame,
    cubes: DataFrame,
    composites: DataFrame,
    static: DataFrame | None = None,
    variables: Iterable[str] = ("v",),
    cell_degrees: float = CELL_DEGREES,
    rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Annual composites of every point; points whose cube has no composite are left out.

    ``static`` holds the climatology and the masks, one row per cell, and is added where it exists.
    """
    facts = cube_facts(cubes, cell_degrees, rows)
    located = locate(points, cubes, cell_degrees, rows, facts).where("composite_zarr_url <> ''")
    on_cells = snap_points(located, facts.systems)
    names = composite_variables(variables)
    fits = is_bounded(points, rows)
    out = series_at(on_cells, composites, ["year"], names, rows, measured=fits)
    have = {*out.columns, *(static.columns if static is not None else ())}
    if lost := [n for n in variables if n not in have]:
        raise ValueError(f"no composite variable {', '.join(lost)}")
    if static is None:
        return out
    extra = [n for n in present(static, names) if n not in out.columns]
    # One row per cell asked for, which is no more than there are points; a crowded cell is spread by point and year.
    wanted = join_bounded(static.select(*CELL, *extra), on_cells.select(*CELL).distinct(), CELL, "left_semi", salt_by=CELL, measured=fits)
    return join_bounded(out, wanted, CELL, "left", salt_by=["point_id", "year"], measured=fits)


def points_found(
    points: DataFrame,
    cubes: DataFrame,
    observations: DataFrame,
    cell_degrees: float = CELL_DEGREES,
    rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The snapped points that have a series, as ``time_series`` finds them, without their observations: a cell is looked up once."""
    facts = cube_facts(cubes, cell_degrees, rows)
    on_cells = snap_points(locate(points, cubes, cell_degrees, rows, facts), facts.systems)
    return join_salted(on_cells, observations.select(*CELL).distinct(), CELL, ["point_id"], "left_semi")


def found_count(series: DataFrame) -> DataFrame:
    """How many points have a series."""
    return series.agg(F.countDistinct("point_id").alias("points_found"))


def separated(series: DataFrame, low: float, high: float, column: str = "date_dt_days") -> DataFrame:
    """Observations whose image pair is ``low`` to ``high`` days apart."""
    return series.where(F.col(column).between(low, high))


def of_sensor(series: DataFrame, code: str | Column, column: str = "satellite_img1") -> DataFrame:
    return series.where(F.col(column) == code)


def sensors(series: DataFrame, column: str = "satellite_img1", descending: bool = False) -> DataFrame:
    """The different satellites, in order."""
    found = series.select(column).distinct()
    return found.orderBy(F.col(column).desc() if descending else F.col(column))


def sensor_counts(series: DataFrame, keys: Sequence[str] = (), column: str = "satellite_img1") -> DataFrame:
    return series.groupBy(*keys, column).agg(F.count("*").alias("observations"))


def positive_maximum(series: DataFrame, keys: Sequence[str], value: str = "v", time: str = "mid_date") -> DataFrame:
    """Largest value above zero and the first time it occurs."""
    order = F.struct(F.col(value).alias("v"), (-micros(F.col(time))).alias("back"))
    best = series.where(F.col(value) > 0).groupBy(*keys).agg(F.max(order).alias("_best"))
    return best.select(*keys, F.col("_best.v").alias("max_value"), from_micros(-F.col("_best.back")).alias("max_date"))
