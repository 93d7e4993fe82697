"""Cubes kept as dense chunks: series taken straight from them, and cut-outs put back into them.

A chunk row holds ``cube_id``, the chunk's index along y and x (``cy, cx``) and one array of values with time slowest and x
fastest.  Where a cell lies follows by arithmetic, so only the chunks that hold a wanted cell are joined, and of their arrays
only the wanted elements become rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnflow.functions.scaling import missing_to_null
from firnflow.operators.bounded import BROADCAST_ROWS, is_bounded, join_bounded
from firnflow.operators.series import CELL

CHUNK = ("cube_id", "cy", "cx")
# Elements of one dense chunk; more is a mistake in the lengths asked for.
MOST_ELEMENTS = 1 << 22


def series_from_chunks(
    on_cells: DataFrame,
    chunks: DataFrame,
    lengths: tuple[Column, Column],
    values: str = "values",
    name: str = "v",
    times: DataFrame | None = None,
    rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Series of points on cells (``cube_id, ix, iy`` and any other columns) as rows: those columns, ``it`` and the value.

    ``lengths`` are the chunk's cells along y and x; the time steps follow from the length of the array, and a chunk at the edge
    of its cube is padded, as array stores do.  Cells are grouped by chunk first: a chunk is met once however many points lie in
    it, and its array is never exploded, only read at the strides of the wanted cells.  The chunks, the large side, stay where
    they are while the cells fit a broadcast; beyond that both are shuffled by chunk.  Cells outside any chunk give no row.
    With ``times`` (``cube_id, it, mid_date``) the time stands in place of ``it``.
    """
    ny, nx = (n.cast("long") for n in lengths)
    c = F.col
    cells = on_cells.select(*CELL).distinct().where("ix >= 0 AND iy >= 0")
    sizes = cells.withColumns({"cy": F.floor(c("iy") / ny), "cx": F.floor(c("ix") / nx)})
    offset = (c("iy") % ny) * nx + c("ix") % nx
    # At most a chunk's own cells come together here.
    wanted = sizes.groupBy(*CHUNK).agg(F.collect_list(F.struct(offset.cast("int").alias("at"), "ix", "iy")).alias("_cells"))
    fits = is_bounded(on_cells, rows)
    held = join_bounded(chunks.select(*CHUNK, values), wanted, CHUNK, rows=rows, salt_by=CHUNK, measured=fits)
    each = held.select("cube_id", values, F.explode("_cells").alias("_cell"))
    stride = (ny * nx).cast("int")
    steps = F.floor(F.size(values) / stride).cast("int")
    strided = F.transform(
        F.sequence(F.lit(0), steps - 1), lambda t: F.struct(t.alias("it"), F.get(c(values), c("_cell.at") + t * stride).alias(name))
    )
    series = each.where(steps > 0).select("cube_id", "_cell.ix", "_cell.iy", F.inline(strided))
    # The time step differs between the rows of one cell, so it spreads a crowded cell in a shuffle.
    out = join_bounded(series, on_cells, CELL, rows=rows, salt_by=["it"], measured=fits)
    out = out.select(*on_cells.columns, "it", missing_to_null(c(name).cast("double")).alias(name))
    if times is None:
        return out
    dated = join_bounded(out, times.select("cube_id", "it", "mid_date"), ["cube_id", "it"], rows=rows, salt_by=on_cells.columns)
    return dated.select(*on_cells.columns, "mid_date", name)


def dense_chunks(
    cells: DataFrame,
    keys: Sequence[str],
    axes: Mapping[str, int],
    values: Sequence[str],
    coordinates: Mapping[str, Callable[[Column], Column]] | None = None,
    rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Long rows as dense chunks, the inverse of ``flatten_chunks``.

    Each key's cells span a box of whole indices, whose lower corner is its origin.  The box is cut into chunks of ``axes``, a
    mapping from each index column, the slowest first, to the length of a chunk along it.  A row per chunk that holds at least
    one cell: ``keys``, per axis the chunk's number ``c_<axis>``, the index it begins at ``<axis>_start`` and its length
    ``<axis>_length`` (less at the box's upper end), an array per value with NULL where no cell is, and for each axis named in
    ``coordinates`` an array ``<axis>_values`` with the coordinate of every index.  Coordinates are functions of the index, and
    of the keys.  A value is a number; where several rows share a cell its largest value stays.  A chunk's elements are bounded by the
    product of the lengths, so no task holds a whole box; a crowded cell is reduced before it is shuffled.
    """
    total = 1
    for n in axes.values():
        total *= n
    if not 0 < total <= MOST_ELEMENTS:
        raise ValueError(f"a chunk of {total} elements; wanted 1 to {MOST_ELEMENTS}")
    c, keys, names = F.col, list(keys), list(axes)
    used = cells.select(*keys, *(c(a).cast("long").alias(a) for a in names), *values)
    for a in names:
        used = used.where(c(a).isNotNull())
    single = used.groupBy(*keys, *names).agg(*(F.max(v).alias(v) for v in values))
    extents = single.groupBy(*keys).agg(*(F.min(a).alias(f"_{a}_0") for a in names), *(F.max(a).alias(f"_{a}_1") for a in names))
    placed = join_bounded(single, extents, keys, rows=rows, salt_by=names)
    number = {a: F.floor((c(a) - c(f"_{a}_0")) / n) for a, n in axes.items()}
    start = {a: c(f"_{a}_0") + c(f"c_{a}") * n for a, n in axes.items()}
    length = {a: F.least(F.lit(n), c(f"_{a}_1") - c(f"{a}_start") + 1) for a, n in axes.items()}
    placed = placed.withColumns({f"c_{a}": number[a] for a in names}).withColumns({f"{a}_start": start[a] for a in names})
    placed = placed.withColumns({f"{a}_length": length[a].cast("int") for a in names})
    at = F.lit(0).cast("long")
    for a in names:
        at = at * c(f"{a}_length") + c(a) - c(f"{a}_start")
    by = [*keys, *(f"c_{a}" for a in names), *(f"{a}_start" for a in names), *(f"{a}_length" for a in names)]
    chunked = placed.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(at.cast("int").alias("at"), *values))).alias("_cells"))
    volume = F.lit(1)
    for a in names:
        volume = volume * c(f"{a}_length")

    def filled(v: str) -> Column:
        """Every element with the holes before it, and those after the last one."""
        kind = cells.schema[v].dataType
        hole = F.lit(None).cast(kind)
        before = F.transform(
            "_cells",
            lambda e, i: F.concat(
                F.array_repeat(hole, e["at"] - F.coalesce(F.get(c("_cells"), i - 1)["at"], F.lit(-1)) - 1), F.array(e[v])
            ),
        )
        return F.concat(F.flatten(before), F.array_repeat(hole, (volume - F.element_at("_cells", -1)["at"] - 1).cast("int")))

    def line(a: str) -> Column:
        return F.transform(F.sequence(c(f"{a}_start"), c(f"{a}_start") + c(f"{a}_length") - 1), lambda i: coordinates[a](i))

    return chunked.select(*by, *(filled(v).alias(v) for v in values), *(line(a).alias(f"{a}_values") for a in names if a in (coordinates or {})))
