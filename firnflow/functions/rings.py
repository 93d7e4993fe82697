"""Planar polygon tests as Catalyst expressions.

Regions of interest are plain Python values (``Region``) and are unrolled into flat, code-generated predicates; rings
that are columns use array lambdas.  "Meets" counts shared boundary, "contains" does not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from firnflow.functions.filters import all_of, any_of

Vertex = tuple[float, float]
Edge = tuple[Vertex, Vertex]

# Beyond this many edges an unrolled predicate grows past what the JVM compiles well; an array literal takes over.
UNROLL_EDGES = 48


@dataclass(frozen=True)
class Region:
    """Region of interest: areas of an outer ring and its holes, open lines, single points.  Parts may overlap."""

    areas: tuple[tuple[tuple[Vertex, ...], ...], ...] = ()
    lines: tuple[tuple[Vertex, ...], ...] = ()
    points: tuple[Vertex, ...] = ()
    is_box: bool = False

    @property
    def rings(self) -> list[tuple[Vertex, ...]]:
        return [r for area in self.areas for r in area]

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        vertices = [v for part in (*self.rings, *self.lines, self.points) for v in part]
        xs, ys = [v[0] for v in vertices], [v[1] for v in vertices]
        return min(xs), min(ys), max(xs), max(ys)

    @property
    def area_edges(self) -> list[list[Edge]]:
        return [[(r[i - 1], r[i]) for r in area for i in range(len(r))] for area in self.areas]

    @property
    def open_edges(self) -> list[Edge]:
        return [(a, b) for line in self.lines for a, b in zip(line, line[1:])] + [(p, p) for p in self.points]

    @property
    def edges(self) -> list[Edge]:
        return [e for area in self.area_edges for e in area] + self.open_edges


def _vertices(values: Sequence) -> tuple[Vertex, ...]:
    """Pairs, or a flat run of numbers, as vertices."""
    if values and not isinstance(values[0], (list, tuple)):
        if len(values) % 2:
            raise ValueError("a flat list of coordinates needs an even count")
        values = list(zip(values[0::2], values[1::2]))
    return tuple((float(v[0]), float(v[1])) for v in values)


def _ring(values: Sequence) -> tuple[Vertex, ...]:
    vertices = _vertices(values)
    if len(vertices) > 1 and vertices[0] == vertices[-1]:
        vertices = vertices[:-1]
    if len(vertices) < 3:
        raise ValueError("a polygon needs at least three different vertices")
    return vertices


def box_region(minx: float, miny: float, maxx: float, maxy: float) -> Region:
    corners = ((maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny))
    return Region(areas=((tuple((float(x), float(y)) for x, y in corners),),), is_box=True)


def polygon_region(vertices: Sequence) -> Region:
    """Polygon of pairs or of a flat list; closed if it is open."""
    return Region(areas=((_ring(vertices),),))


def geojson_region(obj: Mapping[str, Any]) -> Region:
    """GeoJSON geometry or Feature; anything else is an error."""
    geometry = obj.get("geometry") if obj.get("type") == "Feature" else obj
    kind = (geometry or {}).get("type")
    if kind == "GeometryCollection":
        parts = [geojson_region(g) for g in geometry["geometries"]]
        return Region(*(tuple(x for p in parts for x in getattr(p, f)) for f in ("areas", "lines", "points")))
    c = (geometry or {}).get("coordinates")
    if kind is None or c is None:
        raise ValueError(f"not a GeoJSON geometry: {obj!r}")
    if kind == "Point":
        return Region(points=_vertices([c]))
    if kind == "MultiPoint":
        return Region(points=_vertices(c))
    if kind == "LineString":
        return Region(lines=(_vertices(c),))
    if kind == "MultiLineString":
        return Region(lines=tuple(_vertices(x) for x in c))
    if kind == "Polygon":
        return Region(areas=(tuple(_ring(r) for r in c),))
    if kind == "MultiPolygon":
        return Region(areas=tuple(tuple(_ring(r) for r in p) for p in c))
    raise ValueError(f"unknown geometry type {kind!r}")


def region(
    bbox: Sequence[float] | None = None,
    polygon: Sequence | None = None,
    geojson: Mapping[str, Any] | None = None,
) -> Region | None:
    """Region of the first argument given in the order geojson, polygon, bbox; None when there is none."""
    if geojson is not None:
        return geojson_region(geojson)
    if polygon is not None:
        return polygon_region(polygon)
    if bbox is not None:
        return box_region(*bbox)
    return None


# ---- a literal region against columns ----------------------------------------------------------------------------


def boxes_overlap(a: Sequence[Column], b: Sequence) -> Column:
    """Two boxes (minx, miny, maxx, maxy) share at least a boundary point."""
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def _edge_literals(edges: Sequence[Edge]) -> Column:
    return F.array(
        *(F.struct(*(F.lit(v).alias(n) for n, v in zip(("px", "py", "qx", "qy"), (*p, *q)))) for p, q in edges)
    )


def _parity(px, py, qx, qy, x: Column, y: Column) -> Column:
    """The edge crosses the ray that runs from (x, y) to the right; a literal edge must not be level."""
    rise = F.nullif(qy - py, F.lit(0.0)) if isinstance(qy, Column) else qy - py
    return ((y < py) != (y < qy)) & (x < (qx - px) * (y - py) / rise + px)


def _inside(roi: Region, x: Column, y: Column) -> Column:
    """A point lies in one of the areas, by the parity of its edges; areas that overlap do not cancel each other."""
    areas = roi.area_edges
    if not areas:
        return F.lit(False)
    if len(roi.edges) <= UNROLL_EDGES:
        crossed = [[_parity(*p, *q, x, y) for p, q in edges if p[1] != q[1]] for edges in areas]
        return any_of(reduce(lambda a, b: a != b, tests) if tests else F.lit(False) for tests in crossed)
    return F.exists(F.array(*(_edge_literals(edges) for edges in areas)), lambda edges: _edges_inside(edges, x, y))


def _edge_meets_box(edge: Edge, box: Sequence[Column]) -> Column:
    """A literal segment and a closed box share a point: neither an axis nor the segment's normal separates them.

    Which corners lie farthest to either side is known from the direction, so two of the four are enough.
    """
    (px, py), (qx, qy) = edge
    minx, miny, maxx, maxy = box
    tests = [minx <= max(px, qx), maxx >= min(px, qx), miny <= max(py, qy), maxy >= min(py, qy)]
    dx, dy = qx - px, qy - py
    if dx and dy:
        y_low, y_high = (miny, maxy) if dx > 0 else (maxy, miny)
        x_low, x_high = (minx, maxx) if dy > 0 else (maxx, minx)
        tests.append(dx * (y_low - py) <= dy * (x_high - px))
        tests.append(dx * (y_high - py) >= dy * (x_low - px))
    return all_of(tests[1:]) & tests[0]


def _segment_meets_box(e: Column, box: Sequence[Column]) -> Column:
    """The same for a segment that is a column."""
    px, py, qx, qy = (e[n] for n in ("px", "py", "qx", "qy"))
    minx, miny, maxx, maxy = box
    dx, dy = qx - px, qy - py
    along, across = (dx * (miny - py), dx * (maxy - py)), (dy * (minx - px), dy * (maxx - px))
    return (
        (minx <= F.greatest(px, qx))
        & (maxx >= F.least(px, qx))
        & (miny <= F.greatest(py, qy))
        & (maxy >= F.least(py, qy))
        & (F.least(*along) <= F.greatest(*across))
        & (F.greatest(*along) >= F.least(*across))
    )


def region_meets_box(roi: Region, box: Sequence[Column]) -> Column:
    """A literal region and a box of columns share at least a boundary point."""
    coarse = boxes_overlap(box, [F.lit(v) for v in roi.bounds])
    if roi.is_box:
        return coarse
    edges = roi.edges
    if len(edges) <= UNROLL_EDGES:
        touch = any_of(_edge_meets_box(e, box) for e in edges)
    else:
        touch = F.exists(_edge_literals(edges), lambda e: _segment_meets_box(e, box))
    return coarse & (touch | _inside(roi, box[0], box[1]))


def region_meets_ring(roi: Region, ring: Column) -> Column:
    """A literal region and a ring of columns share at least a boundary point.  AND a box test before this one.

    Edges touch, or the ring starts inside of an area, or a part of the region starts inside of the ring.
    """
    edges = ring_edges(ring)
    first = F.element_at(ring, 1)
    starts = [(v, v) for v in (*(part[0] for part in (*roi.rings, *roi.lines)), *roi.points)]
    touch = F.exists(edges, lambda e: F.exists(_edge_literals(roi.edges), lambda f: _edges_touch(e, f)))
    held = F.exists(_edge_literals(starts), lambda v: _edges_inside(edges, v["px"], v["py"]))
    return touch | _inside(roi, first["x"], first["y"]) | held


def _on_segment(px, py, qx, qy, x: Column, y: Column) -> Column:
    inside = (x >= F.least(px, qx)) & (x <= F.greatest(px, qx)) & (y >= F.least(py, qy)) & (y <= F.greatest(py, qy))
    return inside & ((qx - px) * (y - py) == (qy - py) * (x - px))


def region_contains(roi: Region, x: Column, y: Column, strict: bool = True) -> Column:
    """A point of columns lies in a literal region; its boundary counts unless ``strict``, which asks each area by itself."""

    def on_border(edges: Sequence[Edge]) -> Column:
        if len(edges) <= UNROLL_EDGES:
            return any_of(_on_segment(*(F.lit(v) for v in (*p, *q)), x, y) for p, q in edges)
        return F.exists(_edge_literals(edges), lambda e: _on_segment(e["px"], e["py"], e["qx"], e["qy"], x, y))

    minx, miny, maxx, maxy = roi.bounds
    coarse = x.between(minx, maxx) & y.between(miny, maxy)
    if not strict:
        return coarse & (_inside(roi, x, y) | on_border(roi.edges))
    areas = [Region(areas=(a,)) for a in roi.areas]
    return coarse & any_of(_inside(a, x, y) & ~on_border(a.edges) for a in areas) if areas else F.lit(False)


# ---- rings that are columns: ARRAY<STRUCT<x, y>>, open (last vertex differs from the first) -----------------------


def box_ring(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    corners = ((minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy))
    return F.array(*(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners))


def open_ring(ring: Column) -> Column:
    """Ring without a repeated last vertex."""
    repeated = (F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    return F.when(repeated, F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)


def ring_from_flat(flat: Column) -> Column:
    """Ring of a flat ``[x, y, x, y, …]`` array."""
    n = F.floor(F.size(flat) / 2).cast("int")
    ring = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(F.element_at(flat, i * 2 - 1).alias("x"), F.element_at(flat, i * 2).alias("y")),
    )
    return open_ring(ring)


def ring_bounds(ring: Column) -> tuple[Column, Column, Column, Column]:
    xs, ys = F.transform(ring, lambda v: v["x"]), F.transform(ring, lambda v: v["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def ring_edges(ring: Column) -> Column:
    """Edges ``struct(px, py, qx, qy)``, the closing one included."""
    n = F.size(ring)

    def edge(i: Column) -> Column:
        p, q = F.element_at(ring, i + 1), F.element_at(ring, (i + 1) % n + 1)
        return F.struct(p["x"].alias("px"), p["y"].alias("py"), q["x"].alias("qx"), q["y"].alias("qy"))

    return F.transform(F.sequence(F.lit(0), n - 1), edge)


def _edges_inside(edges: Column, x: Column, y: Column) -> Column:
    return F.aggregate(
        edges,
        F.lit(False),
        lambda acc, e: acc != F.coalesce(_parity(e["px"], e["py"], e["qx"], e["qy"], x, y), F.lit(False)),
    )


def ring_contains(ring: Column, x: Column, y: Column, strict: bool = True) -> Column:
    """A point lies in a ring; its boundary counts unless ``strict``."""
    edges = ring_edges(ring)
    inner = _edges_inside(edges, x, y)
    border = F.exists(edges, lambda e: _on_segment(e["px"], e["py"], e["qx"], e["qy"], x, y))
    return inner & ~border if strict else inner | border


def _turn(e: Column, x: Column, y: Column) -> Column:
    return F.signum((e["qx"] - e["px"]) * (y - e["py"]) - (e["qy"] - e["py"]) * (x - e["px"]))


def _edges_touch(e: Column, f: Column) -> Column:
    proper = (_turn(e, f["px"], f["py"]) * _turn(e, f["qx"], f["qy"]) < 0) & (
        _turn(f, e["px"], e["py"]) * _turn(f, e["qx"], e["qy"]) < 0
    )

    def on(g: Column, h: Column, end: str) -> Column:
        return _on_segment(g["px"], g["py"], g["qx"], g["qy"], h[end + "x"], h[end + "y"])

    return proper | on(e, f, "p") | on(e, f, "q") | on(f, e, "p") | on(f, e, "q")


def rings_meet(a: Column, b: Column) -> Column:
    """Two rings share at least a boundary point.  AND a box test before this one: array lambdas are interpreted."""
    ea, eb = ring_edges(a), ring_edges(b)
    first_a, first_b = F.element_at(a, 1), F.element_at(b, 1)
    touch = F.exists(ea, lambda e: F.exists(eb, lambda f: _edges_touch(e, f)))
    return touch | _edges_inside(ea, first_b["x"], first_b["y"]) | _edges_inside(eb, first_a["x"], first_a["y"])


def edges_meet_box(edges: Column, box: Sequence[Column]) -> Column:
    """A ring given by its edges and a box share at least a boundary point.

    A lambda, although interpreted, is the quicker form here: unrolled over a handful of edges the test makes the generated
    method of the whole join too long for the JVM to compile.
    """
    return F.exists(edges, lambda e: _segment_meets_box(e, box)) | _edges_inside(edges, box[0], box[1])


def ring_ends(ring: Column) -> Column:
    """The leftmost, rightmost, lowest and highest vertex of a ring, for ``ends_show_meeting``."""
    turned = F.transform(ring, lambda v: F.struct(v["y"].alias("y"), v["x"].alias("x")))
    ends = {"left": F.array_min(ring), "right": F.array_max(ring), "low": F.array_min(turned), "high": F.array_max(turned)}
    return F.struct(*(F.struct(v["x"].alias("x"), v["y"].alias("y")).alias(n) for n, v in ends.items()))


def ends_show_meeting(ends: Column, box: Sequence[Column]) -> Column:
    """True only for a ring and a box that meet: an end lies in the box, or the box, which meets the ring's own, is wider or higher than that.

    This is compiled and settles most pairs, so that only the others are looked at edge by edge.
    """
    minx, miny, maxx, maxy = box
    left, right, low, high = (ends[n] for n in ("left", "right", "low", "high"))
    inside = any_of((minx <= v["x"]) & (v["x"] <= maxx) & (miny <= v["y"]) & (v["y"] <= maxy) for v in (left, right, low, high))
    wider, higher = (minx <= left["x"]) & (right["x"] <= maxx), (miny <= low["y"]) & (high["y"] <= maxy)
    over, beside = (miny <= high["y"]) & (low["y"] <= maxy), (minx <= right["x"]) & (left["x"] <= maxx)
    return inside | (wider & over) | (higher & beside)


def ring_is_simple(ring: Column) -> Column:
    """No two edges of the ring cross, none has zero length and only neighbours touch: the ring bounds one area."""
    edges = ring_edges(ring)
    n = F.size(ring)
    indexed = F.transform(edges, lambda e, i: F.struct(e.alias("e"), i.alias("i")))
    clash = F.exists(
        indexed,
        lambda a: F.exists(
            indexed,
            lambda b: (b["i"] > a["i"] + 1) & ~((a["i"] == 0) & (b["i"] == n - 1)) & _edges_touch(a["e"], b["e"]),
        ),
    )
    point = F.exists(edges, lambda e: (e["px"] == e["qx"]) & (e["py"] == e["qy"]))
    return (n >= 3) & ~point & ~clash


GEOJSON_TYPE = "type string, coordinates array<array<array<double>>>"


def ring_geojson(ring: Column) -> Column:
    """GeoJSON text of a polygon with this ring, closed as the format wants it."""
    closed = F.concat(ring, F.slice(ring, 1, 1))
    outer = F.transform(closed, lambda v: F.array(v["x"], v["y"]))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(outer).alias("coordinates")))


def ring_from_geojson(text: Column) -> Column:
    """Open outer ring of a polygon's GeoJSON text; NULL for other geometries."""
    shape = F.from_json(text, GEOJSON_TYPE)
    outer = F.transform(
        F.try_element_at(shape["coordinates"], F.lit(1)),
        lambda p: F.struct(F.element_at(p, 1).alias("x"), F.element_at(p, 2).alias("y")),
    )
    return F.when(shape["type"] == "Polygon", open_ring(outer))
