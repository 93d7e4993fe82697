import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from firnflow.functions import projections, rings, tiles


# ---- exact reference -------------------------------------------------------------------------------------------------
def cross(a, b, p):
    return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])


def on(a, b, p):
    return cross(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def edges(ring):
    return [(ring[i], ring[(i + 1) % len(ring)]) for i in range(len(ring))]


def inside(ring, p):
    odd = False
    for a, b in edges(ring):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < Fraction(b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
            odd = not odd
    return odd


def touch(e, f):
    (a, b), (c, d) = e, f
    if cross(a, b, c) * cross(a, b, d) < 0 and cross(c, d, a) * cross(c, d, b) < 0:
        return True
    return on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b)


def meet(r, s):
    return any(touch(e, f) for e in edges(r) for f in edges(s)) or inside(r, s[0]) or inside(s, r[0])


def star(rng, n, span):
    """Star-shaped ring on an integer grid, so that touching cases occur."""
    cx, cy = rng.randint(-span, span), rng.randint(-span, span)
    turns = sorted(rng.sample(range(24), n))
    return [(cx + round(rng.randint(2, 5) * math.cos(t * math.pi / 12)), cy + round(rng.randint(2, 5) * math.sin(t * math.pi / 12))) for t in turns]


def as_ring(ring):
    return [(float(x), float(y)) for x, y in ring]


RING = "array<struct<x:double,y:double>>"


def test_rings_meet_and_contain(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        a, b = star(rng, rng.randint(3, 6), 6), star(rng, rng.randint(3, 5), 6)
        p = (rng.randint(-8, 8), rng.randint(-8, 8))
        border = any(on(*e, p) for e in edges(a))
        rows.append((as_ring(a), as_ring(b), float(p[0]), float(p[1]), meet(a, b), inside(a, p) and not border, inside(a, p) or border))
    df = spark.createDataFrame(rows, f"a {RING}, b {RING}, x double, y double, meets boolean, within boolean, covered boolean")
    got = df.select(
        (rings.rings_meet(F.col("a"), F.col("b")) == F.col("meets")).alias("m"),
        (rings.ring_contains(F.col("a"), F.col("x"), F.col("y")) == F.col("within")).alias("w"),
        (rings.ring_contains(F.col("a"), F.col("x"), F.col("y"), strict=False) == F.col("covered")).alias("c"),
    )
    assert got.where("not (m and w and c)").count() == 0
    assert 50 < df.where("meets").count() < 350 and df.where("covered and not within").count() > 5


@pytest.mark.parametrize("unroll", [True, False])
def test_region_meets_box(spark, monkeypatch, unroll):
    if not unroll:
        monkeypatch.setattr(rings, "UNROLL_EDGES", 0)
    rng = random.Random(11)
    boxes = []
    for i in range(300):
        x, y, w, h = rng.randint(-12, 10), rng.randint(-12, 10), rng.randint(0, 5), rng.randint(0, 5)
        boxes.append((i, float(x), float(y), float(x + w), float(y + h)))
    df = spark.createDataFrame(boxes, "i int, x0 double, y0 double, x1 double, y1 double").cache()
    box = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    for _ in range(4):
        ring = star(rng, 5, 4)
        roi = rings.polygon_region(ring)
        got = {r.i for r in df.where(rings.region_meets_box(roi, box)).collect()}
        want = {b[0] for b in boxes if meet(ring, [(b[1], b[2]), (b[3], b[2]), (b[3], b[4]), (b[1], b[4])])}
        assert got == want
        column = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in as_ring(ring)))
        assert {r.i for r in df.where(rings.edges_meet_box(rings.ring_edges(column), box)).collect()} == want
        p = {r.i for r in df.where(rings.region_contains(roi, F.col("x0"), F.col("y0"))).collect()}
        assert p == {b[0] for b in boxes if inside(ring, b[1:3]) and not any(on(*e, b[1:3]) for e in edges(ring))}


@pytest.mark.parametrize("unroll", [True, False])
def test_parts_of_a_region(spark, monkeypatch, unroll):
    """Overlapping polygons, one with a hole, a line and a point against boxes and their rings; both forms of the predicate."""
    if not unroll:
        monkeypatch.setattr(rings, "UNROLL_EDGES", 0)
    square = lambda x, y, n: [[x, y], [x + n, y], [x + n, y + n], [x, y + n], [x, y]]
    shapes = [
        {"type": "MultiPolygon", "coordinates": [[square(0, 0, 8)], [square(4, 4, 8)]]},
        {"type": "Polygon", "coordinates": [square(-20, -20, 10), square(-18, -18, 6)]},
        {"type": "LineString", "coordinates": [[20, 0], [20, 9]]},
        {"type": "Point", "coordinates": [-20, 5]},
    ]
    roi = rings.geojson_region({"type": "GeometryCollection", "geometries": shapes})
    rng = random.Random(3)
    rows = []
    for i in range(500):
        x, y = rng.randint(-22, 21), rng.randint(-22, 13)
        a, b = x + rng.randint(0, 3) + 0.5, y + rng.randint(0, 3) + 0.5
        over = lambda p, q, r, s: x <= r and a >= p and y <= s and b >= q
        ring = over(-20, -20, -10, -10) and not (x > -18 and a < -12 and y > -18 and b < -12)
        meets = over(0, 0, 8, 8) or over(4, 4, 12, 12) or ring or over(20, 0, 20, 9) or over(-20, 5, -20, 5)
        strictly = lambda lo, hi: lo < x < hi and lo < y < hi
        rows.append((i, float(x), float(y), a, b, meets, strictly(0, 8) or strictly(4, 12) or strictly(-20, -10) and not (-18 <= x <= -12 and -18 <= y <= -12)))
    df = spark.createDataFrame(rows, "i int, x0 double, y0 double, x1 double, y1 double, meets boolean, within boolean")
    box = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    bad = df.where((rings.region_meets_box(roi, box) != F.col("meets")) | (rings.region_meets_ring(roi, rings.box_ring(*box)) != F.col("meets")))
    assert bad.count() == 0 and 20 < df.where("meets").count() < 400
    assert df.where(rings.region_contains(roi, F.col("x0"), F.col("y0")) != F.col("within")).count() == 0


def test_region_input_forms():
    flat = rings.polygon_region([0, 0, 4, 0, 4, 4, 0, 0])
    pairs = rings.polygon_region([(0, 0), (4, 0), (4, 4)])
    assert flat == pairs and flat.bounds == (0, 0, 4, 4)
    point = {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}}
    assert rings.region(bbox=(0, 0, 1, 1), polygon=[0, 0, 1, 0, 1, 1], geojson=point).points == ((1.0, 2.0),)
    assert rings.region(bbox=(0, 0, 1, 1), polygon=[0, 0, 4, 0, 4, 4]) == flat
    assert rings.region(bbox=(0, 0, 1, 1)).is_box
    assert rings.region() is None
    for bad in ({}, {"type": "Feature", "geometry": None}, {"type": "Blob", "coordinates": []}):
        with pytest.raises(ValueError):
            rings.geojson_region(bad)
    with pytest.raises(ValueError):
        rings.polygon_region([(0, 0), (1, 1)])


def test_ring_helpers(spark):
    row = spark.range(1).select(
        rings.ring_from_flat(F.array(*(F.lit(float(v)) for v in (0, 0, 4, 0, 4, 4, 0, 0)))).alias("r"),
        rings.ring_is_simple(rings.box_ring(*(F.lit(v) for v in (0, 0, 1, 1)))).alias("ok"),
    ).first()
    assert [(p.x, p.y) for p in row.r] == [(0, 0), (4, 0), (4, 4)]
    assert row.ok


@pytest.mark.parametrize(
    ("lat", "lon", "name"),
    [
        (75, -45, "N70W040"),
        (-76.1, -10, "S70W010"),
        (33.5, 76.2, "N30E070"),
        (0, 0, "N00E000"),
        (90, 0, "N80E000"),
        (0, 180, "N00E170"),
        (0, -100, "N00W100"),
    ],
)
def test_point_tile(spark, lat, lon, name):
    lat_c, lon_c = F.lit(float(lat)), F.lit(float(lon))
    row = spark.range(1).select(tiles.point_tile(lat_c, lon_c).alias("t"), tiles.point_tile(lat_c, lon_c, "/a/").alias("p")).first()
    assert (row.t, row.p) == (name, f"/a/{name}")


@pytest.mark.parametrize(
    ("box", "names"),
    [
        ((-50, 65, -40, 75), {"N70W050", "N70W040"}),
        ((-49, 66, -46, 74), {"N70W050"}),
        ((0, 0, 0, 0), {"N00E000"}),
        ((170, -5, 180, 5), {"N00E170", "N00E180", "S10E170", "S10E180", "N10E170", "N10E180"}),
    ],
)
def test_tile_cover(spark, box, names):
    got = spark.range(1).select(F.explode(tiles.cover_tiles(*(F.lit(float(v)) for v in box))).alias("t")).select("t.tile")
    found = {r.tile for r in got.collect()}
    assert names <= found
    for r in found:
        lat, lon = int(r[1:3]) * (1 if r[0] == "N" else -1), int(r[4:]) * (1 if r[3] == "E" else -1)
        assert lon - 5 <= box[2] and lon + 5 >= box[0] and lat - 5 <= box[3] and lat + 5 >= box[1]


def test_region_tiles(spark):
    assert tiles.region_tiles(spark, rings.polygon_region([-50, 65, -40, 65, -40, 75, -50, 75])) == [
        f"N{lat}W{lon:03d}" for lat in (60, 70, 80) for lon in (40, 50)
    ]
    # A thin triangle meets fewer tiles than its box does.
    thin = rings.polygon_region([-48, 66, -12, 102, -47, 66])
    assert len(tiles.region_tiles(spark, thin)) < len(tiles.region_tiles(spark, rings.box_region(*thin.bounds)))


# ---- projections -----------------------------------------------------------------------------------------------------
def run(spark, pair, rows):
    df = spark.createDataFrame(rows, "a double, b double, epsg int")
    x, y = pair(F.col("a"), F.col("b"), F.col("epsg"))
    return [(r.x, r.y) for r in df.select(x.alias("x"), y.alias("y")).collect()]


def test_central_meridian(spark):
    (x, y), (e, n) = run(spark, projections.project, [(-45.0, 75.0, 3413), (3.0, 0.0, 32631)])
    assert abs(x) < 1e-6 and y < 0
    assert abs(e - 500000) < 1e-6 and abs(n) < 1e-6


def test_published_polar_example():
    """The worked example of the guidance note for variant B: true scale at 71 S, meridian 70 E, both offsets 6000000."""
    system = projections.PolarSystem(-71.0, 70.0, -1)
    s, e2 = math.sin(math.radians(75)), projections.ECC
    t = math.tan(math.pi / 4 - math.radians(75) / 2) / ((1 - e2 * s) / (1 + e2 * s)) ** (e2 / 2)
    rho = t * projections.polar_scale(system.lat_ts)
    assert abs(rho * math.sin(math.radians(50)) + 6000000 - 7255380.79) < 0.01
    assert abs(rho * math.cos(math.radians(50)) + 6000000 - 7053389.56) < 0.01


@pytest.mark.parametrize("systems", [None, "known"])
def test_round_trips(spark, systems):
    rng = random.Random(5)
    rows = [(rng.uniform(-180, 180), rng.uniform(60, 89.9), 3413) for _ in range(50)]
    rows += [(rng.uniform(-180, 180), rng.uniform(-89.9, -60), 3031) for _ in range(50)]
    rows += [(zone * 6 - 183 + rng.uniform(-3, 3), rng.uniform(0, 80), 32600 + zone) for zone in (1, 17, 33, 60)]
    rows += [(zone * 6 - 183 + rng.uniform(-3, 3), rng.uniform(-80, 0), 32700 + zone) for zone in (1, 17, 33, 60)]
    rows += [(12.5, 47.25, 4326)]
    parts = [rows] if systems is None else [[r for r in rows if r[2] == c] for c in sorted({r[2] for r in rows})]
    for part in parts:
        known = None if systems is None else [part[0][2]]
        df = spark.createDataFrame(part, "lon double, lat double, epsg int")
        x, y = projections.project(F.col("lon"), F.col("lat"), F.col("epsg"), known)
        there = df.withColumns({"x": x, "y": y})
        lon, lat = projections.unproject(F.col("x"), F.col("y"), F.col("epsg"), known)
        worst = there.select(F.greatest(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).alias("d")).first().d
        assert worst < 1e-9


def test_far_from_the_zone(spark):
    """Back to the same place 75 degrees from the meridian; no place where the series have no sum."""
    rows = [(3.0 + turn, lat, 32631) for turn in (-75.0, 60.0, 75.0) for lat in (0.5, 10.0, 55.0)]
    there = run(spark, projections.project, rows)
    back = run(spark, projections.unproject, [(x, y, 32631) for x, y in there])
    assert max(abs(a - c) + abs(b - d) for (a, b, _), (c, d) in zip(rows, back)) < 2e-6
    assert run(spark, projections.unproject, [(45e6, 1e6, 32631), (-20e6, 1e6, 32731)]) == [(None, None)] * 2


def test_meridian_arc(spark):
    """Northing on the central meridian is the scaled arc length, here summed numerically."""
    phi, steps = math.radians(60), 200000
    e2, a = projections.E2, projections.SEMI_MAJOR
    h = phi / steps
    arc = sum(a * (1 - e2) / (1 - e2 * math.sin((i + 0.5) * h) ** 2) ** 1.5 for i in range(steps)) * h
    ((_, n),) = run(spark, projections.project, [(3.0, 60.0, 32631)])
    assert abs(n - 0.9996 * arc) < 1e-4


def test_working_system(spark):
    rows = [(0.0, -66.0, 3031), (0.0, 66.0, 3413), (-140.5, 60.0, 32607), (170.0, -45.0, 32759), (5.0, 60.0, 32632), (10.0, 0.0, 32632)]
    df = spark.createDataFrame(rows, "lon double, lat double, want int")
    assert df.where(projections.working_epsg(F.col("lon"), F.col("lat")) != F.col("want")).count() == 0


def test_unknown_system(spark):
    with pytest.raises(ValueError):
        projections.project(F.lit(1.0), F.lit(2.0), 2154)
    assert run(spark, projections.project, [(1.0, 2.0, 2154)]) == [(None, None)]


def test_missing_and_unknown_systems(spark):
    """Whatever the list of systems holds, a code that is missing, unknown or not listed gives NULL."""
    rows = spark.createDataFrame([(10.0, 70.0, None), (10.0, 70.0, 3573), (10.0, 70.0, 3413)], "lon double, lat double, code int")
    for listed in ([3413], [3413, 3031], [3413, 3031, 32632, 32633], [3413, 3573], None):
        x, y = projections.project(F.col("lon"), F.col("lat"), F.col("code"), listed)
        got = [r[0] is None for r in rows.select(x, "code").collect()]
        assert got == [True, True, False], listed
    x, _ = projections.project(F.col("lon"), F.col("lat"), F.col("code"), [32632])
    assert [r[0] for r in rows.select(x).collect()] == [None] * 3
