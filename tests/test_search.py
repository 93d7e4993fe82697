import random

import pytest
from pyspark.sql import functions as F

from firnflow.functions import rings
from firnflow.operators import bounded, locate, search, subcube
from firnflow.plans.queries import QUERIES
from firnflow.plans.views import view
from firnflow.sources import catalog

PERIOD = {"start": "1990-01-01", "end": "2025-12-31"}


@pytest.fixture(scope="module")
def granules(spark, sf_dir):
    return view(spark, sf_dir, "granules")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_pruning_changes_nothing_and_skips_folders(spark, granules, tmp_path):
    path = str(tmp_path / "catalog")
    catalog.write_catalog(granules, path, files=6)
    stored = catalog.read_hive_catalog(spark, path, merge=False)
    index_path = str(tmp_path / "index")
    search.tile_index(stored).write.parquet(index_path)
    index = spark.read.parquet(index_path)
    for where in ({"bbox": (-50, 65, -40, 75)}, {"polygon": [-50, 65, -42, 64, -40, 70, -44, 75, -50, 73]}):
        pruned = search.search(stored, tile_index=index, **where, **PERIOD)
        plain = search.search(stored, **where, **PERIOD)
        straight = search.search(granules, **where, **PERIOD)
        assert rows_of(pruned) == rows_of(plain) == rows_of(straight) != []
        plan = pruned._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan.lower()
        assert "PushedFilters: [" in plan and "LessThanOrEqual(minx" in plan
        assert "version" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_no_region_no_rows(granules):
    assert search.search(granules, **PERIOD).count() == 0


@pytest.mark.parametrize("max_degrees", [16.0, 1.0])
@pytest.mark.parametrize("rows", [200_000, 0])
def test_many_regions_like_a_nested_loop(spark, sf_dir, granules, rows, max_degrees):
    """Broadcast and salted shuffle, and boxes beyond the largest level, all give the pairs of a nested loop."""
    wide = granules.withColumn("maxx", F.when(F.col("granule_id") % 50 == 0, F.col("maxx") + 40).otherwise(F.col("maxx")))
    rois = view(spark, sf_dir, "rois").select("roi_id", *("roi_" + n for n in search.BOX))
    pairs = search.search_many(wide, rois, max_degrees=max_degrees, rows=rows).select("roi_id", "granule_id")
    want = wide.crossJoin(rois).where(
        "minx <= roi_maxx and maxx >= roi_minx and miny <= roi_maxy and maxy >= roi_miny"
    ).select("roi_id", "granule_id")
    assert rows_of(pairs) == rows_of(want)
    if not rows:
        plan = pairs._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" not in plan and "_salt" in plan


@pytest.mark.parametrize(("base", "most"), [(0.3, 1.2), (0.1, 0.0), (7.0, 0.7)])
def test_grid_join_on_touching_decimals(spark, base, most):
    """Boxes on a grid of tenths, where sides equal cells and neighbours touch, although tenths are not exact."""
    rng = random.Random(4)

    def boxes(n, widest):
        for i in range(n):
            x, y, w, h = rng.randint(-40, 40), rng.randint(-40, 40), rng.randint(0, widest), rng.randint(0, widest)
            yield i, x * 0.1, y * 0.1, (x + w) * 0.1, (y + h) * 0.1

    big = spark.createDataFrame(list(boxes(400, 15 if most else 0)), "g int, ax double, ay double, bx double, by double")
    small = spark.createDataFrame(list(boxes(60, 9)), "s int, px double, py double, qx double, qy double")
    here, there = [F.col(c) for c in ("ax", "ay", "bx", "by")], [F.col(c) for c in ("px", "py", "qx", "qy")]
    want = rows_of(big.crossJoin(small).where(rings.boxes_overlap(here, there)).select("g", "s"))
    for rows in (200_000, 0):
        got = bounded.grid_join(big, small, here, there, base, most, rows=rows, salt_by=["g"])
        assert rows_of(got.select("g", "s")) == want != []


@pytest.mark.parametrize("rows", [200_000, 0])
def test_many_rings_carry_other_columns(spark, sf_dir, granules, rows):
    """Rings and further columns join the pairs of boxes by region, broadcast or shuffled."""
    rois = view(spark, sf_dir, "rois").withColumn("name", F.concat(F.lit("r"), "roi_id"))
    names = ["roi_" + n for n in search.BOX]
    rois = rois.withColumn("roi_ring", rings.box_ring(*(F.col(n) for n in names))).select("roi_id", *names, "roi_ring", "name")
    got = search.search_many(granules, rois, rows=rows)
    plain = search.search_many(granules, rois.select("roi_id", *names))
    assert rows_of(got.select("roi_id", "granule_id")) == rows_of(plain.select("roi_id", "granule_id")) != []
    assert got.where("name <> concat('r', roi_id)").count() == 0


def test_many_rings_without_a_shuffle_of_pairs(spark, sf_dir, granules, monkeypatch):
    """Rings that are too many to be broadcast are listed in the cells; the pairs of large ones still join by region."""
    names = ["roi_" + n for n in search.BOX]
    ring = rings.box_ring(*(F.col(n) for n in names))
    middle = F.array(F.struct(((F.col("roi_minx") + F.col("roi_maxx")) / 2).alias("x"), F.col("roi_miny").alias("y")))
    rois = view(spark, sf_dir, "rois").select("roi_id", *names, F.when(F.col("roi_id") % 2 == 0, ring).otherwise(F.concat(ring, middle)).alias("roi_ring"))
    want = rows_of(search.search_many(granules, rois).select("roi_id", "granule_id"))
    listed = search.search_many(granules, rois, rows=0).select("roi_id", "granule_id")
    assert rows_of(listed) == want != []
    assert listed._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin") == 1
    monkeypatch.setattr(search, "LISTED_VERTICES", 4)
    assert rows_of(search.search_many(granules, rois, rows=0).select("roi_id", "granule_id")) == want


def test_ends_show_meeting(spark):
    """Never true for a ring and a box that do not meet, touching ones included, and true for most that do."""
    rng = random.Random(8)
    pick = lambda n: [(float(rng.randint(0, 9)), float(rng.randint(0, 9))) for _ in range(n)]
    rows = []
    for i in range(1500):
        (ax, ay), (bx, by) = pick(2)
        rows.append((i, pick(rng.randint(3, 6)), min(ax, bx), min(ay, by), max(ax, bx), max(ay, by)))
    frame = spark.createDataFrame(rows, "id int, ring array<struct<x:double,y:double>>, ax double, ay double, bx double, by double")
    box = [F.col(n) for n in ("ax", "ay", "bx", "by")]
    told = frame.withColumns({"told": rings.ends_show_meeting(rings.ring_ends(F.col("ring")), box), "meets": rings.edges_meet_box(rings.ring_edges(F.col("ring")), box)})
    counts = {(r["told"], r["meets"]): r["count"] for r in told.groupBy("told", "meets").count().collect()}
    assert counts.get((True, False), 0) == 0 and counts[True, True] > counts[False, True] and counts[False, False] > 0


def test_ring_footprints(spark, granules):
    ring = rings.box_ring(*(F.col(n) for n in search.BOX))
    shaped = granules.withColumn("footprint", ring)
    where = {"polygon": [-50, 65, -42, 64, -40, 70, -44, 75, -50, 73], **PERIOD}
    assert rows_of(search.search(shaped, **where)) == rows_of(search.search(granules, **where))
    point = {"geojson": {"type": "Point", "coordinates": [-45, 75]}, **PERIOD}
    assert rows_of(search.search(shaped, **point)) == rows_of(search.search(granules, **point))


def test_stream_of_hrefs(granules):
    found = search.search(granules, bbox=(-70, 60, -30, 85), **PERIOD)
    got = list(search.stream_hrefs(found))
    assert len(got) == len(set(got)) == found.count()


def test_assets(spark):
    items = [
        (1, {"data": ("a.nc", ["data"]), "t": ("a.png", ["thumbnail"])}),
        (2, {"data": ("b.tif", ["data"])}),
        (3, {"x": ("c1.nc", ["data"]), "y": ("c2.nc", ["data", "extra"])}),
        (4, {"x": ("d.nc", None)}),
    ]
    df = spark.createDataFrame(items, "id int, assets " + search.ASSETS_TYPE)
    assert rows_of(search.data_assets(df).select("id", "href")) == [(1, "a.nc"), (3, "c1.nc"), (3, "c2.nc")]
    assert search.data_assets(df, first_only=True).count() == 2


def test_cubes_from_items(spark):
    base = "https://data.s3.amazonaws.com/datacubes/v2/N70W040/"
    items = [
        (1, {"d": (base + "ICE_vel_EPSG3413_G0120_X-50000_Y-1650000.zarr", ["data"])}, None),
        (2, {"d": ("https://elsewhere.org/x.zarr", ["data"])}, "EPSG:3031"),
        (3, {"d": ("https://elsewhere.org/x.nc", ["data"])}, "EPSG:3031"),
    ]
    df = spark.createDataFrame(items, "id int, assets " + search.ASSETS_TYPE + ", `proj:code` string")
    got = {r.id: r for r in locate.cubes_from_items(df).collect()}
    assert set(got) == {1, 2}
    assert got[1].epsg == "3413" and got[2].epsg == "3031"
    want = "https://data.s3.amazonaws.com/composites/annual/v2-updated-september2025/N70W040/ICE_velocity_EPSG3413_120m_X-50000_Y-1650000.zarr"
    assert got[1].composite_zarr_url == want and got[2].composite_zarr_url == ""


CUBES = "cube_id long, epsg int, minx double, miny double, maxx double, maxy double, xmin double, ymin double, xmax double, ymax double"


def test_first_cube_on_shared_edges_and_origin(spark):
    cubes = spark.createDataFrame(
        [(2, 4326, 0.0, 0.0, 10.0, 10.0, 0.0, 0.0, 10.0, 10.0), (1, 4326, -10.0, -10.0, 0.0, 0.0, -10.0, -10.0, 0.0, 0.0)], CUBES
    )
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 5.0), (3, 20.0, 0.0), (4, 10.0, 10.0)], "point_id int, lon double, lat double")
    for rows in (200_000, 0):
        found = locate.first_cube(points, cubes, rows=rows)
        assert rows_of(found.select("point_id", "cube_id")) == [(1, 1), (2, 2), (4, 2)]
        assert [r.point_id for r in locate.missing_points(points, found).collect()] == [3]
    assert locate.first_cube(points, cubes, strict=True).select("point_id").collect()[0].point_id == 2


def test_find_cubes_for(spark):
    cubes = spark.createDataFrame(
        [(2, 4326, 0.0, 0.0, 10.0, 10.0, 0.0, 0.0, 10.0, 10.0), (1, 4326, -10.0, -10.0, 0.0, 0.0, -10.0, -10.0, 0.0, 0.0)], CUBES
    )
    assert locate.find_cubes_for(cubes, []).count() == 0
    assert locate.find_cubes_for(cubes, [(0.0, 0.0)]).count() == 2
    assert locate.find_cubes_for(cubes, [(1, 1), (2, 1), (2, 2)]).first().cube_id == 2
    with pytest.raises(ValueError):
        locate.find_cubes_for(cubes, [(0, 0), (1, 1)])


def test_nearest_index_by_brute_force(spark):
    rows = []
    for x0, dx, n in ((0.0, 240.0, 6), (1200.0, -240.0, 6)):
        axis = [x0 + i * dx for i in range(n)]
        for k in range(-10, 30):
            v = k * 60.0
            best = min(range(n), key=lambda i: (abs(axis[i] - v), -axis[i]))
            rows.append((x0, dx, n, v, best, axis, axis[best]))
    df = spark.createDataFrame(rows, "x0 double, dx double, n int, v double, best int, axis array<double>, value double")
    c = F.col
    wrong = (locate.nearest_index(c("v"), c("x0"), c("dx"), c("n")) != c("best")) | (locate.nearest_on_axis(c("axis"), c("v")) != c("value"))
    assert df.where(wrong).count() == 0


def test_nearest_index_by_a_hair(spark):
    """The meridian of 180 degrees west: a tenth of a nanometre nearer to one of two centres is no tie."""
    rows = spark.createDataFrame([(-1e-10, 2e5, 5), (0.0, 2e5, 6), (1e-10, 2e5, 6), (-1e-10, -2e5, 6), (0.0, -2e5, 5), (1e-10, -2e5, 5)], "v double, dx double, best int")
    index = locate.nearest_index(F.col("v"), F.col("dx") * -5.5, F.col("dx"), F.lit(12))
    assert rows.where(index != F.col("best")).collect() == []


def test_two_step_lookup(spark):
    """Degrees and cube boxes disagree on purpose; all systems are degrees, so that a metre is a unit here."""
    big = 30_000.0
    cubes = spark.createDataFrame(
        [
            (1, 4326, 0.0, 0.0, big, big, 0.0, 0.0, 20_000.0, 20_000.0),
            (2, 4326, big, 0.0, 2 * big, big, 20_000.0, 0.0, 60_000.0, 30_000.0),
            (3, 4326, -big, -big, 0.0, 0.0, -big, -big, 0.0, 0.0),
        ],
        CUBES,
    )
    points = spark.createDataFrame(
        [
            (1, 10.0, 10.0),  # in both boxes
            (2, 25_000.0, 10.0),  # moved east by 10 km into the next cube, whose box holds it
            (3, 25_000.0, 25_000.0),  # north is tested before east: moved to where no cube is
            (4, 20_000.0, 500.0),  # on the edge: moved back inside, found again, but not strictly within
            (5, 99_000.0, 0.0),  # in no cube
        ],
        "point_id int, x double, y double",
    ).withColumn("epsg", F.lit(4326))
    for rows in (200_000, 0):
        got = {r.point_id: (r.cube_id, r.status) for r in locate.locate_two_step(points, cubes, 10_000.0, rows).collect()}
        assert got == {
            1: (1, "direct"),
            2: (2, "offset"),
            3: (None, "no_cube_after_offset"),
            4: (None, "not_in_box_after_offset"),
            5: (None, "no_cube"),
        }


def test_around_points_is_strict(spark):
    cells = spark.createDataFrame([(float(x), float(y)) for x in range(0, 2000, 100) for y in range(0, 2000, 100)], "x double, y double")
    points = spark.createDataFrame([(1, 950.0, 1000.0), (2, 0.0, 0.0)], "p int, px double, py double")
    for rows in (200_000, 0):
        got = subcube.around_points(cells, points, 200.0, rows=rows)
        want = cells.crossJoin(points).where("abs(x - px) < 200 and abs(y - py) < 200")
        assert rows_of(got.select("p", "x", "y")) == rows_of(want.select("p", "x", "y"))


def test_salted_join_keeps_every_row(spark):
    rng = random.Random(1)
    big = spark.createDataFrame([(7 if rng.random() < 0.4 else rng.randint(0, 30), i) for i in range(3000)], "k int, i int")
    small = spark.createDataFrame([(k, k * k) for k in range(0, 30, 2)] + [(7, 1), (7, 2)], "k int, s int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows_of(bounded.join_salted(big, small, ["k"], ["i"], how)) == rows_of(big.join(small, "k", how))
    with pytest.raises(ValueError):
        bounded.join_salted(big, small, ["k"], ["i"], "full")


def test_hot_key_is_spread(spark):
    """A third of all rows share one key; in the shuffle no partition gets more than a fair part of them."""
    big = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"), "id")
    small = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("s"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = bounded.join_bounded(big, small, ["k"], rows=0, salt_by=["id"])
        parts = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(parts) == 60_000 and max(parts) < 15_000


def test_series_by_either_join(spark):
    from firnflow.operators import series

    tables = [view(spark, "/root/testdata/sf0.01", n) for n in ("points", "cubes", "observations")]
    names = ["point_id", "mid_date", "v", "v_error", "satellite_img1", "x", "y"]
    small, large = (series.time_series(*tables, rows=rows).select(names) for rows in (200_000, 0))
    assert small.count() > 0 and small.exceptAll(large).count() == 0 == large.exceptAll(small).count()


def test_boxes_by_either_join(spark):
    cubes = spark.createDataFrame([(1, 4326, 0.0, 0.0, 100.0, 100.0, 0.0, 0.0, 100.0, 100.0)], CUBES)
    cells = spark.createDataFrame([(c, float(x), float(y)) for c in (1, 2) for x in range(0, 100, 5) for y in range(0, 100, 5)], "cube_id long, x double, y double")
    boxes = spark.createDataFrame(
        [(1, 10.0, 10.0, 30.0, 20.0, 4326), (2, 10.0, 10.0, 30.0, 20.0, 3413), (3, 500.0, 500.0, 600.0, 600.0, 4326)],
        "box_id int, b_minx double, b_miny double, b_maxx double, b_maxy double, epsg int",
    )
    for rows in (200_000, 0):
        cut = subcube.in_boxes(cells, boxes, cubes, base=7.0, rows=rows)
        assert rows_of(cut.select("box_id", "cube_id", "x", "y")) == [(1, 1, float(x), float(y)) for x in range(10, 31, 5) for y in range(10, 21, 5)]
    gt = subcube.geotransforms(cut, ["box_id"], 5.0, -5.0).first()
    assert gt.geotransform == "7.5 5.0 0.0 22.5 0.0 -5.0" and gt.cells == 15


@pytest.mark.parametrize("rows", [200_000, 0])
def test_listed_join_gives_every_pair(spark, rows):
    """A key with several arrays' worth of rows, rows that stand twice, keys without a partner and null keys."""
    small = spark.range(3000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 2).alias("k"), (F.col("id") % 2900).alias("s"))
    big = spark.range(60).select(F.when(F.col("id") % 5 > 0, F.col("id") % 4).alias("k"), F.col("id").alias("b"))
    got = bounded.join_listed(big, small, ["k"], rows, salt_by=["b"])
    want = big.join(small, "k")
    assert got.columns == want.columns and got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("rows", [200_000, 0])
def test_listed_join_shares_columns(spark, rows):
    """Columns beside the arrays may differ within a key, be null or NaN; values in arrays may be null."""
    small = spark.range(900).select(
        (F.col("id") % 3).alias("k"), F.when(F.col("id") % 11 == 0, float("nan")).when(F.col("id") % 13 > 0, F.col("id") % 2).alias("x"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 800).alias("s"),
    )
    big = spark.range(60).select(F.when(F.col("id") % 5 > 0, F.col("id") % 4).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("b"))
    got = bounded.join_listed(big, small, ["k"], rows, salt_by=["b"], shared=["x"])
    want = big.join(small, "k")
    assert got.columns == want.columns and got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_shuffled_pairs_are_written_small(spark, tmp_path):
    """Rows of a block go through one array after the other, so files hold short sequences that repeat."""
    small = spark.range(6300).select(F.lit(1).alias("k"), (F.col("id") * 7919 % 6301 * 100_003).alias("s"))
    big = spark.range(700).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    pairs = {"listed": bounded.join_listed(big, small, ["k"], 0, salt_by=["b"]), "plain": bounded.join_salted(big, small, ["k"], ["b"], hint="merge")}
    room = {}
    for name, df in pairs.items():
        df.write.parquet(f"{tmp_path}/{name}")
        room[name] = sum(f.stat().st_size for f in tmp_path.glob(f"{name}/*.parquet"))
    assert room["listed"] < room["plain"] / 3
    assert spark.read.parquet(f"{tmp_path}/listed").distinct().count() == 700 * 6300


def test_boxes_keep_what_is_asked_for(spark):
    cubes = spark.createDataFrame([(1, 4326, 0.0, 0.0, 100.0, 100.0, 0.0, 0.0, 100.0, 100.0)], CUBES)
    cells = spark.range(100).select(F.lit(1).alias("cube_id"), (F.col("id") % 10 * 9.0).alias("x"), F.floor(F.col("id") / 10).cast("double").alias("y"))
    boxes = spark.createDataFrame([(1, 10.0, 2.0, 30.0, 5.0, 4326), (None, 20.0, 3.0, 40.0, 5.0, 4326)],
                                  "box_id int, b_minx double, b_miny double, b_maxx double, b_maxy double, epsg int")
    for rows in (200_000, 0):
        whole, narrow = subcube.in_boxes(cells, boxes, cubes, rows=rows), subcube.in_boxes(cells, boxes, cubes, rows=rows, keep=["box_id"])
        assert narrow.columns == ["cube_id", "x", "y", "box_id"] and rows_of(narrow) == rows_of(whole.select(narrow.columns)) and len(rows_of(narrow)) == 8


def test_heights_are_rounded_and_listed_once(spark, sf_dir):
    plan = QUERIES["elevation_series"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan[: plan.index("_listed")]


@pytest.mark.parametrize("name", ["point_series", "export_from_points", "profile_patches", "legacy_series", "subcube_bbox"])
def test_pairs_of_observations_are_unfolded(spark, sf_dir, name):
    """Points stand in arrays; nothing is rounded and no date is reckoned for each pair."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("_listed")]
    assert not any(f in above for f in ("round(", "date_sub(", "make_date("))
