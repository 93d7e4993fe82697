"""Readers, writers and the landing stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from firnflow.functions import scaling, sensors, urls
from firnflow.operators import search
from firnflow.plans.views import view
from firnflow.session import shared_folder
from firnflow.sinks import series as series_sink
from firnflow.sinks import urls as url_sink
from firnflow.sources import catalog, cubes, points
from firnflow.streaming import landing

WHERE = {"bbox": (-70, 60, -30, 85), "percent_valid_pixels": 10, "start": "1990-01-01", "end": "2025-12-31"}


# ---- catalogs --------------------------------------------------------------------------------------------------------
def test_catalog_paths():
    assert catalog.catalog_path("s3a://b/c/") == "s3a://b/c/h3r1"
    assert catalog.catalog_path("b", "h3", 2) == "b/h3r2"
    assert catalog.catalog_path("b", "latlon") == "b/latlon"
    for bad in (("h3", 3), ("quadtree", 1)):
        with pytest.raises(ValueError):
            catalog.catalog_path("b", *bad)


def test_hive_catalog_merges_schemas(spark, tmp_path):
    base = str(tmp_path / "cat")
    spark.range(3).withColumn("a", F.lit(1)).write.parquet(f"{base}/grid=h3/level=1/tile=8001fffffffffff")
    spark.range(2).withColumn("b", F.lit("x")).write.parquet(f"{base}/grid=h3/level=2/tile=821fffffffffff")
    df = catalog.read_hive_catalog(spark, base)
    assert {"id", "a", "b", "grid", "level", "tile", "source_parquet"} <= set(df.columns)
    assert df.count() == 5
    one = catalog.read_hive_catalog(spark, base, level=1)
    assert one.count() == 3 and "tile=8001fffffffffff" in one.first().source_parquet
    assert catalog.read_hive_catalog(spark, base, tiles=["nowhere"]).count() == 0


def test_latlon_catalog(spark, tmp_path):
    base = str(tmp_path / "cat")
    for mission, tile, n in (("landsatOLI", "N70W040", 2), ("sentinel1", "N70W040", 3), ("sentinel2", "S80E010", 4), ("other", "N70W040", 9)):
        spark.range(n).write.parquet(f"{base}/{mission}/{tile}/2020")
    df = catalog.read_latlon_catalog(spark, base)
    assert {(r.mission, r.tile): r["count"] for r in df.groupBy("mission", "tile").count().collect()} == {
        ("landsatOLI", "N70W040"): 2,
        ("sentinel1", "N70W040"): 3,
        ("sentinel2", "S80E010"): 4,
    }
    assert catalog.read_latlon_catalog(spark, base, ["N70W040", "N00E000"]).count() == 5
    assert catalog.read_latlon_catalog(spark, base, ["N00E000"]).count() == 0


def test_integer_catalog(spark, tmp_path):
    base, cell = str(tmp_path / "cat"), "8001fffffffffff"
    spark.range(2).write.parquet(f"{base}/{int(cell, 16)}")
    spark.range(5).write.parquet(f"{base}/12345")
    wanted = spark.createDataFrame([(cell,)], "tile string")
    assert catalog.read_integer_catalog(spark, base).count() == 7
    assert catalog.read_integer_catalog(spark, base, wanted).count() == 2


def test_folders_read(spark, tmp_path):
    """Ids become patterns: the scan's files are those of the folders asked for."""
    base, cells = str(tmp_path / "cat"), ["8001fffffffffff", "8003fffffffffff", "8005fffffffffff"]
    for n, cell in enumerate(cells):
        spark.range(n + 1).write.parquet(f"{base}/{int(cell, 16)}/more")
    for wanted in (cells[1:], spark.createDataFrame([(c,) for c in [*cells[1:], None, "8007fffffffffff"]], "tile string")):
        df = catalog.read_integer_catalog(spark, base, wanted)
        assert df.count() == 5 and {f.split("/")[-3] for f in df.inputFiles()} == {str(int(c, 16)) for c in cells[1:]}
        assert {r.directory for r in df.collect()} == {str(int(c, 16)) for c in cells[1:]}
    none = catalog.read_integer_catalog(spark, base, ["8007fffffffffff"])
    assert none.count() == 0 and none.columns == ["id", "source_parquet", "directory"]
    assert catalog.read_integer_catalog(spark, base, []).count() == 0
    with pytest.raises(ValueError):
        catalog.read_integer_catalog(spark, base, [f"{i:x}" for i in range(6000)])


def test_missing_catalogs(spark, tmp_path):
    """A base that is not there, or holds nothing, is a catalog without rows, which can be searched."""
    (tmp_path / "empty").mkdir()
    for base in (str(tmp_path / "nowhere"), str(tmp_path / "empty")):
        for df in (
            catalog.read_hive_catalog(spark, base, level=1, tiles=["x"]), catalog.read_latlon_catalog(spark, base), catalog.read_integer_catalog(spark, base),
            catalog.read_latlon_catalog(spark, base, ["N70W040"]), catalog.read_integer_catalog(spark, base, ["8001fffffffffff"]),
        ):
            assert "source_parquet" in df.columns and df.count() == 0
            assert search.search(df, **WHERE).count() == 0
    parts = catalog.union_catalogs(catalog.read_hive_catalog(spark, str(tmp_path / "nowhere")), spark.createDataFrame([("a", 1.0)], "id string, minx double"))
    assert parts.count() == 1


def test_export_rounds_before_lookup(spark, tmp_path):
    """A point just beyond a cube's border is, to four decimals, on it."""
    cubes_ = spark.createDataFrame([(1, 4326, 0.0, 0.0, 2.0, 2.0, 0.0, 0.0, 1.0, 1.0, 3, 3)],
                                   "cube_id long, epsg int, minx double, miny double, maxx double, maxy double, x0 double, y0 double, dx double, dy double, nx int, ny int")
    seen = spark.createDataFrame([(1, 2, 1, dt.datetime(2020, 1, 1), 5.0)], "cube_id long, ix int, iy int, mid_date timestamp, v double")
    places = spark.createDataFrame([(1, 2.00003, 1.0), (2, 2.0002, 1.0)], "point_id int, lon double, lat double")
    rows = series_sink.series_for_export(places, cubes_, seen, ["v"]).collect()
    assert [(r.point_id, r.lon) for r in rows] == [(1, 2.0)]
    assert series_sink.export_points(places, cubes_, seen, "csv", str(tmp_path / "out"), ["v"]) == str(tmp_path / "out")
    back = spark.read.option("header", True).csv(str(tmp_path / "out")).collect()
    assert [(r["series"], float(r["lon"]), float(r["v [m/yr]"])) for r in back] == [("LON2.0--LAT1.0", 2.0, 5.0)]


def test_items(spark, tmp_path):
    item = {
        "id": "g1",
        "collection": "granules",
        "bbox": [-50, 70, -49, 71],
        "properties": {"datetime": "2020-05-01T00:00:00Z", "version": "002", "proj:code": "EPSG:3413", "percent_valid_pixels": 40, "date_dt": 12},
        "assets": {"data": {"href": "https://e.org/g1.nc", "roles": ["data"]}, "t": {"href": "https://e.org/g1.png", "roles": None}},
    }
    path = tmp_path / "items.json"
    path.write_text("\n".join(json.dumps(x) for x in (item, {**item, "id": "c1", "collection": "cubes"})))
    flat = catalog.flatten_items(catalog.read_items(spark, str(path), "granules"))
    row = flat.first()
    assert flat.count() == 1 and row.version == "002" and row.percent_valid_pixels == 40 and row.minx == -50
    found = search.search(flat, bbox=(-49.5, 70.5, -40, 75), start="2020-05-01", end="2020-05-01")
    assert [r.href for r in found.collect()] == ["https://e.org/g1.nc"]


def test_cube_collection(spark, tmp_path):
    ring = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
    square = [[0, 0], [5, 0], [5, 5], [0, 5], [0, 0]]
    features = [
        {
            "type": "Feature",
            "geometry": {"type": "Polygon", "coordinates": [ring]},
            "properties": {"data_epsg": "EPSG:3413", "zarr_url": f"http://e.org/{i}.zarr", "geometry_epsg": {"type": "Polygon", "coordinates": [square]}},
        }
        for i in range(2)
    ]
    path = tmp_path / "cubes.json"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    rows = catalog.read_cube_collection(spark, str(path)).orderBy("cube_id").collect()
    assert [r.cube_id for r in rows] == [0, 1] and rows[0].epsg == 3413
    assert (rows[0].maxx, rows[0].xmax, len(rows[0].footprint)) == (10.0, 5.0, 4)


# ---- points ----------------------------------------------------------------------------------------------------------
def test_points_without_header(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("-46.1,70.045\n-47.05,71.05\n0,0\n")
    bad.write_text("-46.es1,70.045\n-47.0ds,71.05\n-46.5,72.087\n-46.5,92.0,extra\n\n")
    ok = points.good_points(points.read_points(spark, str(good)))
    assert sorted((r.lon, r.lat) for r in ok.collect()) == [(-47.05, 71.05), (-46.1, 70.045), (0.0, 0.0)]
    judged = points.read_points(spark, str(bad))
    assert [(r.lon, r.lat) for r in points.good_points(judged).collect()] == [(-46.5, 72.087)]
    reasons = sorted(r.reason for r in points.rejected_points(judged).collect())
    assert reasons == ["lat_out_of_range", "lon_not_a_number", "lon_not_a_number", "lon_not_a_number"]


def test_points_latitude_first_with_header(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("lat,lon\n70.5,-45.25\n60,0\n")
    df = points.good_points(points.read_points(spark, str(path), order="latlon", header=True))
    assert sorted((r.lon, r.lat) for r in df.collect()) == [(-45.25, 70.5), (0.0, 60.0)]
    named = points.with_point_ids(df.union(df))
    assert named.count() == 2 and "point_id" in named.columns


def test_points_as_text(spark):
    df = spark.createDataFrame([("POINT (59.5 -140.25)",), ("point(1 2)",), ("LINESTRING (1 2, 3 4)",)], "w string")
    got = points.parse_wkt_points(df, "w").collect()
    assert [(r.lon, r.lat) for r in got[:2]] == [(-140.25, 59.5), (2.0, 1.0)] and got[2].reason


# ---- chunks and addresses --------------------------------------------------------------------------------------------
def test_chunks_with_axes(spark):
    axes = ([100.0, 101.0], [7.0, 8.0, 9.0])
    df = spark.createDataFrame([(1, [float(i) for i in range(5)] + [float("nan")], *axes)], "cube_id int, values array<double>, ts array<double>, xs array<double>")
    flat = cubes.flatten_chunks(df, "values", [("t", F.size("ts")), ("x", F.size("xs"))], keys=["ts", "xs"])
    out = flat.select(cubes.axis_value(F.col("ts"), F.col("t")).alias("t"), cubes.axis_value(F.col("xs"), F.col("x")).alias("x"), "v")
    assert [tuple(r) for r in out.orderBy("t", "x").collect()] == [
        (100.0, 7.0, 0.0), (100.0, 8.0, 1.0), (100.0, 9.0, 2.0), (101.0, 7.0, 3.0), (101.0, 8.0, 4.0), (101.0, 9.0, None),
    ]


def test_observation_table(spark, sf_dir, tmp_path):
    rows = view(spark, sf_dir, "observations").withColumn("ix", F.lit(0)).withColumn("iy", F.lit(0))
    path = str(tmp_path / "obs")
    cubes.write_observations(rows.select("cube_id", "ix", "iy", "mid_date", "v", "v_error"), path, files=4)
    some = cubes.read_observations(spark, path, ["v"], [3, 4])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cube_id" in plan and "v_error" not in plan.split("ReadSchema")[1]
    assert some.count() == rows.where("cube_id in (3, 4)").count()


def test_addresses(spark):
    row = spark.range(1).select(
        *(c.alias(n) for n, c in zip("bk", urls.bucket_and_key(F.lit("s3://bucket/a/b.zarr")))),
        urls.s3_url(F.lit("http://data.s3.amazonaws.com/x.zarr")).alias("s3"),
        urls.https_url(F.lit("http://e.org/x")).alias("https"),
        urls.composite_url(F.lit("https://e.org/datacubes/v2/R/ICE_vel_EPSG3413_G0120_X1_Y2.zarr")).alias("none"),
        urls.epsg_code(F.lit("EPSG:32607")).alias("epsg"),
        urls.epsg_code(F.lit(None).cast("string")).alias("default"),
    ).first()
    assert tuple(row) == ("bucket", "a/b.zarr", "s3://data/x.zarr", "https://e.org/x", "", "32607", "3413")


def test_variables():
    assert sensors.velocity_variables(["v", "extra"])[-1] == "extra" and len(sensors.velocity_variables()) == 9
    assert len(sensors.composite_variables()) == 29 and len(sensors.composite_variables(["v", "q"])) == 30


def test_labels(spark):
    row = spark.range(1).select(
        scaling.point_label(F.lit(-45.12345), F.lit(70.0)).alias("a"),
        scaling.series_name(F.lit(-45.1), F.lit(70.5)).alias("b"),
        scaling.series_name(F.lit(-45.1), F.lit(70.5), lat_first=True).alias("c"),
        scaling.missing_to_null(F.lit(float("nan"))).alias("d"),
    ).first()
    assert tuple(row) == ("Lat: 70.0, Lon: -45.1235", "LON-45.1--LAT70.5", "LAT70.5--LON-45.1", None)


# ---- series ----------------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def three(spark):
    rows = [
        (dt.datetime(2020 + i, 12, 31), -49.09, 70.0, 100.0 * (i + 1), 10.0, 1.0, 0.1, 2.0, 0.2, 30.0 * (i + 1), s, "M", 3413)
        for i, s in enumerate("121")
    ]
    names = "mid_date timestamp_ntz, lon double, lat double, v double, v_error double, vx double, vx_error double, vy double, vy_error double, date_dt_days double, satellite_img1 string, mission_img1 string, epsg int"
    return spark.createDataFrame(rows, names)


def test_csv_files(spark, three, tmp_path):
    path = str(tmp_path / "csv")
    series_sink.write_series(three, "csv", path)
    lines = [line for f in (tmp_path / "csv" / "series=LON-49.09--LAT70.0").glob("*.csv") for line in f.read_text().splitlines()]
    assert lines[0] == "mid_date," + ",".join(series_sink.CSV_COLUMNS)
    assert len([x for x in lines if not x.startswith("mid_date")]) == 3


def test_parquet_files(spark, three, tmp_path):
    path = str(tmp_path / "pq")
    series_sink.write_series(three.withColumn("v", F.when(F.col("v") > 150, F.col("v"))), "parquet", path)
    back = spark.read.parquet(path)
    assert {"lon", "lat", "v [m/yr]", "epsg", "date_dt [days]", "series"} <= set(back.columns)
    assert back.count() == 2
    assert sorted(r[0] for r in back.select("`date_dt [days]`").collect()) == [60, 90]


def test_subset_of_the_missing_test(three):
    gaps = three.withColumn("extra", F.lit(None).cast("double"))
    assert series_sink.export_rows(gaps, ["extra"]).count() == 0
    assert series_sink.export_rows(gaps, ["extra"], subset=["v"]).count() == 3


def test_text_table_and_formats(spark, three, capsys):
    series_sink.write_series(three, "stdout")
    lines = capsys.readouterr().out.splitlines()
    assert lines[0].startswith("| mid_date") and len(lines) == 5
    many = three.crossJoin(spark.range(1000)).drop("id")
    assert sum(1 for _ in series_sink.text_lines(many)) == 3002
    with pytest.raises(ValueError):
        series_sink.write_series(three, "netcdf", "x")


def test_absent_variable(spark, three):
    with pytest.raises(ValueError):
        series_sink.csv_rows(three, ["vv_typo"])
    assert series_sink.csv_rows(three.drop("vx")).columns == ["mid_date", *series_sink.CSV_COLUMNS]


def test_default_folder(spark, three, tmp_path, monkeypatch):
    monkeypatch.setattr(series_sink, "write_csv", lambda series, path, variables: None)
    first, second = (series_sink.write_series(three, "csv") for _ in range(2))
    assert first.startswith("series-") and first != second


def test_landed_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.nc").write_bytes(b"123")
    (tmp_path / "in" / "a.png").write_bytes(b"1")
    rows = catalog.read_landed_files(spark, str(tmp_path), content=True).collect()
    assert [(r.filename, r.length, bytes(r.content)) for r in rows] == [("a.nc", 3, b"123")]


def test_union_of_catalogs(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, a string"), spark.createDataFrame([(2, 5)], "id int, b int")
    assert sorted(tuple(r) for r in catalog.union_catalogs(a, b).collect()) == [(1, "x", None), (2, None, 5)]


def test_url_files(spark, tmp_path):
    found = spark.createDataFrame([("https://e.org/b.nc",), ("https://x.s3.amazonaws.com/a.nc",)], "href string")
    url_sink.write_urls(found, str(tmp_path / "u"))
    assert spark.read.text(str(tmp_path / "u")).count() == 2
    url_sink.write_url_csv(found, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["url", "filename"]
    url_sink.write_url_json(found, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert json.loads("".join(url_sink.json_array(found))) == ["https://e.org/b.nc", "https://x.s3.amazonaws.com/a.nc"]
    assert json.loads("".join(url_sink.json_array(found.limit(0)))) == []
    manifest = [tuple(r) for r in url_sink.download_manifest(found, limit=5).orderBy("href").collect()]
    assert manifest == [("https://e.org/b.nc", "b.nc", "daac"), ("https://x.s3.amazonaws.com/a.nc", "a.nc", "s3")]


# ---- stream ----------------------------------------------------------------------------------------------------------
def test_stream_equals_batch(spark, sf_dir, tmp_path):
    """Files in random time order, every address landed twice; the delay is longer than the disorder."""
    granules = view(spark, sf_dir, "granules")
    path = str(tmp_path / "landing")
    doubled = granules.unionByName(granules)
    doubled.repartition(6, F.xxhash64("granule_id", "datetime", F.rand(4))).write.parquet(path)
    arriving = landing.landed(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    found = landing.stream_search(arriving, "20000 days", event_time="datetime", **WHERE)
    out = shared_folder(spark, "test-stream")
    landing.to_files(found, out + "/found", out + "/state").awaitTermination()
    got = sorted(r.href for r in spark.read.parquet(out + "/found").collect())
    assert got == sorted(r.href for r in search.search(granules, **WHERE).collect())


def test_stream_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    granules = view(spark, sf_dir, "granules")
    path, out = str(tmp_path / "landing"), shared_folder(spark, "test-stream")
    half = F.col("granule_id") % 2 == 0
    granules.where(half).write.mode("append").parquet(path)
    for _ in range(2):
        arriving = landing.landed(spark, path, granules.schema)
        found = landing.stream_search(arriving, "20000 days", event_time="datetime", **WHERE)
        landing.to_files(found, out + "/found", out + "/state").awaitTermination()
        granules.where(~half).write.mode("append").parquet(path)
    assert spark.read.parquet(out + "/found").count() == search.search(granules, **WHERE).count()


def test_stream_without_region(spark, sf_dir):
    arriving = landing.landed(spark, sf_dir, view(spark, sf_dir, "granules").schema, pattern="none")
    assert landing.stream_search(arriving, "1 day").columns == ["href"]


BOXES = "roi_id long, roi_minx double, roi_miny double, roi_maxx double, roi_maxy double"


def test_stream_forms(spark, sf_dir):
    """Regions with holes, assets and footprints in the stream as in the search over the same rows."""
    from firnflow.functions import rings
    from firnflow.plans.queries import MIXED_PARTS

    path, out = shared_folder(spark, "test-landing"), shared_folder(spark, "test-stream")
    box = rings.box_ring(*(F.col(n) for n in search.BOX))
    rows = view(spark, sf_dir, "granules").withColumn("footprint", box)
    assets = F.create_map(F.lit("a"), F.struct(F.col("href"), F.array(F.lit("data")).alias("roles")),
                          F.lit("b"), F.struct(F.replace("href", F.lit(".nc"), F.lit(".tif")).alias("href"), F.array(F.lit("data")).alias("roles")))
    rows.withColumn("assets", assets).drop("href").repartition(3).write.parquet(path)
    stored = spark.read.parquet(path)
    for n, (where, suffix) in enumerate((({"geojson": MIXED_PARTS}, ".nc"), ({"polygon": [(-60, 62), (-40, 62), (-40, 80)]}, ".tif"))):
        conditions = {"percent_valid_pixels": 10, "start": "1990-01-01", **where}
        arriving = landing.landed(spark, path, stored.schema, files_per_batch=1)
        found = landing.stream_search(arriving, "20000 days", event_time="datetime", asset_type=suffix, **conditions)
        landing.to_files(found, f"{out}/{n}", f"{out}/state{n}").awaitTermination()
        got = sorted(r.href for r in spark.read.parquet(f"{out}/{n}").collect())
        assert got == sorted(r.href for r in search.search(stored, suffix, **conditions).collect()) and got and got[0].endswith(suffix)


def test_stream_of_regions_goes_on_after_a_restart(spark, sf_dir):
    """Files that land between two runs from one checkpoint: pairs once, counts go on."""
    path, out = shared_folder(spark, "test-landing"), shared_folder(spark, "test-stream")
    rows = view(spark, sf_dir, "granules")
    rois = spark.createDataFrame([(i, -70.0 + 3 * i, 60.0 + i, -66.0 + 3 * i, 63.0 + i) for i in range(12)], BOXES)
    conditions = {"percent_valid_pixels": 5, "start": "1990-01-01"}
    for part in range(3):
        # The second part comes again with the third.
        rows.where(F.col("granule_id") % 3 == part).unionByName(rows.where((F.col("granule_id") % 3 == 1) & F.lit(part == 2))).write.mode("append").parquet(path)
        arriving = landing.landed(spark, path, rows.schema, files_per_batch=2)
        landing.to_files(landing.stream_search_many(arriving, rois, "20000 days", "datetime", **conditions), out + "/found", out + "/s1").awaitTermination()
        landing.to_updates(landing.stream_coverage(arriving, rois, **conditions), out + "/counts", out + "/s2").awaitTermination()
    stored = spark.read.parquet(path).where("percent_valid_pixels >= 5")
    want = search.search_many(stored, rois)
    pairs = [(r.roi_id, r.href) for r in spark.read.parquet(out + "/found").collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(r.roi_id, r.href) for r in want.collect()} and len(pairs) > 100
    counts = landing.latest(spark, out + "/counts", "roi_id long, year int, files long", ["roi_id", "year"]).collect()
    by_year = want.groupBy("roi_id", F.year("datetime").alias("year")).count().collect()
    assert sorted(map(tuple, counts)) == sorted(map(tuple, by_year))


def test_clustered_series(spark, tmp_path):
    """Many points in few files; one of them comes back from its own file alone."""
    import math

    many = spark.range(3000).select(
        (F.col("id") / 7 % 90).alias("lon"), (F.col("id") % 50 + 0.12345).alias("lat"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("day"), F.col("id").cast("double").alias("v")
    )
    rows = many.select("lon", "lat", F.make_date(F.lit(2020), F.lit(1), F.col("day")).cast("timestamp").alias("mid_date"), "v", F.lit(3413).alias("epsg"))
    for form in ("parquet", "csv"):
        path = str(tmp_path / form)
        series_sink.write_clustered(rows, path, form, ["v"], files=6)
        files = [f for f in (tmp_path / form / "data").glob("*") if f.name.startswith("part-")]
        index = spark.read.parquet(path + "/index")
        assert 1 < len(files) <= 6 and index.agg(F.sum("rows")).first()[0] == 12_000 and index.select("lon", "lat").distinct().count() == 3000
        one = series_sink.read_point(spark, path, 1701 / 7 % 90, 1.12345)
        assert len(one.inputFiles()) == 1 if form == "parquet" else True
        assert [(r["v [m/yr]"], r["mid_date"].day) for r in one.orderBy("mid_date").collect()] == [(1701.0, d) for d in (1, 2, 3, 4)]
        assert series_sink.read_point(spark, path, 1.0, 1.0).count() == 0
    assert math.isclose(one.first().lon, 1701 / 7 % 90, abs_tol=5e-5)
