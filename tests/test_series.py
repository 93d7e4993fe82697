import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from firnflow.operators import profile, resample, running_mean, series
from firnflow.operators.locate import locate, snap_points
from firnflow.plans import products
from firnflow.plans.views import view

DAY = dt.timedelta(days=1)


def test_annual_series_of_a_crowded_cell(spark):
    """A cell that holds most points, a cell without static values; broadcast and salted shuffle agree."""
    cubes = view(spark, "/root/testdata/sf0.01", "cubes")
    points = view(spark, "/root/testdata/sf0.01", "points").limit(300)
    crowd = locate(points, cubes).where("composite_zarr_url <> ''").agg(F.min("point_id")).first()[0]
    one = points.where(F.col("point_id") == crowd).crossJoin(spark.range(600).withColumnRenamed("id", "n"))
    points = points.unionByName(one.withColumn("point_id", (F.col("point_id") + 1_000_000 + F.col("n")).cast(points.schema["point_id"].dataType)).drop("n"))
    cells = snap_points(locate(points, cubes), None).select("cube_id", "ix", "iy").distinct()
    yearly = cells.crossJoin(spark.range(3)).selectExpr("cube_id", "ix", "iy", "cast(2000 + id as int) year", "cast(ix + id as double) v")
    still = cells.where("ix % 2 = 0").withColumn("v0", F.col("iy") * 1.0)
    results = []
    for rows in (200_000, 0):
        got = series.annual_series(points, cubes, yearly, still, ("v", "v0"), rows=rows).select("point_id", "ix", "iy", "year", "v", "v0")
        results.append(sorted(map(tuple, got.collect()), key=str))
    assert results[0] == results[1] and len(results[0]) > 1500
    assert all(r[5] == (float(r[2]) if r[1] % 2 == 0 else None) for r in results[0])


@pytest.fixture(scope="module")
def observed():
    rng = random.Random(8)
    rows = []
    for key in range(6):
        start = dt.datetime(2000 + key, 1 + key, 3, 5 * key % 24)
        for i in range(150):
            t = start + rng.randint(0, 900) * DAY + rng.choice([0, 0, 7]) * dt.timedelta(hours=1)
            v = None if rng.random() < 0.2 else round(rng.uniform(-300, 900), 3)
            rows.append((key, t, i, v))
    rows += [(99, dt.datetime(2001, 3, 31), 0, None), (99, dt.datetime(2001, 6, 1), 1, 4.0)]
    return rows


@pytest.fixture(scope="module")
def df(spark, observed):
    return spark.createDataFrame(observed, "k int, t timestamp_ntz, i int, v double").cache()


PANDAS = {"max": "max", "min": "min", "mean": "mean", "average": "mean", "median": "median"}


@pytest.mark.parametrize("op", sorted(PANDAS))
@pytest.mark.parametrize(("freq", "alias"), [("m", "ME"), ("w", "W"), ("d", "D")])
@pytest.mark.parametrize("fill", [False, True])
def test_resample_like_pandas(df, observed, op, freq, alias, fill):
    single = resample.first_per_timestamp(df, ["k"], "t", ["i"], ["v"])
    got = {(r.k, r.period): r.value for r in resample.resample(single, ["k"], "t", "v", op, freq, fill).collect()}
    want = {}
    table = pd.DataFrame(observed, columns=["k", "t", "i", "v"]).sort_values(["t", "i"])
    for k, group in table.groupby("k"):
        s = group.drop_duplicates("t").set_index("t")["v"].astype(float)
        s = getattr(s.resample(alias), PANDAS[op])()
        s = s.ffill() if fill else s
        want.update({(k, t.date()): (None if math.isnan(v) else v) for t, v in s.items()})
    assert got.keys() == want.keys()
    assert all((a is None) == (want[k] is None) and (a is None or abs(a - want[k]) < 1e-9) for k, a in got.items())


def test_median_of_a_hot_key(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(-1)).alias("k"),
        ((F.col("id") * 7919) % 60_000 - 20_000).cast("double").alias("v"),
    )
    rows = rows.unionByName(spark.createDataFrame([(1000, None), (1001, 3.5)], "k long, v double"))
    want = rows.groupBy("k").agg(F.median("v").alias("m"))
    for got in (resample.exact_median(rows, ["k"], "v", hot_values=1000), resample.spread_median(rows, ["k"], "v")):
        assert got.count() == got.join(want, "k").where("value <=> m").count() == want.count() == 53


def test_aggregation_text():
    assert resample.parse_aggregation("median-m") == ("median", "m")
    for bad in ("median", "sum-m", "max-y"):
        with pytest.raises(ValueError):
            resample.parse_aggregation(bad)


@pytest.mark.parametrize(("freq", "least"), [(30, 5), (7, 2), (1, 1), (45, 3)])
def test_running_mean_by_definition(df, observed, freq, least):
    out = running_mean.running_mean(df, ["k"], "t", "v", freq, least)
    got = {(r.k, r.bin): (r.time, r.value) for r in out.collect()}
    want = {}
    table = pd.DataFrame(observed, columns=["k", "t", "i", "v"])
    for k, group in table.groupby("k"):
        starts = list(pd.date_range(group.t.min(), group.t.max(), freq=f"{freq}D"))
        reach = pd.Timedelta(days=int(freq / 2))
        for i in range(len(starts) - 1):
            used = group[(group.t >= starts[i] - reach) & (group.t < starts[i + 1] + reach) & group.v.notna()]
            if len(used) >= least:
                mean_time = starts[i] + (used.t - starts[i]).mean()
                want[k, i] = (mean_time.floor("us").to_pydatetime(), float(np.mean(used.v)))
            else:
                want[k, i] = (starts[i].to_pydatetime(), None)
    assert got.keys() == want.keys()
    for key, (time, value) in got.items():
        wanted_time, wanted = want[key]
        assert abs((time - wanted_time).total_seconds()) <= 2e-6
        assert (value is None) == (wanted is None) and (value is None or abs(value - wanted) < 1e-9)


def test_running_mean_deals_its_bins(spark, df, monkeypatch):
    """The spans of all series are a few bytes, their bins are not: they are made in as many tasks as they need."""
    monkeypatch.setattr(running_mean, "BINS_PER_TASK", 1_000_000)
    want = sorted(map(str, running_mean.running_mean(df, ["k"], "t", "v", 7, 2).select("k", "bin", "time", "n").collect()))
    monkeypatch.setattr(running_mean, "BINS_PER_TASK", 7)
    out = running_mean.running_mean(df, ["k"], "t", "v", 7, 2)
    assert sorted(map(str, out.select("k", "bin", "time", "n").collect())) == want != []
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert len(want) > 14 and f", {len(want) // 7 + 1}), REPARTITION_BY_NUM" in plan


def test_maximum_takes_first_date(spark):
    rows = [(1, dt.datetime(2001, 1, d), v) for d, v in ((3, 5.0), (1, 5.0), (2, 4.0))] + [(2, dt.datetime(2001, 1, 1), -1.0)]
    out = series.positive_maximum(spark.createDataFrame(rows, "k int, mid_date timestamp_ntz, v double"), ["k"]).collect()
    assert [(r.k, r.max_value, r.max_date) for r in out] == [(1, 5.0, dt.datetime(2001, 1, 1))]


def test_report_parts(spark):
    rows = [(1, dt.datetime(2001, m, 5), float(m), s, i) for i, (m, s) in enumerate([(1, "1"), (2, "8"), (4, "8")])]
    rows.append((1, dt.datetime(2001, 3, 5), None, "x", 9))
    df = spark.createDataFrame(rows, "k int, mid_date timestamp_ntz, v double, satellite_img1 string, i int")
    parts = products.report(df, ["k"], ["i"])
    assert [r.value for r in parts.series.orderBy("period").collect()] == [1.0, 2.0, 2.0, 4.0]
    stats = parts.statistics.first()
    assert (stats["mean"], stats["max"], stats["n"]) == (2.25, 4.0, 4)
    assert {(r.label, r.observations) for r in parts.satellites.collect()} == {("S1", 1), ("L8", 2), ("x", 1)}
    assert parts.maximum.first().max_value == 4.0


def dense(line, d):
    """Walk along the line and put a point at every multiple of d."""
    out, walked, k = [(0, *line[0])], 0.0, 1
    for (x0, y0), (x1, y1) in zip(line, line[1:]):
        length = math.hypot(x1 - x0, y1 - y0)
        while length and k * d <= walked + length:
            f = (k * d - walked) / length
            out.append((k, x0 + f * (x1 - x0), y0 + f * (y1 - y0)))
            k += 1
        walked += length
    return out


@pytest.mark.parametrize("run_length", [10_000, 3])
def test_densify(spark, run_length):
    rng = random.Random(2)
    lines = {p: [(rng.uniform(0, 4000), rng.uniform(0, 4000)) for _ in range(rng.randint(2, 12))] for p in range(30)}
    lines[30] = [(5.0, 5.0), (5.0, 5.0), (2505.0, 5.0)]
    rows = [(p, i, x, y) for p, line in lines.items() for i, (x, y) in enumerate(line)]
    df = spark.createDataFrame(rows, "profile_id int, seq int, x double, y double")
    got = {}
    for r in profile.densify(df, 1000.0, run_length).collect():
        got.setdefault(r.profile_id, []).append((r.k, r.x, r.y, r.n_points))
    for p, line in lines.items():
        want = dense(line, 1000.0)
        have = sorted(got[p])
        assert [h[0] for h in have] == [w[0] for w in want] and {h[3] for h in have} == {len(want)}
        assert all(abs(h[1] - w[1]) < 1e-6 and abs(h[2] - w[2]) < 1e-6 for h, w in zip(have, want))


def test_bin_edges(spark):
    df = spark.createDataFrame([(1, k, k * 10.0, 3) for k in range(3)], "profile_id int, k int, distance double, n_points int")
    edges = [(r.x_start, r.x_stop) for r in profile.bin_edges(df, 10.0).orderBy("k").collect()]
    assert edges == [(0.0, 5.0), (5.0, 15.0), (15.0, 20.0)]


def test_project_profile(spark):
    rows = [(1, i, lon, lat) for i, (lon, lat) in enumerate([(-140.8, 59.76), (-140.7, 59.87), (-140.4, 60.08)])]
    df = spark.createDataFrame(rows, "profile_id int, seq int, lon double, lat double")
    out = profile.project_profile(df).collect()
    assert {r.epsg for r in out} == {32607}
    samples = profile.sample_positions(profile.densify(profile.project_profile(df)), F.col("epsg"))
    first = samples.orderBy("k").first()
    assert abs(first.lon + 140.8) < 1e-9 and abs(first.lat - 59.76) < 1e-9
    assert samples.count() == samples.first().n_points > 30


def test_nan_in_medians(spark):
    """Both ways to a median treat NaN as missing."""
    rows = spark.createDataFrame([("a", float(i)) for i in range(9)] + [("a", float("nan")), ("b", float("nan"))], "k string, v double")
    for hot in (3, 1000):
        assert {r["k"]: r["value"] for r in resample.exact_median(rows, ["k"], "v", hot).collect()} == {"a": 4.0, "b": None}


@pytest.mark.parametrize("near", ["equal parts", "one per cent", "few", "odd"])
def test_median_of_near_values(spark, near):
    """Values of one magnitude are cut again by their own range: what meets in one task at the end is a small part of them."""
    ids = spark.range(200_001 if near == "odd" else 200_000).withColumn("k", F.when(F.col("id") % 5 == 0, F.lit(1)).otherwise(F.lit(0)))
    value = {
        "equal parts": F.col("id") * 0.25 - 1000,
        "one per cent": 1000 + F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1e5,
        "few": F.when(F.col("id") % 3 == 0, F.lit(None).cast("double")).otherwise(F.pmod(F.xxhash64("id"), F.lit(7)).cast("double")),
        "odd": F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).when(F.col("id") % 7 == 0, 1e300).otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(997)) / 50.0)),
    }[near]
    rows = ids.select("k", value.alias("v"))
    got = {r["k"]: r["value"] for r in resample.spread_median(rows, ["k"], "v").collect()}
    known = rows.where("v IS NOT NULL AND NOT isnan(v)").toPandas()
    assert got == known.groupby("k")["v"].median().to_dict()
    largest = resample.middle_values(rows, ["k"], "v").groupBy("k", "_b").count().agg(F.max("count")).first()[0]
    assert largest <= 100
    nothing = spark.createDataFrame([(1, None), (1, float("nan")), (2, 3.0)], "k int, v double")
    assert {r["k"]: r["value"] for r in resample.spread_median(nothing, ["k"], "v").collect()} == {1: None, 2: 3.0}


def test_points_found_without_their_series(spark, sf_dir):
    """Counting points does not pair them with their observations."""
    from firnflow.operators import series
    from firnflow.plans.queries import QUERIES, observations, view

    whole = series.time_series(view(spark, sf_dir, "points"), view(spark, sf_dir, "cubes"), observations(spark, sf_dir))
    counted = QUERIES["series_found"](spark, sf_dir)
    assert counted.collect() == series.found_count(whole).collect()
    assert "LeftSemi" in counted._jdf.queryExecution().executedPlan().toString()
