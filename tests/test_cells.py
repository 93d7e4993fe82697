"""As-of joins, chunks and cut-outs against plain loops, with crowded keys, holes, ties and odd values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnflow.operators.asof import nearest_on_axes, snap_on_axes
from firnflow.sources.chunks import dense_chunks, series_from_chunks
from firnflow.sources.cubes import flatten_chunks


def by_hand(axis, v, direction, tolerance):
    """Nearest coordinate of a list, the larger one on a tie."""
    if v is None or math.isnan(v):
        return None
    below, above = [a for a in axis if a <= v], [a for a in axis if a >= v]
    found = {"backward": max(below, default=None), "forward": min(above, default=None)}
    found["nearest"] = min(axis, key=lambda a: (abs(a - v), -a), default=None)
    got = found[direction]
    return None if got is None or (tolerance is not None and abs(got - v) > tolerance) else got


@pytest.mark.parametrize("direction, tolerance, per_part, salts", [("nearest", None, 3, 4), ("nearest", 0.5, 256, 1), ("backward", None, 2, 3), ("forward", 1.0, 5, 2)])
def test_asof(spark, direction, tolerance, per_part, salts):
    rng = np.random.default_rng(3)
    axes = {k: (rng.integers(-400, 400, n) / 8).tolist() for k, n in ((1, 60), (2, 1), (3, 2), (5, 30))}
    axes[5] = [2.0**i for i in range(30)]  # nearly all in the first part
    axes[6] = [7.5, 7.5, 7.5]
    lines = [(k, a, i) for k, own in axes.items() for i, a in enumerate(own)] + [(1, None, -1), (2, float("nan"), -2), (None, 1.0, -3)]
    probes = [(i, 1 if i % 3 else int(rng.integers(1, 8)), float(rng.integers(-900, 900)) / 16) for i in range(600)]
    probes += [(600, 1, None), (601, 1, float("nan")), (602, None, 2.0), (603, 1, math.inf), (604, 1, -math.inf), (605, 9, 1.0), (5, probes[5][1], probes[5][2])]
    got = nearest_on_axes(
        spark.createDataFrame(probes, "i int, k int, v double").repartition(5), spark.createDataFrame(lines, "k int, at double, line int"),
        ["k"], "v", "at", ["line"], direction, tolerance, per_part, salts,
    ).collect()
    assert len(got) == len(probes)
    for r in got:
        want = by_hand(axes.get(r["k"], []), r["v"], direction, tolerance)
        if r["v"] is not None and math.isinf(r["v"]) and direction == "nearest":
            want = None if tolerance is not None else max(axes[1]) if r["v"] > 0 else min(axes[1])
        assert r["at"] == want, r
        assert r["line"] == (None if want is None else axes[r["k"]].index(want))


def test_asof_plan(spark):
    """Neither a nested loop nor a scan of an array of axis values."""
    probes, lines = spark.range(10).selectExpr("id", "id % 2 AS k", "id / 3D AS v"), spark.range(8).selectExpr("id % 2 AS k", "id * 1D AS at")
    plan = nearest_on_axes(probes, lines, ["k"], "v", "at")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "transform" not in plan


def test_asof_refuses(spark):
    probes, lines = spark.range(2).selectExpr("id AS k", "id AS at"), spark.range(2).selectExpr("id AS k", "id AS at")
    with pytest.raises(ValueError):
        nearest_on_axes(probes, lines, ["k"], "at", "at")
    with pytest.raises(ValueError):
        nearest_on_axes(probes, lines.withColumnRenamed("at", "x"), ["k"], "at", "x", direction="up")


def test_snap_on_axes(spark):
    axes = [(1, "x", 0, 0.0), (1, "x", 1, 10.0), (1, "x", 2, 11.0), (1, "y", 0, 5.0), (1, "y", 1, -7.0)]
    located = spark.createDataFrame([(7, 1, 10.5, -1.0), (8, 1, 4.0, 100.0), (9, 2, 0.0, 0.0)], "point_id int, cube_id int, px double, py double")
    got = snap_on_axes(located, spark.createDataFrame(axes, "cube_id int, axis string, i int, coordinate double"))
    rows = {r["point_id"]: (r["ix"], r["x"], r["iy"], r["y"]) for r in got.collect()}
    assert rows == {7: (2, 11.0, 0, 5.0), 8: (0, 0.0, 0, 5.0), 9: (None, None, None, None)}


CUBE = np.arange(5 * 6 * 9, dtype=float).reshape(5, 6, 9)  # time, y, x
CUBE[2, 3, 4] = np.nan


def stored_chunks(spark, ny=4, nx=4):
    """The cube in padded chunks; the one at the upper right corner is not stored."""
    rows = []
    for cy in range(2):
        for cx in range(3):
            block = np.full((5, ny, nx), np.nan)
            part = CUBE[:, cy * ny : (cy + 1) * ny, cx * nx : (cx + 1) * nx]
            block[:, : part.shape[1], : part.shape[2]] = part
            if (cy, cx) != (1, 2):
                rows.append((1, cy, cx, block.ravel().tolist()))
    return spark.createDataFrame([*rows, (2, 0, 0, []), (3, 0, 0, None)], "cube_id long, cy long, cx long, values array<double>")


@pytest.mark.parametrize("limit", [200_000, 0])
def test_series_from_chunks(spark, limit):
    places = [(1, 0, 0), (1, 4, 3), (1, 8, 1), (1, 3, 5), (1, 8, 5), (1, -1, 0), (1, 40, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), *[(1, 2, 2)] * 40]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "point_id int, cube_id long, ix long, iy long")
    four = F.lit(4)
    got = series_from_chunks(points, stored_chunks(spark), (four, four), name="speed", rows=limit).collect()
    want = {(i, t): CUBE[t, y, x] for i, (k, x, y) in enumerate(places) if k == 1 and 0 <= x < 9 and y >= 0 and (y, x) != (5, 8) for t in range(5)}
    assert {(r["point_id"], r["it"]): r["speed"] for r in got} == {k: None if math.isnan(v) else v for k, v in want.items()}
    assert len(got) == len(want)
    times = spark.createDataFrame([(1, t, f"2020-01-0{t + 1}") for t in range(4)], "cube_id long, it int, mid_date string")
    dated = series_from_chunks(points, stored_chunks(spark), (four, four), times=times, rows=limit)
    assert dated.count() == len(want) * 4 // 5 and dated.columns == ["point_id", "cube_id", "ix", "iy", "mid_date", "v"]


def test_series_reads_wanted_chunks_only(spark):
    """The same as all chunks as rows joined with the points, from a plan that explodes no array of values."""
    points = spark.createDataFrame([(1, 1, 4, 3), (2, 1, 1, 1)], "point_id int, cube_id long, ix long, iy long")
    flat = flatten_chunks(
        stored_chunks(spark).where("cube_id = 1"), "values", [("it", F.lit(5)), ("iy", F.lit(4)), ("ix", F.lit(4))],
        {"iy": F.col("cy") * 4, "ix": F.col("cx") * 4}, ["cube_id"],
    )
    want = points.join(flat, ["cube_id", "ix", "iy"]).select("point_id", "it", "v")
    got = series_from_chunks(points, stored_chunks(spark), (F.lit(4), F.lit(4)))
    assert sorted(map(str, want.collect())) == sorted(str(r) for r in got.select("point_id", F.col("it").cast("long"), "v").collect())
    assert "posexplode" not in got._jdf.queryExecution().optimizedPlan().toString()


def long_rows(seed, keys=4):
    rng = np.random.default_rng(seed)
    rows = {}
    for k in range(keys):
        t0, y0, x0 = rng.integers(-5, 900, 3)
        for _ in range(int(rng.integers(1, 200))):
            t, y, x = rng.integers(0, 4), rng.integers(0, 9), rng.integers(0, 7)
            rows[k, int(t0 + t), int(y0 + y), int(x0 + x)] = float(rng.integers(0, 1000))
    return rows


@pytest.mark.parametrize("lengths, limit", [((2, 4, 4), 200_000), ((1, 1, 1), 200_000), ((9, 20, 20), 200_000), ((3, 2, 5), 0)])
def test_dense_chunks(spark, lengths, limit):
    rows = long_rows(sum(lengths))
    data = [(*k, v) for k, v in rows.items()] + [(*k, v - 1) for k, v in rows.items()] + [(0, None, 1, 1, 5.0), (1, 1, 1, None, 5.0)]
    cells = spark.createDataFrame(data, "k int, t int, y int, x int, v double").repartition(4)
    axes = dict(zip(("t", "y", "x"), lengths))
    chunked = dense_chunks(cells, ["k"], axes, ["v"], {"y": lambda i: 100 - i * F.col("k"), "x": lambda i: i * 0.5}, rows=limit)
    c = F.col
    for r in chunked.collect():
        assert len(r["v"]) == r["t_length"] * r["y_length"] * r["x_length"] <= lengths[0] * lengths[1] * lengths[2] and any(x is not None for x in r["v"])
        assert r["y_values"] == [100 - (r["y_start"] + i) * r["k"] for i in range(r["y_length"])]
        assert r["x_values"] == [(r["x_start"] + i) * 0.5 for i in range(r["x_length"])]
    flat = flatten_chunks(chunked, "v", [(a, c(f"{a}_length")) for a in axes], {a: c(f"{a}_start") for a in axes}, ["k"])
    back = {(r["k"], r["t"], r["y"], r["x"]): r["v"] for r in flat.collect()}
    assert {k: v for k, v in back.items() if v is not None} == rows
    assert chunked.groupBy("k", "c_t", "c_y", "c_x").count().where("count > 1").count() == 0


def test_dense_chunks_refuse(spark):
    cells = spark.createDataFrame([(1, 1, 1.0)], "k int, x int, v double")
    with pytest.raises(ValueError):
        dense_chunks(cells, ["k"], {"x": 1 << 30}, ["v"])
    assert dense_chunks(cells.limit(0), ["k"], {"x": 4}, ["v"]).count() == 0
