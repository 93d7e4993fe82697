"""Rings by rows against the test of all pairs of edges; what is seen of drawn intervals in odd cases."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from firnflow.functions.rings import ring_is_simple
from firnflow.operators.validity import ring_faults
from firnflow.operators.visible import visible_segments

RINGS = "id int, ring array<struct<x:double,y:double>>"


def star(n, rng, rough=0.5):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(math.cos(a) * r, math.sin(a) * r) for a in angles for r in [rng.uniform(1 - rough, 1)]]


def test_same_as_all_pairs(spark):
    rng, rings = random.Random(4), [None, [], [(0, 0)], [(0, 0), (1, 0)], [(0, 0), (1, 0), (0, 1)], [(0, 0), (1, 1), (1, 0), (0, 1)]]
    rings += [[(0, 0), (2, 0), (4, 0)], [(0, 0), (0, 1), (0, 2), (0, 3)], [(1e7, 1e7), (1e7 + 1, 1e7), (1e7 + 1, 1e7 + 1), (1e7, 1e7 + 1)]]
    rings += [[(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)], [(0, 0), (0, 0), (1, 0), (1, 1)], [(0, 0), (9, 0), (9, 9), (5, 9), (5, 0), (4, 0), (4, 9), (0, 9)]]
    for _ in range(60):
        own = star(rng.randint(3, 60), rng)
        if rng.random() < 0.5:
            i, k = rng.randrange(len(own)), rng.randrange(len(own))
            own[i], own[k] = own[k], own[i]
        if rng.random() < 0.2:
            own = [(round(x * 3), round(y * 3)) for x, y in own]  # edges that touch at vertices, run along each other, or are points
        rings.append(own)
    rings = [r and [(float(x), float(y)) for x, y in r] for r in rings]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rings)], RINGS)
    want = {r["id"]: r["good"] for r in frame.where("size(ring) >= 3").select("id", ring_is_simple(F.col("ring")).alias("good")).collect()}
    got = {r["id"]: r for r in ring_faults(frame.repartition(3), "id", "ring").collect()}
    assert len(got) == len(rings) and 20 < sum(want.values()) < len(want) - 20
    for i, r in got.items():
        assert (r["reason"] is None) == want.get(i, False), (rings[i], r)
    assert [got[i]["reason"] for i in range(4)] == ["no ring"] + 3 * ["fewer than three vertices"]
    assert tuple(got[5])[2:] == ("edges cross", 0, 2) and got[10]["reason"] == "edge without length" and got[10]["edge"] == 0


def test_large_rings(spark):
    rng = random.Random(7)
    good, n = star(10_000, rng, 0.02), 10_000
    bad = list(good)
    bad[4000], bad[4003] = bad[4003], bad[4000]
    holes = [*good[:50], (float("nan"), 0.0), *good[50:]]
    rows = {r["id"]: r for r in ring_faults(spark.createDataFrame([(1, good), (2, bad), (3, holes)], RINGS), "id", "ring").collect()}
    assert rows[1]["reason"] is None and rows[1]["vertices"] == n and rows[3]["reason"] == "missing coordinate"
    assert rows[2]["reason"] == "edges cross" and abs(rows[2]["edge"] - 4000) < 5 and abs(rows[2]["other"] - 4000) < 5


def test_visible_in_odd_cases(spark):
    day = dt.date(2000, 1, 1)
    rows = [(1, 0, 10, 5), (1, 2, 4, 1), (1, 4, 6, 1), (1, 3, 3, 0), (1, 8, 7, 0), (1, None, 5, 0), (1, 20, 22, 9), (1, 0, 10, 5), (2, -90_000, 90_000, 3), (2, -90_000, 90_000, 2)]
    frame = spark.createDataFrame([(k, a if a is None else day + dt.timedelta(a), day + dt.timedelta(b), o, f"{o}") for k, a, b, o in rows],
                                  "k int, a date, b date, o int, text string").repartition(3)
    got = visible_segments(frame, ["k"], "a", "b", ["o"], ["text"]).collect()
    seen = sorted((r["k"], (r["first"] - day).days, (r["after"] - day).days, r["o"], r["text"]) for r in got)
    assert seen == [(1, 0, 2, 5, "5"), (1, 2, 6, 1, "1"), (1, 6, 10, 5, "5"), (1, 20, 22, 9, "9"), (2, -90_000, 90_000, 2, "2")]
    assert visible_segments(frame.limit(0), ["k"], "a", "b", ["o"]).count() == 0
    with pytest.raises(Exception, match="outside"):
        visible_segments(frame.select("k", F.lit("1600-01-01").alias("a"), "b", "o"), ["k"], "a", "b", ["o"]).collect()


def test_visible_across_blocks(spark):
    """Long and short intervals over several blocks of days, painted day by day; neither nodes nor pieces are shuffled for a join."""
    rng = random.Random(7)
    first, days = dt.date(1998, 3, 1), 1700
    rows = [(k, a, a + rng.choice((1, 7, 90, 512, 1400)), rng.randrange(40)) for k in (1, 2) for a in (rng.randrange(days) for _ in range(150))]
    painted = {}
    for k, a, b, o in rows:
        for d in range(a, b):
            painted[k, d] = min(o, painted.get((k, d), o))
    frame = spark.createDataFrame([(k, first + dt.timedelta(a), first + dt.timedelta(b), o) for k, a, b, o in rows], "k int, a date, b date, o int")
    seen = visible_segments(frame, ["k"], "a", "b", ["o"])
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    got, spans = {}, {}
    for r in seen.collect():
        a, b = (r["first"] - first).days, (r["after"] - first).days
        spans[r["k"], a] = (b, r["o"])
        for d in range(a, b):
            assert (r["k"], d) not in got
            got[r["k"], d] = r["o"]
    assert got == painted
    assert not any(spans.get((k, b), (0, None))[1] == o for (k, _), (b, o) in spans.items())  # segments are as long as can be
