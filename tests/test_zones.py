"""Zone maps: the same rows as without them, from fewer files, also after files were added."""

import random

import pytest
from pyspark.sql import functions as F

from firnflow.functions import filters as flt
from firnflow.operators import search
from firnflow.sources import catalog, zones

GRANULES = (
    "granule_id long, minx double, miny double, maxx double, maxy double, datetime timestamp_ntz, date_dt int, percent_valid_pixels double, "
    "platform string, version string, `proj:code` string, href string, odd string"
)


def made(spark, seed, n=600):
    import datetime as dt

    rng, rows = random.Random(seed), []
    for i in range(n):
        x, y = rng.uniform(-60, 20), rng.uniform(55, 80)
        share = rng.choice([None, float("nan"), rng.uniform(0, 100)])
        rows.append((seed * n + i, x, y, x + 0.4, y + 0.4, dt.datetime(2015 + int(x) % 7, 1 + i % 12, 3), i % 90, share, rng.choice(["S1A", "S2A", "L8", None]),
                     rng.choice(["001", "002"]), f"EPSG:{32600 + int(x + 80) % 60}", f"https://e.org/{seed}-{i}.nc", f"t{i}"))
    return spark.createDataFrame(rows, GRANULES)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base, path = (str(tmp_path_factory.mktemp("zoned") / n) for n in ("granules", "zones"))
    assert zones.write_zones(spark, base, path) == 0
    added = []
    for seed in (1, 2):
        catalog.write_catalog(made(spark, seed), base, files=4, append=True)
        added.append(zones.write_zones(spark, base, path, texts=(*zones.TEXTS, "odd")))
    assert min(added) > 20 and zones.write_zones(spark, base, path) == 0
    assert zones.read_zones(spark, path).agg(F.sum("rows")).first()[0] == 1200
    return base, path


CASES = [
    {"bbox": (-50, 60, -45, 65)}, {"bbox": (-50, 60, -45, 65), "percent_valid_pixels": 95, "mission": "sentinel1"}, {"polygon": [(-60, 55), (20, 55), (20, 80)]},
    {"bbox": (-180, -90, 180, 90), "start": "2016-01-01", "end": "2016-12-31"}, {"bbox": (-180, -90, 180, 90), "min_interval": 80, "max_interval": 85},
    {"bbox": (-180, -90, 180, 90), "filters": {"proj:code": flt.EQ("EPSG:32625"), "percent_valid_pixels": None}}, {"bbox": (100, 0, 110, 10)}, {},
    {"bbox": (-180, -90, 180, 90), "filters": {"proj:code": flt.GT("EPSG:32650"), "odd": flt.EQ("t7")}, "percent_valid_pixels": 0},
    {"bbox": (-60, 55, 0, 70), "filters": {"date_dt": flt.NEQ(3), "version": flt.NEQ("002"), "platform": flt.LT("M")}, "min_interval": 5},
    {"bbox": (-60, 55, 0, 70), "filters": {"percent_valid_pixels": flt.LT(2), "granule_id": flt.GTE(700)}, "time_filter": False},
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_same_rows(spark, stored, case):
    base, path = stored
    where = {"start": "2010-01-01", **CASES[case]} if CASES[case] else {}
    whole = catalog.read_hive_catalog(spark, base, merge=False)
    want = sorted(r.href for r in search.search(whole, **where).collect())
    for most in (100_000, 1):
        rows = zones.read_surviving(spark, base, path, most, **where)
        assert sorted(r.href for r in search.search(rows, **where).collect()) == want and "tile" in rows.columns
    assert sorted(r.href for r in zones.search_zoned(spark, base, path, **where).collect()) == want


def test_fewer_files(spark, stored):
    base, path = stored
    whole = len(catalog.read_hive_catalog(spark, base, merge=False).inputFiles())
    read = [len(zones.read_surviving(spark, base, path, **{"start": "2010-01-01", **CASES[i]}).inputFiles()) for i in (0, 5)]
    assert 0 < read[0] < whole / 10 and 0 < read[1] < whole / 2


def test_many_values_tell_nothing(spark, stored):
    base, path = stored
    held = zones.read_zones(spark, path)
    assert held.where(F.size("odd_values") > zones.FEW).count() == 0 and held.where("size(platform_values) = 3").count() > 0
