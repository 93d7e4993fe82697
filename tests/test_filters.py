import datetime as dt

import pytest
from pyspark.sql import functions as F

from firnflow.functions import filters as flt


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        (1, "S1A", "001", 10, 5, "EPSG:3413", dt.datetime(2010, 1, 1)),
        (2, "S2B", "002", 85, 40, "EPSG:3031", dt.datetime(2020, 6, 30, 23, 59)),
        (3, "L8", "002", 90, 300, None, dt.datetime(2020, 7, 1)),
    ]
    names = ["id", "platform", "version", "percent_valid_pixels", "date_dt", "proj:code", "datetime"]
    return spark.createDataFrame(rows, names)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize(
    ("make", "op"),
    [(flt.EQ, "="), (flt.NEQ, "!="), (flt.GT, ">"), (flt.GTE, ">="), (flt.LT, "<"), (flt.LTE, "<=")],
)
def test_six_operators(make, op):
    assert make(7) == flt.PropertyFilter(op, 7)


def test_expressions_keep_order_and_values():
    given = {"platform": flt.EQ("S2"), "percent_valid_pixels": flt.GTE(85.0)}
    assert flt.filter_expressions(given) == [
        {"op": "=", "args": [{"property": "platform"}, "S2"]},
        {"op": ">=", "args": [{"property": "percent_valid_pixels"}, 85.0]},
    ]


def test_plain_value_is_no_filter():
    with pytest.raises(TypeError):
        flt.filter_expressions({"platform": "S2"})


def test_conjunction_forms():
    one = {"op": "=", "args": [{"property": "a"}, 1]}
    assert flt.conjunction([]) is None
    assert flt.conjunction([one]) == one
    assert flt.conjunction([one, one]) == {"op": "and", "args": [one, one]}


def test_predicates(items):
    assert ids(items.where(flt.predicate({}))) == [1, 2, 3]
    assert ids(items.where(flt.predicate({"proj:code": flt.EQ("EPSG:3413")}))) == [1]
    assert ids(items.where(flt.predicate({"version": flt.NEQ("002")}))) == [1]
    # NULL is neither equal nor unequal.
    assert ids(items.where(flt.predicate({"proj:code": flt.NEQ("EPSG:3413")}))) == [2]
    for op, want in {"==": [1], "<>": [2, 3]}.items():
        expr = {"op": op, "args": [{"property": "platform"}, "S1A"]}
        assert ids(items.where(flt.expression_column(expr))) == want


def test_quotes_are_data(items):
    assert ids(items.where(flt.predicate({"platform": flt.EQ("x' OR '1'='1")}))) == []


def test_unknown_operator():
    with pytest.raises(ValueError):
        flt.expression_column({"op": "like", "args": [{"property": "a"}, 1]})


def test_default_filters():
    assert flt.default_filters("3413", 85.0) == {
        "percent_valid_pixels": flt.GTE(85.0),
        "proj:code": flt.EQ("EPSG:3413"),
    }


@pytest.mark.parametrize(
    ("text", "name", "op", "value"),
    [
        ("platform:=:S2", "platform", "=", "S2"),
        ("percent_valid_pixels:>=:50", "percent_valid_pixels", ">=", 50),
        ("v:<:1.5", "v", "<", 1.5),
        ("version:!=:002", "version", "!=", "002"),
        ("proj:code:=:EPSG:32717", "proj:code", "=", "EPSG:32717"),
        ("created:>=:2020-01-01", "created", ">=", "2020-01-01"),
        ("a:=:b:>:c", "a", "=", "b:>:c"),
    ],
)
def test_filter_text(text, name, op, value):
    got = flt.parse_filter(text)
    assert got == (name, flt.PropertyFilter(op, value))
    assert type(got[1].value) is type(value)


@pytest.mark.parametrize("text", ["platform=S2", "platform:S2", "platform:~:S2", ""])
def test_bad_filter_text(text):
    with pytest.raises(ValueError):
        flt.parse_filter(text)


def test_last_filter_on_a_property_stays():
    assert flt.parse_filters(["a:=:1", "a:>:2"]) == {"a": flt.GT(2)}


def test_granule_predicate_precedence(items):
    period = {"start": "2000-01-01"}

    def run(**kw):
        return ids(items.where(flt.granule_predicate(**{**period, **kw})))

    assert run() == [1, 2, 3]
    assert run(percent_valid_pixels=50) == [2, 3]
    assert run(percent_valid_pixels=50, filters={"percent_valid_pixels": flt.LTE(20)}) == [1]
    assert run(filters={"platform": None}) == [1, 2, 3]
    assert run(mission="Sentinel2") == [2]
    assert run(min_interval=6, max_interval=100) == [2]
    assert run(min_interval=6) == [2, 3]
    assert run(max_interval=100) == [1, 2]
    assert run(min_interval=6, filters={"date_dt": flt.LTE(5)}) == [1]
    assert run(start="2020-06-30", end="2020-06-30") == [2]
    assert run(start=dt.date(2020, 7, 1), end=dt.date(2020, 7, 1)) == [3]
    assert run(start="2024-01-01", time_filter=False) == [1, 2, 3]


def test_unknown_mission():
    with pytest.raises(ValueError):
        flt.mission_predicate("voyager")


def test_checks():
    assert flt.check_bbox("-50,65,-40,75") == [-50.0, 65.0, -40.0, 75.0]
    assert flt.check_polygon("0,0,1,0,1,1") == [0, 0, 1, 0, 1, 1]
    assert flt.check_date("2020-02-29") == dt.date(2020, 2, 29)
    assert flt.check_latitude(-90) == -90 and flt.check_longitude(180) == 180
    for check, bad in (
        (flt.check_bbox, "1,2,3"),
        (flt.check_bbox, "-190,0,0,0"),
        (flt.check_bbox, "a,b,c,d"),
        (flt.check_polygon, "0,0,1,0"),
        (flt.check_polygon, "0,0,1,0,1,1,2"),
        (flt.check_date, "2020/01/01"),
        (flt.check_date, "2021-02-29"),
        (flt.check_latitude, 90.1),
        (flt.check_longitude, -180.5),
    ):
        with pytest.raises(ValueError):
            check(bad)


def test_filters_reach_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumnRenamed("o_orderdate", "datetime")
    kept = orders.where(flt.time_predicate("1996-01-01", "1996-12-31")).where(F.col("o_orderkey") > 5).select("o_orderkey")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan and "GreaterThan(o_orderkey" in plan
    assert "o_totalprice" not in plan
