"""Domain tables as views over the driver's tables.

Every view is one table and a list of select expressions written in the SQL that Spark and DuckDB share, so the same text
gives both sides of a comparison.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firnflow.operators.bounded import settled
from firnflow.session import utc


class View(NamedTuple):
    table: str
    columns: tuple[str, ...]

    @property
    def sql(self) -> str:
        return f"SELECT {', '.join(self.columns)} FROM {self.table}"


_HALF = "(0.25e0 + (o_orderkey % 8) / 8e0)"
_CX = "(-75 + (o_orderkey * 37 % 5000) / 1e2)"
_CY = "(60 + (o_orderkey * 61 % 2500) / 1e2)"
_ROI_CX = "(-74e0 + (s_suppkey * 53 % 4800) / 1e2)"
_ROI_CY = "(61e0 + (s_suppkey * 67 % 2300) / 1e2)"
_ROI_HALF = "(0.517e0 + (s_suppkey % 5) / 9e0)"

VIEWS = {
    "granules": View(
        "orders",
        (
            "o_orderkey AS granule_id",
            f"{_CX} - {_HALF} AS minx",
            f"{_CY} - {_HALF} AS miny",
            f"{_CX} + {_HALF} AS maxx",
            f"{_CY} + {_HALF} AS maxy",
            "o_orderdate AS datetime",
            "CAST(o_orderkey * 7 % 546 AS INT) AS date_dt",
            "CAST(floor(o_totalprice / 5000) AS INT) AS percent_valid_pixels",
            "CASE o_orderkey % 7 WHEN 0 THEN 'S1A' WHEN 1 THEN 'S1B' WHEN 2 THEN 'S2A' WHEN 3 THEN 'S2B' "
            "WHEN 4 THEN 'L7' WHEN 5 THEN 'L8' ELSE 'L9' END AS platform",
            "CASE WHEN o_orderkey % 5 = 0 THEN '001' ELSE '002' END AS version",
            "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'EPSG:3413' END AS proj_code",
            "concat('https://example.org/pairs/g', CAST(o_orderkey AS STRING), '.nc') AS href",
        ),
    ),
    "granule_assets": View(
        "orders",
        (
            "o_orderkey AS granule_id",
            "concat('{\"data\":{\"href\":\"https://example.org/pairs/g', CAST(o_orderkey AS STRING), "
            "CASE WHEN o_orderkey % 9 = 0 THEN '.tif' ELSE '.nc' END, '\",\"roles\":[\"data\"]},"
            "\"thumbnail\":{\"href\":\"https://example.org/pairs/g', CAST(o_orderkey AS STRING), "
            "'.png\",\"roles\":[\"thumbnail\"]}}') AS assets",
        ),
    ),
    "cubes": View(
        "nation",
        (
            "CAST(n_nationkey AS BIGINT) AS cube_id",
            "3413 AS epsg",
            "CAST(-75 + (n_nationkey % 5) * 10 AS DOUBLE) AS minx",
            "CAST(60 + floor(n_nationkey / 5) * 5 AS DOUBLE) AS miny",
            "CAST(-65 + (n_nationkey % 5) * 10 AS DOUBLE) AS maxx",
            "CAST(65 + floor(n_nationkey / 5) * 5 AS DOUBLE) AS maxy",
            "concat('https://example-data.s3.amazonaws.com/datacubes/v2/N', CAST(60 + n_nationkey AS STRING), "
            "'W040/ICE_vel_EPSG3413_G0120_X-', CAST(n_nationkey * 1000 AS STRING), '_Y-50000.zarr') AS zarr_url",
            "CASE WHEN n_nationkey % 6 = 5 THEN '' ELSE concat('https://example-data.s3.amazonaws.com/composites/c', "
            "CAST(n_nationkey AS STRING), '.zarr') END AS composite_zarr_url",
            "-1500000e0 + 520000e0 * (n_nationkey % 5) + 60000e0 * floor(n_nationkey / 5) AS x0",
            "-2700000e0 + 550000e0 * floor(n_nationkey / 5) AS y0",
            "100000e0 AS dx",
            "-70000e0 AS dy",
            "5 AS nx",
            "8 AS ny",
            # The cube's box in its own system: half a cell around the outer cell centres.
            "-1550000e0 + 520000e0 * (n_nationkey % 5) + 60000e0 * floor(n_nationkey / 5) AS xmin",
            "-1050000e0 + 520000e0 * (n_nationkey % 5) + 60000e0 * floor(n_nationkey / 5) AS xmax",
            "-3225000e0 + 550000e0 * floor(n_nationkey / 5) AS ymin",
            "-2665000e0 + 550000e0 * floor(n_nationkey / 5) AS ymax",
        ),
    ),
    "points": View(
        "customer",
        (
            "c_custkey AS point_id",
            "-80 + (c_custkey * 37 % 6000) / 1e2 AS lon",
            "58 + (c_custkey * 61 % 2900) / 1e2 AS lat",
        ),
    ),
    "south_points": View(
        "customer",
        (
            "c_custkey AS point_id",
            "-180 + (c_custkey * 37 % 36000) / 1e2 AS lon",
            "-55 - (c_custkey * 61 % 3400) / 1e2 AS lat",
        ),
    ),
    "utm_points": View(
        "customer",
        (
            "c_custkey AS point_id",
            "-179.5e0 + (c_custkey * 211 % 35900) / 1e2 AS lon",
            "-79.5e0 + (c_custkey * 61 % 15900) / 1e2 AS lat",
        ),
    ),
    "observations": View(
        "lineitem",
        (
            "l_suppkey AS point_id",
            "l_suppkey % 25 AS cube_id",
            "CAST(floor(l_suppkey / 25) % 5 AS INT) AS ix",
            "CAST(floor(l_suppkey / 125) % 8 AS INT) AS iy",
            "l_shipdate AS mid_date",
            "l_quantity * 11 AS date_dt_days",
            "CASE WHEN l_tax = 0 THEN NULL ELSE 7 * sqrt(l_extendedprice) END AS v",
            "l_discount * 100 AS v_error",
            "CASE WHEN l_tax = 0 THEN NULL ELSE 4 * sqrt(l_extendedprice) END AS vx",
            "l_discount * 70 AS vx_error",
            "CASE WHEN l_tax = 0 THEN NULL ELSE -6 * sqrt(l_extendedprice) END AS vy",
            "l_discount * 60 AS vy_error",
            "CASE l_linenumber WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '4' WHEN 4 THEN '5' "
            "WHEN 5 THEN '7' WHEN 6 THEN '8' ELSE '9' END AS satellite_img1",
            "CASE WHEN l_linenumber <= 2 THEN 'S' ELSE 'L' END AS mission_img1",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
        ),
    ),
    "grid": View(
        "part",
        (
            "p_partkey % 50 AS ix",
            "CAST(floor(p_partkey / 50) AS INT) AS iy",
            "240e0 * (p_partkey % 50) AS x",
            "0e0 - 240e0 * floor(p_partkey / 50) AS y",
            "p_retailprice AS v",
        ),
    ),
    "probes": View(
        "supplier",
        (
            "s_suppkey AS probe_id",
            "120e0 * (s_suppkey % 101) AS px",
            "0e0 - 60e0 * (s_suppkey % 41) AS py",
        ),
    ),
    "rois": View(
        "supplier",
        (
            "s_suppkey AS roi_id",
            f"{_ROI_CX} AS roi_cx",
            f"{_ROI_CY} AS roi_cy",
            f"{_ROI_HALF} AS roi_half",
            f"{_ROI_CX} - {_ROI_HALF} AS roi_minx",
            f"{_ROI_CY} - {_ROI_HALF} AS roi_miny",
            f"{_ROI_CX} + {_ROI_HALF} AS roi_maxx",
            f"{_ROI_CY} + {_ROI_HALF} AS roi_maxy",
        ),
    ),
    "saved_searches": View(
        "supplier",
        (
            "s_suppkey AS search_id",
            "CASE s_suppkey % 5 WHEN 0 THEN concat('percent_valid_pixels:>=:', CAST(s_suppkey % 60 AS STRING)) "
            "WHEN 1 THEN concat('date_dt:>=:', CAST(s_suppkey % 500 AS STRING)) WHEN 2 THEN concat('minx:>:', CAST(-75 + s_suppkey % 40 AS STRING), '.25') "
            "WHEN 3 THEN concat('href:>=:https://example.org/pairs/g', CAST(10 + s_suppkey % 80 AS STRING)) "
            "ELSE concat('percent_valid_pixels:!=:', CAST(s_suppkey % 60 AS STRING)) END AS first_text",
            "CASE s_suppkey % 5 WHEN 0 THEN concat('platform:=:S2', CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'B' END) "
            "WHEN 1 THEN concat('date_dt:<:', CAST(s_suppkey % 500 + 30 AS STRING)) WHEN 2 THEN concat('maxx:<:', CAST(-72 + s_suppkey % 40 AS STRING)) "
            "WHEN 3 THEN concat('href:<:https://example.org/pairs/g', CAST(11 + s_suppkey % 80 AS STRING)) ELSE 'version:!=:002' END AS second_text",
            "CASE WHEN s_suppkey % 17 = 0 THEN 'no operator here' WHEN s_suppkey % 3 = 0 THEN 'proj_code:=:EPSG:3413' "
            "WHEN s_suppkey % 19 = 0 THEN 'date_dt:=:many' ELSE 'version:>:000' END AS third_text",
        ),
    ),
    # Vectors as chunks of 4 time steps and 4 by 4 cells, of 23 cubes that are five chunks high.
    "value_chunks": View(
        "embeddings",
        (
            "CAST(vec_id % 23 AS BIGINT) AS cube_id",
            "CAST(floor(vec_id / 23) AS BIGINT) % 5 AS cy",
            "CAST(floor(vec_id / 115) AS BIGINT) AS cx",
            "embedding AS values",
        ),
    ),
    # A third of all points lie on one cell.
    "chunk_points": View(
        "orders",
        (
            "o_orderkey AS point_id",
            "CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE o_orderkey % 25 END AS BIGINT) AS cube_id",
            "CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE floor(o_orderkey / 25) END AS BIGINT) % 11 AS ix",
            "CAST(CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_orderkey * 61 END AS BIGINT) % 21 AS iy",
        ),
    ),
    # One irregular axis per cube; its lines and the probes lie on eighths, so that ties are exact.
    "axis_lines": View(
        "part",
        (
            "CAST(p_partkey % 23 AS BIGINT) AS cube_id",
            "-85e0 + (p_partkey * p_partkey * 37 + p_partkey * 11) % 683 / 4e0 AS axis_value",
            "p_partkey AS line_id",
        ),
    ),
    "axis_probes": View(
        "orders",
        (
            "o_orderkey AS probe_id",
            "CAST(CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_orderkey % 25 END AS BIGINT) AS cube_id",
            "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE -90e0 + o_orderkey * 61 % 1601 / 8e0 END AS wanted",
        ),
    ),
    "polylines": View(
        "orders",
        (
            "o_custkey AS profile_id",
            "o_orderkey AS seq",
            "130e0 * (o_orderkey * 37 % 53) + o_custkey AS x",
            "170e0 * (o_orderkey * 61 % 47) AS y",
        ),
    ),
    "profiles": View(
        "supplier",
        (
            "CAST(floor(s_suppkey / 5) AS BIGINT) AS profile_id",
            "s_suppkey % 5 AS seq",
            "-1400000e0 + 371000e0 * (s_suppkey % 5) + 1300e0 * (s_suppkey % 211) AS x",
            "-2900000e0 + 53000e0 * (s_suppkey % 37) + 911e0 * (s_suppkey % 5) * (s_suppkey % 5) AS y",
        ),
    ),
    "elevation": View(
        "events",
        (
            "CAST(user_id % 12 AS INT) AS ix",
            "CAST(floor(user_id / 12) % 12 AS INT) AS iy",
            "ts AS time",
            "CASE WHEN event_type = 'error' THEN NULL ELSE value / 100 - 2 END AS dh",
            "event_id",
        ),
    ),
    "saved_filters": View(
        "orders",
        (
            "o_orderkey AS filter_id",
            "CASE o_orderkey % 8 "
            "WHEN 0 THEN concat('percent_valid_pixels:>=:', CAST(o_orderkey % 100 AS STRING)) "
            "WHEN 1 THEN 'proj:code:=:EPSG:3413' WHEN 2 THEN 'version:!=:002' "
            "WHEN 3 THEN concat('date_dt:<:', CAST(o_orderkey % 50 AS STRING), '.5') WHEN 4 THEN 'platform:=:S2' "
            "WHEN 5 THEN concat('created:>:', CAST(1990 + o_orderkey % 30 AS STRING), '-01-01') "
            "WHEN 6 THEN 'no operator here' ELSE concat('a:b:<=:', CAST(o_orderkey AS STRING), ':=:c') END AS filter_text",
        ),
    ),
    "cube_items": View(
        "customer",
        (
            "c_custkey AS item_id",
            "CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'EPSG:3031' ELSE 'EPSG:3413' END AS proj_code",
            "concat('{\"a\":{\"href\":\"https://example-data.s3.amazonaws.com/datacubes/v2/N70W0', "
            "CAST(10 + c_custkey % 80 AS STRING), '/ICE_vel_EPSG3413_G0120_X', CASE WHEN c_custkey % 2 = 0 THEN '-' ELSE '' END, "
            "CAST(c_custkey * 1000 AS STRING), '_Y-50000.zarr\",\"roles\":[\"', "
            "CASE WHEN c_custkey % 5 = 0 THEN 'overview' ELSE 'data' END, '\"]},"
            "\"b\":{\"href\":\"http://example.org/x/', CAST(c_custkey AS STRING), CASE WHEN c_custkey % 3 = 0 THEN '.zarr' "
            "ELSE '.nc' END, '\",\"roles\":[\"data\"]}}') AS assets",
        ),
    ),
    "point_lines": View(
        "customer",
        (
            "c_custkey AS line_id",
            "CASE c_custkey % 9 WHEN 7 THEN concat('-46.', CAST(c_custkey AS STRING), 'es1,70.045') "
            "WHEN 8 THEN concat(CAST(181 + c_custkey AS STRING), ',10.5') "
            "ELSE concat('-', CAST(c_custkey % 180 AS STRING), '.25,', CAST(c_custkey % 120 AS STRING), '.5') END AS value",
        ),
    ),
    "wkt_lines": View(
        "customer",
        (
            "c_custkey AS line_id",
            "CASE WHEN c_custkey % 11 = 0 THEN 'POINT EMPTY' ELSE concat('POINT (', CAST(c_custkey % 90 AS STRING), '.5 -', "
            "CAST(c_custkey % 180 AS STRING), '.25)') END AS wkt",
        ),
    ),
}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; its schema is looked up once, as that takes a job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = utc(spark).read.parquet(path).schema
    return utc(spark).read.schema(_SCHEMAS[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the domain views."""
    v = VIEWS[name]
    return table(spark, sf_dir, v.table).selectExpr(*v.columns)


def settled_view(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str]) -> DataFrame:
    """A view of which some columns act as stored ones.

    A real catalog stores its boxes; the view derives them, and a spatial test would derive them anew at every mention.
    """
    df = view(spark, sf_dir, name)
    return settled(df, {c: F.col(c) for c in columns}).select(*df.columns)
