"""Point lists from text files: good rows and, apart, the rows that cannot be used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnflow.functions.filters import lonlat_reject_reason

# Well-known text of a point.
WKT_POINT = r"(?i)^\s*POINT\s*\(\s*([-+.0-9eE]+)\s+([-+.0-9eE]+)\s*\)\s*$"


def _judged(rows: DataFrame, lon: Column, lat: Column) -> DataFrame:
    judged = rows.withColumns({"lon": lon, "lat": lat})
    return judged.withColumn("reason", lonlat_reject_reason(F.col("lon"), F.col("lat")))


def parse_point_lines(lines: DataFrame, column: str = "value", order: str = "lonlat") -> DataFrame:
    """Adds ``lon, lat, reason`` from the first two fields of comma-separated lines; ``reason`` is NULL for good rows.

    Every row is judged by itself, and zero is a position like any other.
    """
    fields = F.from_csv(F.col(column), F.lit("a string, b string"), {"mode": "PERMISSIVE"})
    first, second = (F.trim(fields[n]).try_cast("double") for n in ("a", "b"))
    lon, lat = (first, second) if order == "lonlat" else (second, first)
    return _judged(lines, lon, lat)


def parse_wkt_points(rows: DataFrame, column: str, order: str = "latlon") -> DataFrame:
    """The same from ``POINT (a b)`` text."""
    a, b = (F.regexp_extract(F.col(column), WKT_POINT, i).try_cast("double") for i in (1, 2))
    lon, lat = (b, a) if order == "latlon" else (a, b)
    return _judged(rows, lon, lat)


def good_points(judged: DataFrame) -> DataFrame:
    return judged.where("reason IS NULL").drop("reason")


def rejected_points(judged: DataFrame) -> DataFrame:
    return judged.where("reason IS NOT NULL")


def read_points(spark: SparkSession, path: str, order: str = "lonlat", header: bool = False) -> DataFrame:
    """Points of a CSV file with ``lon, lat, reason``; a header line, if there is one, is not a point."""
    lines = spark.read.text(path)
    if header:
        lines = lines.where(~F.lower("value").rlike(r"^\s*\"?(lat|lon)"))
    return parse_point_lines(lines, order=order)


def with_point_ids(points: DataFrame) -> DataFrame:
    """Adds ``point_id``, a hash of the position that is the same in every run; equal positions become one point."""
    return points.dropDuplicates(["lon", "lat"]).withColumn("point_id", F.xxhash64("lon", "lat"))
