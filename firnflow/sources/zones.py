"""Zone map of a stored catalog: one row per file, by which a search chooses the files it opens.

A row holds the file's path, its rows, the box around its footprints, its first and last time, the least and greatest value of
number properties, and the values of text properties that have few.  It is written beside the catalog, takes in files that are
added later without reading the others again, and is some hundred bytes per file.  A search turns each of its conditions into a
test of these rows; the surviving paths are scanned, the others not even opened for their footers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnflow.functions import rings
from firnflow.functions.filters import DEFAULT_END, DEFAULT_START, MISSION_PLATFORMS, PropertyFilter, all_of, any_of, as_date, property_column
from firnflow.operators.search import BOX, search
from firnflow.sources.catalog import _ABSENT, _files, _lenient

# Different values up to which those of a text property are listed; beyond it the property tells nothing.
FEW = 64
# Surviving paths that the driver hands to one scan; beyond it the whole catalog is scanned, with the same result.
MOST_PATHS = 100_000

NUMBERS = ("percent_valid_pixels", "date_dt")
TEXTS = ("platform", "version", "proj:code", "proj_code", "collection")


def _rows(spark: SparkSession, base: str, paths: Sequence[str] | None = None) -> DataFrame | None:
    """Catalog rows of some files or all, with ``source_parquet`` and the columns that the folders name."""
    reader = _lenient(spark, False).option("basePath", base)
    df = _files(reader, base) if paths is None else reader.parquet(*paths)
    return None if df is None else df.withColumn("source_parquet", F.col("_metadata.file_path"))


def zones_of(rows: DataFrame, time: str = "datetime", numbers: Sequence[str] = NUMBERS, texts: Sequence[str] = TEXTS) -> DataFrame:
    """A row per ``source_parquet``; properties that the rows lack are left out.  NULL does not count."""
    have = set(rows.columns)
    # NaN is the greatest of all numbers here as in the comparisons of a search.
    ends = [f(property_column(n).cast("double")).alias(f"{n}_{e}") for n in numbers if n in have for f, e in ((F.min, "min"), (F.max, "max"))]
    # Up to FEW values and one more per task and file are held; a set that is longer is given up below.
    few = [F.collect_set(property_column(n)).alias(f"{n}_values") for n in texts if n in have]
    seconds = F.unix_micros(F.col(time).cast("timestamp"))
    made = rows.groupBy("source_parquet").agg(
        F.count("*").alias("rows"),
        *(f(n).alias(f"z_{n}") for f, n in zip((F.min, F.min, F.max, F.max), BOX)),
        F.timestamp_micros(F.min(seconds)).alias("first_time"),
        F.timestamp_micros(F.max(seconds)).alias("last_time"),
        *ends,
        *few,
    )
    return made.withColumns({f"{n}_values": F.when(F.size(f"`{n}_values`") <= FEW, F.col(f"`{n}_values`")) for n in texts if n in have})


def write_zones(spark: SparkSession, base: str, path: str, **columns: Any) -> int:
    """Adds the zones of all files of the catalog at ``base`` that ``path`` does not hold yet; how many these are.

    Run it again after files were added: only those are read.  ``columns`` as in ``zones_of``, the same for every run.
    """
    held = _files(spark.read, path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    try:
        there = files.load(base).select(F.col("path").alias("source_parquet"))  # contents are not read
    except Exception as err:
        if any(a in str(err) for a in _ABSENT):
            return 0
        raise
    if held is not None:
        there = there.join(held.select("source_parquet"), "source_parquet", "left_anti")
    new = [r["source_parquet"] for r in there.toLocalIterator()]
    for at in range(0, len(new), MOST_PATHS):
        zones_of(_rows(spark, base, new[at : at + MOST_PATHS]), **columns).coalesce(1).write.mode("append").parquet(path)
    return len(new)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def _condition(zones: DataFrame, name: str, op: str, value: Any) -> Column:
    """May a file hold a row whose property compares so?  TRUE where the zones do not tell."""
    low, high, values = (F.col(f"`{name}_{end}`") if f"{name}_{end}" in zones.columns else None for end in ("min", "max", "values"))
    if low is not None and isinstance(value, (int, float)) and not isinstance(value, bool):
        v = F.lit(float(value))
        tests = {"=": (low <= v) & (high >= v), "==": (low <= v) & (high >= v), ">=": high >= v, ">": high > v, "<=": low <= v, "<": low < v,
                 "!=": (low != v) | (high != v), "<>": (low != v) | (high != v)}
        return F.coalesce(tests[op], F.lit(False))  # a file without any value has no such row
    if values is not None and isinstance(value, str):
        tests = {"=": lambda x: x == value, "==": lambda x: x == value, "!=": lambda x: x != value, "<>": lambda x: x != value, ">=": lambda x: x >= value,
                 ">": lambda x: x > value, "<=": lambda x: x <= value, "<": lambda x: x < value}
        return values.isNull() | F.exists(values, tests[op])
    return F.lit(True)


def surviving(
    zones: DataFrame,
    bbox: Sequence[float] | None = None,
    polygon: Sequence | None = None,
    geojson: Mapping[str, Any] | None = None,
    percent_valid_pixels: float = 1,
    mission: str | None = None,
    start: Any = None,
    end: Any = None,
    min_interval: float | None = None,
    max_interval: float | None = None,
    filters: Mapping[str, PropertyFilter | None] | None = None,
    collection: str | None = None,
    time_filter: bool = True,
) -> DataFrame:
    """Zones of the files that can hold a match; the conditions are those of ``operators.search.match``."""
    roi = rings.region(bbox, polygon, geojson)
    if roi is None:
        return zones.limit(0)
    given = {k: v for k, v in (filters or {}).items() if v is not None}
    tests = [rings.region_meets_box(roi, [F.col("z_" + n) for n in BOX])]
    tests += [_condition(zones, n, f.op, f.value) for n, f in given.items()]
    asked = filters or {}
    if percent_valid_pixels > 0 and "percent_valid_pixels" not in asked:
        tests.append(_condition(zones, "percent_valid_pixels", ">=", percent_valid_pixels))
    if mission and "platform" not in asked:
        tests.append(any_of(_condition(zones, "platform", "=", p) for p in MISSION_PLATFORMS.get(mission.lower(), ())))
    if min_interval is not None and (max_interval is not None or "date_dt" not in asked):
        tests.append(_condition(zones, "date_dt", ">=", min_interval))
    if max_interval is not None and (min_interval is not None or "date_dt" not in asked):
        tests.append(_condition(zones, "date_dt", "<=", max_interval))
    if collection is not None:
        tests.append(_condition(zones, "collection", "=", collection))
    if time_filter:
        first, last = as_date(start, DEFAULT_START), as_date(end, DEFAULT_END)
        tests.append((F.col("last_time") >= F.lit(f"{first} 00:00:00").cast("timestamp")) & (F.col("first_time") < F.date_add(F.lit(last), 1).cast("timestamp")))
    return zones.where(all_of(tests))


def read_surviving(spark: SparkSession, base: str, path: str, most_paths: int = MOST_PATHS, **conditions: Any) -> DataFrame:
    """Rows of the catalog at ``base`` from the files that its zones at ``path`` let through; rows are not yet tested.

    A file that is gone is not looked for; one that the zones do not hold yet is not seen: run ``write_zones`` first.
    """
    zones = read_zones(spark, path)
    paths = [r["source_parquet"] for r in surviving(zones, **conditions).select("source_parquet").limit(most_paths + 1).collect()]
    if len(paths) > most_paths:
        return _rows(spark, base)
    if not paths:
        paths = [zones.select("source_parquet").first()["source_parquet"]]
        return _rows(spark, base, paths).limit(0)
    return _rows(spark, base, paths)


def search_zoned(spark: SparkSession, base: str, path: str, asset_type: str = ".nc", ordered: bool = False, **conditions: Any) -> DataFrame:
    """``operators.search.search`` on a stored catalog with a zone map."""
    rows = read_surviving(spark, base, path, **conditions)
    return search(rows, asset_type, ordered, **conditions)
