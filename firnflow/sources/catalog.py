"""Granule and cube catalogs as files: layouts, readers, and the writer that lays a catalog out for pruning."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnflow.functions.urls import file_name
from firnflow.operators.search import ASSETS_TYPE, with_tile

# The missions of the latitude/longitude layout, and the hexagon resolutions that exist.
LATLON_MISSIONS = ("landsatOLI", "sentinel1", "sentinel2")
HEXAGON_RESOLUTIONS = (1, 2)

ITEM_TYPE = (
    "id string, collection string, bbox array<double>, geometry string, "
    "properties map<string,string>, assets " + ASSETS_TYPE
)


def catalog_path(base: str, partition_type: str = "h3", resolution: int = 1) -> str:
    """Folder of a catalog below ``base`` for a layout; a layout that does not exist is an error."""
    if partition_type == "latlon":
        return f"{base.rstrip('/')}/latlon"
    if partition_type != "h3":
        raise ValueError(f"partition_type {partition_type!r}: wanted 'h3' or 'latlon'")
    if resolution not in HEXAGON_RESOLUTIONS:
        raise ValueError(f"resolution {resolution}: wanted one of {HEXAGON_RESOLUTIONS}")
    return f"{base.rstrip('/')}/h3r{resolution}"


# The columns a search reads, which an absent catalog has too.
GRANULE_TYPE = (
    "id string, collection string, minx double, miny double, maxx double, maxy double, datetime timestamp, platform string, version string, "
    "`proj:code` string, percent_valid_pixels double, date_dt double, created timestamp, updated timestamp, assets " + ASSETS_TYPE
)
# Cells of the finer of the two resolutions.
MOST_HEXAGONS = 5882
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _lenient(spark: SparkSession, merge: bool):
    return spark.read.option("mergeSchema", merge).option("ignoreMissingFiles", True)


def _files(reader, place: str) -> DataFrame | None:
    try:
        return reader.parquet(place)
    except AnalysisException as err:
        if err.getCondition() in _ABSENT:
            return None
        raise


def _scanned(spark: SparkSession, path: str, merge: bool, recursive: bool, like: str | None = None, **derived: str) -> DataFrame:
    """The files of a path or pattern with ``source_parquet``; where there are none, no row.

    The columns of an empty result are those of the files at ``like`` if it has some, else ``GRANULE_TYPE`` and ``derived``.
    """
    reader = _lenient(spark, merge).option("recursiveFileLookup", recursive)
    df = _files(reader, path)
    if df is not None:
        return df.withColumn("source_parquet", F.col("_metadata.file_path"))
    known = _files(reader, like) if like else None
    if known is None:
        known = spark.createDataFrame([], GRANULE_TYPE).withColumns({n: F.lit(None).cast(t) for n, t in derived.items()})
    return known.limit(0).withColumn("source_parquet", F.lit(None).cast("string"))


def read_hive_catalog(
    spark: SparkSession, path: str, level: int | None = None, tiles: Sequence[str] | None = None, merge: bool = True
) -> DataFrame:
    """Catalog under ``grid=…/level=…/tile=…``; schemas are merged by name, conditions on the keys prune folders.

    Set ``merge`` to False once all files share one schema: merging opens every file's footer.  A path that is not there has no rows.
    """
    df = _scanned(spark, path, merge, False, grid="string", level="int", tile="string").withColumn("tile", F.col("tile").cast("string"))
    if level is not None:
        df = df.where(F.col("level") == level)
    return df if tiles is None else df.where(F.col("tile").isin(list(tiles)))


def read_latlon_catalog(
    spark: SparkSession, path: str, tiles: Sequence[str] | None = None, merge: bool = True
) -> DataFrame:
    """Catalog under ``<mission>/<tile>/``; mission and tile come from the path.  Absent tiles, or an absent path, give no rows.

    Tiles asked for are turned into path patterns, so other folders are not listed.
    """
    root = path.rstrip("/")
    missions = "{" + ",".join(LATLON_MISSIONS) + "}"
    wanted = "*" if tiles is None else "{" + ",".join(tiles) + "}"
    # Another tile, if there is one, tells an empty result's columns.
    df = _scanned(spark, f"{root}/{missions}/{wanted}", merge, True, None if tiles is None else f"{root}/{missions}/*")
    pattern = r"/([^/]+)/([NS]\d{2}[EW]\d{3})/"
    source = F.col("source_parquet")
    return df.withColumns(
        {"mission": F.regexp_extract(source, pattern, 1), "tile": F.regexp_extract(source, pattern, 2)}
    )


def integer_tile(hexagon: Column) -> Column:
    """Folder name of a hexagon in the older layout: its hexadecimal id as a decimal number."""
    return F.conv(hexagon, 16, 10)


def read_integer_catalog(
    spark: SparkSession, path: str, hexagons: DataFrame | Sequence[str] | None = None, merge: bool = True
) -> DataFrame:
    """Catalog under ``<decimal tile>/``; ``hexagons`` are the hexadecimal ids asked for, or a table of them (``tile``).

    Their folders become path patterns, so others are not even listed; absent ones, or an absent path, give no rows.  There are
    at most ``MOST_HEXAGONS`` ids of a resolution, so more is an error.
    """
    root = path.rstrip("/")
    pattern, like = root, None
    if hexagons is not None:
        if isinstance(hexagons, DataFrame):
            names = hexagons.select(integer_tile(F.col("tile")).alias("d")).where("d IS NOT NULL").distinct().limit(MOST_HEXAGONS + 1)
            folders = sorted(r["d"] for r in names.collect())
        else:
            folders = sorted({str(int(h, 16)) for h in hexagons})
        if len(folders) > MOST_HEXAGONS:
            raise ValueError(f"more than the {MOST_HEXAGONS} hexagons there are")
        pattern, like = f"{root}/{{{','.join(folders or ['none'])}}}", root
    df = _scanned(spark, pattern, merge, True, like)
    # The first folder below the base names the tile; more folders may follow.
    base = re.escape(root.rsplit("/", 1)[-1])
    return df.withColumn("directory", F.regexp_extract("source_parquet", rf"/{base}/(\d+)/", 1))


def write_catalog(
    granules: DataFrame, path: str, grid: str = "latlon", level: int = 0, files: int | None = None, append: bool = False
) -> None:
    """Lay a catalog out for search: folders by tile, inside them files that cover small boxes.

    Rows are range-partitioned on tile and position.  The ranges follow the data, so a tile with a third of all
    granules becomes many files and each file's box statistics are narrow; sparse tiles share a task.  With ``append`` files are added to those that are there.
    """
    rows = granules if "tile" in granules.columns else with_tile(granules)
    rows = rows.withColumns({"grid": F.lit(grid), "level": F.lit(level)})
    keys = ["tile", "minx", "miny"]
    ranged = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("append" if append else "error").partitionBy("grid", "level", "tile").parquet(path)


def union_catalogs(*parts: DataFrame) -> DataFrame:
    """Several catalogs as one, matched by column name; columns a part lacks are NULL there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_landed_files(spark: SparkSession, path: str, suffix: str = ".nc", content: bool = False) -> DataFrame:
    """Downloaded files next to a manifest: ``path, filename, length`` and, if asked for, their bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path)
    named = files.withColumn("filename", file_name(F.col("path")))
    return named.select("path", "filename", "length", *(["content"] if content else []))


# ---- items -------------------------------------------------------------------------------------------------------


def read_items(spark: SparkSession, path: str, collection: str | None = None) -> DataFrame:
    """Harvested catalog items, one JSON object per line, with nested ``properties`` and ``assets``."""
    items = spark.read.schema(ITEM_TYPE).json(path)
    return items if collection is None else items.where(F.col("collection") == collection)


def flatten_items(items: DataFrame, properties: dict[str, str] | None = None) -> DataFrame:
    """Items with their box as four columns and the named properties as typed flat columns."""
    # The properties a search filters on, with their types.
    typed = properties or {
        "datetime": "timestamp",
        "platform": "string",
        "version": "string",
        "proj:code": "string",
        "percent_valid_pixels": "double",
        "date_dt": "double",
        "created": "timestamp",
        "updated": "timestamp",
    }
    box = [F.try_element_at("bbox", F.lit(i)).alias(n) for i, n in enumerate(("minx", "miny", "maxx", "maxy"), start=1)]
    props = [F.try_element_at("properties", F.lit(n)).cast(t).alias(n) for n, t in typed.items()]
    return items.select("id", "collection", *box, *props, "assets")


def read_cube_collection(spark: SparkSession, path: str) -> DataFrame:
    """Older cube catalog, a GeoJSON FeatureCollection: one row per feature with both footprints as open rings."""
    vertex = "array<array<array<double>>>"
    properties = f"struct<epsg:int,data_epsg:string,zarr_url:string,geometry_epsg:struct<coordinates:{vertex}>>"
    schema = f"features array<struct<geometry:struct<coordinates:{vertex}>,properties:{properties}>>"
    features = spark.read.schema(schema).option("multiLine", True).json(path).select(F.posexplode("features"))
    f = F.col("col")

    def ring(coordinates: Column) -> Column:
        outer = F.element_at(coordinates, 1)
        points = F.transform(outer, lambda v: F.struct(F.element_at(v, 1).alias("x"), F.element_at(v, 2).alias("y")))
        return F.slice(points, F.lit(1), F.size(points) - 1)

    cubes = features.select(
        F.col("pos").cast("long").alias("cube_id"),
        F.coalesce(f["properties"]["epsg"], F.replace(f["properties"]["data_epsg"], F.lit("EPSG:"), F.lit("")).cast("int"))
        .alias("epsg"),
        f["properties"]["zarr_url"].alias("zarr_url"),
        ring(f["geometry"]["coordinates"]).alias("footprint"),
        ring(f["properties"]["geometry_epsg"]["coordinates"]).alias("footprint_xy"),
    )
    return with_ring_boxes(cubes)


def with_ring_boxes(cubes: DataFrame) -> DataFrame:
    """Adds the boxes of the footprints in degrees and in the cube's own system."""
    from firnflow.functions.rings import ring_bounds

    out: dict[str, Any] = dict(zip(("minx", "miny", "maxx", "maxy"), ring_bounds(F.col("footprint"))))
    out.update(zip(("xmin", "ymin", "xmax", "ymax"), ring_bounds(F.col("footprint_xy"))))
    return cubes.withColumns(out)
