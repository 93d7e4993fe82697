"""Granule search: one region or many against one catalog.

A granule row holds its footprint box as ``minx, miny, maxx, maxy`` (so Parquet statistics can skip row groups), optionally
a ``footprint`` ring, its properties as flat columns, and its files as an ``assets`` map, as JSON text or as ``href``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnflow.functions import rings
from firnflow.functions.filters import PropertyFilter, granule_predicate
from firnflow.functions.tiles import point_tile
from firnflow.operators.bounded import BROADCAST_ROWS, grid_join, join_bounded, listed_rows

BOX = ("minx", "miny", "maxx", "maxy")
# Rings of at most this many vertices are listed in cells with their boxes when all of them are too many to be broadcast.
LISTED_VERTICES = 64
ASSETS_TYPE = "map<string,struct<href:string,roles:array<string>>>"


def box_columns(names: Sequence[str] = BOX) -> list[Column]:
    return [F.col(n) for n in names]


def region_predicate(granules: DataFrame, roi: rings.Region) -> Column:
    """Granules whose footprint meets the region: by their ring where there is one, else by their box."""
    box = box_columns()
    if "footprint" not in granules.columns:
        return rings.region_meets_box(roi, box)
    coarse = rings.boxes_overlap(box, [F.lit(v) for v in roi.bounds])
    return coarse & rings.region_meets_ring(roi, F.col("footprint"))


def data_assets(items: DataFrame, suffix: str = ".nc", first_only: bool = False) -> DataFrame:
    """One ``href`` per asset that has the role ``data`` and the suffix; items without one are dropped."""
    wanted = F.filter(
        F.map_values("assets"), lambda a: F.array_contains(a["roles"], "data") & F.endswith(a["href"], F.lit(suffix))
    )
    if first_only:
        return items.withColumn("href", F.try_element_at(wanted, F.lit(1))["href"]).where("href IS NOT NULL")
    return items.withColumn("_asset", F.explode(wanted)).withColumn("href", F.col("_asset.href")).drop("_asset")


def parse_assets(items: DataFrame, column: str = "assets") -> DataFrame:
    """JSON text of the assets as a map."""
    return items.withColumn(column, F.from_json(column, ASSETS_TYPE))


def fixed_path_href(assets_json: Column, key: str = "data") -> Column:
    """``href`` of the asset with a known key, straight from JSON text."""
    return F.get_json_object(assets_json, f"$.{key}.href")


def with_hrefs(granules: DataFrame, asset_type: str) -> DataFrame:
    """Rows with ``href``: one per data asset of the suffix, or those whose address ends with it."""
    if "assets" not in granules.columns:
        return granules.where(F.endswith("href", F.lit(asset_type)))
    if granules.schema["assets"].dataType.typeName() == "string":
        granules = parse_assets(granules)
    return data_assets(granules, asset_type)


def match(
    granules: DataFrame,
    bbox: Sequence[float] | None = None,
    polygon: Sequence | None = None,
    geojson: Mapping[str, Any] | None = None,
    percent_valid_pixels: float = 1,
    mission: str | None = None,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    min_interval: float | None = None,
    max_interval: float | None = None,
    filters: Mapping[str, PropertyFilter | None] | None = None,
    collection: str | None = None,
    tile_index: DataFrame | None = None,
    time_filter: bool = True,
) -> DataFrame:
    """Catalog rows that meet the region and pass every condition; no row when no region is given.

    With ``tile_index`` (see there) whole tiles that cannot meet the region are not read.
    """
    roi = rings.region(bbox, polygon, geojson)
    if roi is None:
        return granules.limit(0)
    rows = granules if tile_index is None else prune(granules, tile_index, roi)
    rows = rows.where(
        granule_predicate(
            percent_valid_pixels, mission, start, end, min_interval, max_interval, filters, collection, time_filter
        )
    )
    return rows.where(region_predicate(granules, roi))


def search(granules: DataFrame, asset_type: str = ".nc", ordered: bool = False, **conditions: Any) -> DataFrame:
    """Distinct file addresses (``href``) of the matching granules; ``conditions`` as in ``match``."""
    found = with_hrefs(match(granules, **conditions), asset_type).select("href").distinct()
    return found.orderBy("href") if ordered else found


def stream_hrefs(found: DataFrame):
    """Iterate over a search result partition by partition, without holding it in the driver."""
    for row in found.select("href").toLocalIterator(prefetchPartitions=True):
        yield row.href


def search_many(
    granules: DataFrame,
    rois: DataFrame,
    base_degrees: float = 1.0,
    max_degrees: float = 512.0,
    rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Every region of a table against the catalog: ``(roi_id, <granule columns>)``, each pair once.

    ``rois`` holds ``roi_id``, which is unique, and a box ``roi_minx, …``, and a ``roi_ring`` where regions are polygons.  Cells
    list ids and boxes.  Rings and other columns join the pairs of boxes by ``roi_id``, broadcast, while all of them have at most
    ``rows`` vertices.  Beyond that the cells list them too, as pairs are too many to be shuffled; only the pairs of
    rings with more than ``LISTED_VERTICES`` are.  No box is wider than the largest level of the default.
    """
    names = ["roi_" + n for n in BOX]
    box = [F.col(n) for n in names]
    polygons = "roi_ring" in rois.columns
    plain = not polygons and set(rois.columns) == {"roi_id", *names}
    if polygons:
        # Edges are built once per region, not once per pair.
        rois = rois.withColumns({"roi_edges": rings.ring_edges(F.col("roi_ring")), "roi_ends": rings.ring_ends(F.col("roi_ring"))})
    size = F.coalesce(F.size("roi_ring"), F.lit(0)) if polygons else F.lit(1)
    listed = F.sum(listed_rows(box, base_degrees, max_degrees)).alias("listed")
    facts = rois.agg(listed, F.sum(size).alias("vertices"), F.max(size).alias("most")).first()
    few = (facts.listed or 0) <= rows
    if not few and not granules.isStreaming:
        # No cells of sizes that no granule has.
        width = granules.agg(F.max(F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")))).first()[0]
        max_degrees = min(max_degrees, max(2 * width, base_degrees)) if width is not None and width == width else max_degrees

    def paired(regions: DataFrame) -> DataFrame:
        return grid_join(granules, regions, box_columns(), box, base_degrees, max_degrees, rows, salt_by=["granule_id"], fits=few)

    def meeting(pairs: DataFrame) -> DataFrame:
        if not polygons:
            return pairs
        ring = F.col("roi_ring")
        if "footprint" in granules.columns:
            pairs = pairs.where(rings.rings_meet(F.col("footprint"), ring))
        else:
            meets = rings.ends_show_meeting(F.col("roi_ends"), box_columns()) | rings.edges_meet_box(F.col("roi_edges"), box_columns())
            pairs = pairs.where(meets)
        return pairs.drop("roi_edges", "roi_ends")

    def by_id(regions: DataFrame, fits: bool) -> DataFrame:
        return join_bounded(paired(regions.select("roi_id", *names)), regions.drop(*names), ["roi_id"], salt_by=["granule_id"], measured=fits)

    if plain:
        return paired(rois)
    if (facts.vertices or 0) <= rows:
        return meeting(by_id(rois, True))
    small = meeting(paired(rois.where(size <= LISTED_VERTICES)))
    if facts.most <= LISTED_VERTICES:
        return small
    return small.unionByName(meeting(by_id(rois.where(size > LISTED_VERTICES), False)))


# ---- pruning by tile ---------------------------------------------------------------------------------------------


def with_tile(granules: DataFrame) -> DataFrame:
    """Adds the tile of the footprint centre, the key a catalog is partitioned by."""
    cx, cy = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
    return granules.withColumn("tile", point_tile(cy, cx))


def tile_index(granules: DataFrame) -> DataFrame:
    """Extent of the footprints in each tile: one row per tile, however many granules.

    Written next to the catalog it lets a search choose its tiles without knowing how they were drawn.
    """
    return granules.groupBy("tile").agg(
        F.min("minx").alias("t_minx"),
        F.min("miny").alias("t_miny"),
        F.max("maxx").alias("t_maxx"),
        F.max("maxy").alias("t_maxy"),
        F.count("*").alias("granules"),
    )


def prune(granules: DataFrame, index: DataFrame, roi: rings.Region) -> DataFrame:
    """Granules of the tiles whose extent meets the region.

    There are at most some thousand tiles, so the index is always small enough to broadcast; on a catalog partitioned by
    ``tile`` the join turns into dynamic partition pruning and the other tiles' files are not opened.
    """
    box = [F.col("t_" + n) for n in BOX]
    tiles = index.where(rings.region_meets_box(roi, box)).select("tile")
    return granules.join(F.broadcast(tiles), "tile", "left_semi")


# ---- counts ------------------------------------------------------------------------------------------------------


def match_count(found: DataFrame) -> DataFrame:
    return found.agg(F.count("*").alias("matches"))


def count_by_tile(granules: DataFrame) -> DataFrame:
    return granules.groupBy("tile").agg(F.count("*").alias("matches"))


def coverage(granules: DataFrame, by: Sequence[str] = (), **conditions: Any) -> DataFrame:
    """Files per year over a region, and per other columns if named; ``conditions`` as in ``match``."""
    found = match(granules, **conditions).withColumn("year", F.year("datetime"))
    return found.groupBy("year", *by).agg(F.count("*").alias("files"))


def coverage_rollup(granules: DataFrame, **conditions: Any) -> DataFrame:
    """Files per year and platform with the totals per year and over all."""
    found = match(granules, **conditions).withColumn("year", F.year("datetime"))
    return found.rollup("year", "platform").agg(F.count("*").alias("files"))
