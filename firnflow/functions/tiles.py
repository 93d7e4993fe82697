"""Names and covers of the ten-degree tiles of a latitude/longitude catalog.

Two conventions exist side by side: ``cover_names`` names tiles by their centre (multiples of ten, five degrees either
way), ``point_tile`` truncates a position toward zero.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from firnflow.functions import rings

TILE_DEGREES = 10


def tile_name(lat: Column, lon: Column) -> Column:
    """``N70W040`` for whole degrees; zero counts as north and east."""
    return F.format_string(
        "%s%02d%s%03d",
        F.when(lat >= 0, "N").otherwise("S"),
        F.abs(lat).cast("int"),
        F.when(lon >= 0, "E").otherwise("W"),
        F.abs(lon).cast("int"),
    )


def point_tile(lat: Column, lon: Column, prefix: str | None = None) -> Column:
    """Tile directory of a position, truncated toward zero; the pole and the date line fall into the last tile."""
    rows = F.least(F.floor(F.abs(lat) / 10) * 10, F.lit(80))
    cols = F.least(F.floor(F.abs(lon) / 10) * 10, F.lit(170))
    name = F.format_string(
        "%s%02d%s%03d",
        F.when(lat >= 0, "N").otherwise("S"),
        rows.cast("int"),
        F.when(lon >= 0, "E").otherwise("W"),
        cols.cast("int"),
    )
    return name if prefix is None else F.concat_ws("/", F.lit(prefix.rstrip("/")), name)


def _centres(low: Column, high: Column) -> Column:
    # A tile reaches five degrees either side of its centre and touching counts, so the range below is exact.
    first = F.ceil((low - 5) / 10).cast("int") * 10
    last = F.floor((high + 5) / 10).cast("int") * 10
    return F.sequence(first, last, F.lit(10))


def cover_tiles(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Array of ``struct(lon_c, lat_c, tile)`` of all tiles that meet a box."""
    return F.flatten(
        F.transform(
            _centres(minx, maxx),
            lambda lon: F.transform(
                _centres(miny, maxy),
                lambda lat: F.struct(lon.alias("lon_c"), lat.alias("lat_c"), tile_name(lat, lon).alias("tile")),
            ),
        )
    )


def cover_ring(ring: Column) -> Column:
    """The same array of tiles for a ring: those of its box that the ring itself meets."""
    edges = rings.ring_edges(ring)

    def meets(tile: Column) -> Column:
        lon, lat = tile["lon_c"], tile["lat_c"]
        return rings.edges_meet_box(edges, (lon - 5, lat - 5, lon + 5, lat + 5))

    return F.filter(cover_tiles(*rings.ring_bounds(ring)), meets)


def region_tiles(spark: SparkSession, roi: rings.Region) -> list[str]:
    """Names of the tiles that meet a literal region, to name the folders to read; the globe has 703 of them."""
    box = [F.lit(v) for v in roi.bounds]
    tiles = spark.range(1).select(F.explode(cover_tiles(*box)).alias("t")).select("t.*")
    lon, lat = F.col("lon_c"), F.col("lat_c")
    met = tiles.where(rings.region_meets_box(roi, [lon - 5, lat - 5, lon + 5, lat + 5]))
    return sorted(r.tile for r in met.select("tile").collect())


def wrap_longitude(lon: Column) -> Column:
    """Longitude in -180..180 (180 itself becomes -180)."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180
