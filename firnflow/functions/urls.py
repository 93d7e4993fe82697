"""URL columns: parts, schemes, product names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Version directory of the annual composites, and the naming pattern of a data cube and of its composite.
COMPOSITE_VERSION = "v2-updated-september2025"
CUBE_URL_PATTERN = (
    r"^(https://[^/]+\.s3\.amazonaws\.com/)datacubes/[^/]+/([^/]+)/"
    r"([A-Za-z_]+)_vel_(EPSG\d+)_G0120_(X-?\d+_Y-?\d+)\.zarr.*$"
)
COMPOSITE_URL_FORM = "$1composites/annual/{version}/$2/$3_velocity_$4_120m_$5.zarr"
DEFAULT_EPSG = "3413"
S3_PREFIX_PATTERN = r"^https://[^/]+\.s3\.amazonaws\.com"


def file_name(url: Column) -> Column:
    """Last path part."""
    return F.element_at(F.split(url, "/"), -1)


def bucket_and_key(url: Column) -> tuple[Column, Column]:
    """Bucket and object key of an S3 URL, with or without its scheme."""
    pattern = "^(?:s3://)?([^/]+)/(.*)$"
    return F.regexp_extract(url, pattern, 1), F.regexp_extract(url, pattern, 2)


def https_url(url: Column) -> Column:
    return F.replace(url, F.lit("http://"), F.lit("https://"))


def s3_url(url: Column) -> Column:
    """``http:`` form of an object address as ``s3:`` form."""
    return F.replace(F.replace(url, F.lit("http:"), F.lit("s3:")), F.lit(".s3.amazonaws.com"), F.lit(""))


def composite_url(cube_url: Column, version: str = COMPOSITE_VERSION) -> Column:
    """Address of the annual composite that goes with a data cube; empty text if the address is not that of a cube."""
    form = COMPOSITE_URL_FORM.replace("{version}", version)
    return F.when(cube_url.rlike(CUBE_URL_PATTERN), F.regexp_replace(cube_url, CUBE_URL_PATTERN, form)).otherwise(F.lit(""))


def epsg_code(proj_code: Column) -> Column:
    """Digits of ``EPSG:<digits>``; missing or empty means the default projection."""
    return F.coalesce(F.nullif(F.replace(proj_code, F.lit("EPSG:"), F.lit("")), F.lit("")), F.lit(DEFAULT_EPSG))


def download_route(url: Column, s3_pattern: str = S3_PREFIX_PATTERN) -> Column:
    """``s3`` for public objects, ``daac`` for the archive behind a login."""
    return F.when(url.rlike(s3_pattern), F.lit("s3")).otherwise(F.lit("daac"))
