"""Search results as files: addresses, JSON, CSV, download manifests."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnflow.functions.urls import S3_PREFIX_PATTERN, download_route, file_name


def write_urls(found: DataFrame, path: str) -> None:
    """One address per line."""
    found.select("href").write.text(path)


def url_rows(found: DataFrame) -> DataFrame:
    """``url, filename``."""
    return found.select(F.col("href").alias("url"), file_name(F.col("href")).alias("filename"))


def write_url_csv(found: DataFrame, path: str) -> None:
    url_rows(found).write.option("header", True).csv(path)


def write_url_json(found: DataFrame, path: str) -> None:
    """One JSON object per line: the form of the list that many tasks can write and read."""
    found.select("href").write.json(path)


def json_array(found: DataFrame) -> Iterator[str]:
    """The whole list as one JSON array of addresses, in order, in parts that are passed on one by one."""
    start = "["
    for r in found.select("href").orderBy("href").toLocalIterator():
        yield f"{start}\n  {json.dumps(r.href)}"
        start = ","
    yield "[]" if start == "[" else "\n]"


def download_manifest(found: DataFrame, limit: int | None = None, s3_pattern: str = S3_PREFIX_PATTERN) -> DataFrame:
    """``href, filename, route`` for a downloader, each address routed by itself; the first ``limit`` in order if given."""
    rows = found.select("href").distinct()
    if limit is not None:
        rows = rows.orderBy("href").limit(limit)
    return rows.select(
        "href", file_name(F.col("href")).alias("filename"), download_route(F.col("href"), s3_pattern).alias("route")
    )
