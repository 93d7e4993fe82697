"""Cube contents: chunks of dense arrays as long rows, and the layout of the long table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnflow.functions.scaling import missing_to_null
from firnflow.operators.series import CELL


def flatten_chunks(
    chunks: DataFrame,
    values: str,
    shape: Sequence[tuple[str, Column]],
    starts: Mapping[str, Column] | None = None,
    keys: Sequence[str] = (),
    name: str = "v",
) -> DataFrame:
    """One row per array element: the keys, one index per axis, and the value (NaN as NULL).

    ``shape`` lists the axes from the slowest to the fastest with the length each has in the chunk, ``starts`` where the
    chunk begins on an axis.  Rows multiply inside the task that holds the chunk; nothing is shuffled.
    """
    flat = chunks.select("*", F.posexplode(values).alias("_pos", "_value"))
    out, below = {}, F.lit(1).cast("long")
    for axis, length in reversed(list(shape)):
        index = F.floor(F.col("_pos") / below) % length
        begin = (starts or {}).get(axis)
        out[axis] = (index if begin is None else index + begin).cast("long")
        below = below * length
    return flat.select(
        *keys,
        *(out[axis].alias(axis) for axis, _ in shape),
        missing_to_null(F.col("_value").cast("double")).alias(name),
    )


def axis_value(axis: Column, index: Column) -> Column:
    """Coordinate at a zero-based index of an axis array."""
    return F.try_element_at(axis, (index + 1).cast("int"))


def read_observations(
    spark: SparkSession, path: str, variables: Sequence[str], cube_ids: Sequence[int] | None = None
) -> DataFrame:
    """Named variables of the long table, from the folders of the cubes asked for only; NaN comes in as NULL."""
    rows = spark.read.parquet(path)
    if cube_ids is not None:
        rows = rows.where(F.col("cube_id").isin(list(cube_ids)))
    floating = {n for n, t in rows.dtypes if t in ("double", "float")}
    wanted = [missing_to_null(F.col(n)).alias(n) if n in floating else F.col(n) for n in variables]
    return rows.select(*CELL, "mid_date", *wanted)


def write_observations(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Long table in folders by cube, inside them clustered by cell and time.

    Ranges follow the data, so a crowded cube, or a single crowded cell, becomes many files.
    """
    keys = ["cube_id", "iy", "ix", "mid_date"]
    ranged = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.partitionBy("cube_id").parquet(path)
