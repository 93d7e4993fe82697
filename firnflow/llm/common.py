"""Shared by the operators: tables, written intermediates, text columns, connected components."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnflow.session import shared_folder

# The white space of every contract here: space and the controls 9 to 13.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes the table to the shared folder and reads it back, which cuts the lineage; survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole(text: str | Column = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def release() -> None:
    """Gives memory that was freed back to the system.

    Python workers serve one stage after the other, and what the C library keeps of one would stand beside the next one's.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # not the GNU library, which is the one that keeps it


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Columns node, component: for every node of an edge (a, b) the smallest node it is connected with.

    Each round hooks every node to its smallest neighbour, flattens the resulting trees by pointer doubling, and contracts
    the edges to those between roots; both loops take a number of rounds logarithmic in the nodes.  Minima are combined
    before the shuffle.  A node with very many edges is a skewed key of an inner or left join with a table of unique keys,
    which adaptive execution splits.  Every round is a written table in the shared folder.  No edge gives no row.
    """
    left = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), purpose)
    found = None
    while not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            left.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        roots = stored(both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("root")), purpose)
        while True:
            up = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = stored(roots.join(up, "root").select("node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), purpose)
            roots = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = roots.withColumnRenamed("root", "component")
        else:
            later = roots.select(F.col("node").alias("component"), "root")
            found = stored(found.join(later, "component", "left").select("node", F.coalesce("root", "component").alias("component")), purpose)
        ends = left.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        ends = ends.join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        left = stored(ends.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), purpose)
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found


def in_blocks(entries: DataFrame, keys: list[str], by: str, size: int) -> DataFrame:
    """Rows of keys that occur more than once, with ``_group`` and ``_block``, for comparing rows of a key in blocks.

    A key of up to ``size`` rows is one group.  A larger one is cut into blocks by a hash of ``by``; each pair of blocks is a
    group of its own, in which rows of different ``_block`` meet, and each block is a group in which its own rows meet
    (``_inner`` tells which).  So no task holds more than about twice ``size`` rows of a key.
    """
    counts = entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    rows = entries.join(counts, keys).withColumn("_blocks", F.ceil(F.col("_rows") / size).cast("int"))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(F.lit("block"), by), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.withColumn("_inner", F.col("_other") == F.col("_block"))
    group = F.xxhash64(*keys, F.least("_other", "_block"), F.greatest("_other", "_block"))
    return rows.withColumn("_group", group).drop("_rows", "_blocks", "_other")


def across_blocks(entries: DataFrame, keys: list[str], part: str, by: str, size: int) -> DataFrame:
    """As ``in_blocks``, for comparing only rows of a key that differ in ``part``: those of its largest part do not meet each other.

    Rows of the largest part meet all others, in blocks of both; the others also meet among themselves.  A key of n rows, of which r
    are outside of its largest part, so makes about n + r * n / ``size`` rows, in proportion to n while r is below ``size``.
    """
    c = F.col
    sizes = entries.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.groupBy(*keys).agg(F.max(F.struct("_n", c(part).alias("_part"))).alias("_main"), F.sum("_n").alias("_all"))
    sizes = sizes.where(c("_all") > c("_main._n")).select(
        *keys, "_main._part", F.ceil(c("_main._n") / size).cast("int").alias("_wide"), F.ceil((c("_all") - c("_main._n")) / size).cast("int").alias("_rest")
    )
    rows = entries.join(sizes, keys).withColumn("_largest", c(part) == c("_part"))
    own, others = F.when(c("_largest"), c("_wide")).otherwise(c("_rest")), F.when(c("_largest"), c("_rest")).otherwise(c("_wide"))
    met = rows.withColumn("_own", F.pmod(F.xxhash64(F.lit("block"), by), own).cast("int"))
    met = met.withColumn("_other", F.explode(F.sequence(F.lit(0), others - 1)))
    sides = [F.when(c("_largest"), c(a)).otherwise(c(b)) for a, b in (("_own", "_other"), ("_other", "_own"))]
    met = met.withColumns({"_block": c("_largest").cast("int"), "_inner": F.lit(False), "_group": F.xxhash64(F.lit("across"), *keys, *sides)})
    among = in_blocks(rows.where(~c("_largest")), keys, by, size)
    names = [*entries.columns, "_block", "_inner", "_group"]
    return met.select(*names).unionByName(among.select(*names))


def groups_of(batches, names: list[str]):
    """Numpy columns of each run of two or more rows of equal ``_group`` in sorted batches, across their borders."""
    held: dict[str, np.ndarray] | None = None
    for b in batches:
        own = {n: b.column(n).to_numpy(zero_copy_only=False) for n in ["_group", *names]}
        if held is not None:
            own = {n: np.concatenate([held[n], v]) for n, v in own.items()}
        group = own["_group"]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.array([0])
        ends = np.append(starts[1:], len(group))
        for s, e in zip(starts[:-1], ends[:-1]):
            if e - s > 1:
                yield {n: v[s:e] for n, v in own.items()}
        held = {n: v[starts[-1] :] for n, v in own.items()}
    if held is not None and len(held["_group"]) > 1:
        yield held
