"""Running mean over wide, overlapping bins that start at each series' first date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnflow.functions.filters import all_of
from firnflow.functions.times import MICROS_PER_DAY, from_micros, micros
from firnflow.operators.bounded import join_salted

BINS_PER_TASK = 200_000  # made there from the spans of the series, which are small in themselves


def running_mean(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    freq_days: int = 30,
    min_points: int = 5,
) -> DataFrame:
    """``bin, time, value`` per key: bins of ``freq_days`` from the first date, each widened by half a bin on both sides.

    A bin with at least ``min_points`` valid values shows their mean at their mean time, any other NULL at the bin's start.
    The last, incomplete bin is left out.

    Bin ``i`` spans [i·f - h, (i+1)·f + h) after the first date, where f is the bin and h half of it in whole days.  All such
    limits fall on j·f - h and j·f + h, so each row belongs to one of two pieces of period j, "seam" [j·f - h, j·f + h) or
    "core" [j·f + h, (j+1)·f - h), and bin i is seam i, core i and seam i+1.  Rows are summed per piece, map side first,
    and only those sums are copied to the bins: no range join, no copies of observations.  First dates meet the observations in a
    join salted by time, so a series that holds a third of all rows is spread over many tasks.  ``rows`` is read three times, twice for
    the spans (keys and times only) and their bins, so it should be a stored table rather than the end of a long plan.
    """
    keys = list(keys)
    f, h = int(freq_days * MICROS_PER_DAY), int(freq_days / 2) * MICROS_PER_DAY
    timed = rows.select(*keys, micros(F.col(time)).alias("_t"), F.col(value).alias("_v"))
    # Said here once, the condition is the same in every branch below and their common shuffle is done once.
    timed = timed.where(all_of(F.col(k).isNotNull() for k in (*keys, "_t")))
    spans = (
        timed.groupBy(*keys)
        .agg(F.min("_t").alias("_t0"), F.max("_t").alias("_t1"))
        .withColumn("_bins", F.expr(f"(_t1 - _t0) div {f}"))
        .where("_bins > 0")
        .drop("_t1")
    )
    placed = (
        join_salted(timed.where(F.col("_v").isNotNull()), spans, keys, salt_by=["_t"])
        .withColumn("_d", F.col("_t") - F.col("_t0") + h)
        .withColumn("_j", F.expr(f"_d div {f}"))
        .withColumn("_r", F.col("_d") - F.col("_j") * f)
    )
    pieces = placed.groupBy(*keys, "_t0", "_bins", "_j", (F.col("_r") < 2 * h).alias("_seam")).agg(
        F.count("*").alias("_n"), F.sum("_v").alias("_sum"), F.sum(F.col("_r").cast("double")).alias("_rsum")
    )
    targets = F.when(F.col("_seam"), F.array(F.col("_j") - 1, F.col("_j"))).otherwise(F.array("_j"))
    # Offsets are kept relative to the start of the bin, so sums of times stay exact in doubles.
    offset = F.col("_rsum") + F.col("_n") * ((F.col("_j") - F.col("_bin")) * f - h)
    shares = (
        pieces.withColumn("_bin", F.explode(targets))
        .where((F.col("_bin") >= 0) & (F.col("_bin") < F.col("_bins")))
        .select(*keys, "_t0", "_bin", "_n", "_sum", offset.cast("double").alias("_off"))
    )
    # Spans are so few bytes that all bins would be made in one task if Spark chose the tasks by size.
    tasks = (spans.agg(F.sum("_bins")).first()[0] or 0) // BINS_PER_TASK + 1
    every_bin = spans.repartition(tasks, *keys).select(
        *keys,
        "_t0",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_bins") - 1)).alias("_bin"),
        F.lit(0).cast("long").alias("_n"),
        F.lit(0.0).alias("_sum"),
        F.lit(0.0).alias("_off"),
    )
    bins = (
        shares.unionByName(every_bin)
        .groupBy(*keys, "_t0", "_bin")
        .agg(F.sum("_n").alias("n"), F.sum("_sum").alias("_sum"), F.sum("_off").alias("_off"))
    )
    enough = F.col("n") >= min_points
    start = F.col("_t0") + F.col("_bin") * f
    at = F.when(enough, start + F.floor(F.col("_off") / F.col("n"))).otherwise(start)
    return bins.select(
        *keys,
        F.col("_bin").alias("bin"),
        from_micros(at).alias("time"),
        F.when(enough, F.col("_sum") / F.col("n")).alias("value"),
        "n",
    )
