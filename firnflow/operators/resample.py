"""Series on a regular calendar: one value per day, week or month, with gaps shown and optionally filled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firnflow.functions.filters import all_of
from firnflow.functions.times import PERIOD_LABELS, periods_between, shift_period

OPERATIONS = {"max": F.max, "min": F.min, "mean": F.avg, "average": F.avg}


def parse_aggregation(text: str) -> tuple[str, str]:
    """``median-m`` → operation and frequency."""
    op, _, freq = text.lower().partition("-")
    if op not in (*OPERATIONS, "median") or freq not in PERIOD_LABELS:
        raise ValueError(f"{text!r}: wanted one of {(*OPERATIONS, 'median')} and d, w or m, as in median-m")
    return op, freq


def _is_fixed_width(rows: DataFrame, column: str) -> bool:
    kind = rows.schema[column].dataType
    return isinstance(kind, (T.NumericType, T.DatetimeType, T.TimestampNTZType, T.BooleanType))


def first_per_timestamp(
    rows: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """The first row, by a unique order, of those that share a key and a time.

    A minimum rather than a ranking: each task keeps one row per group before anything is shuffled.  With one order column
    of fixed width, and values of fixed width, the groups live in a hash map; other types make Spark sort them.
    """
    if len(order) == 1 and all(_is_fixed_width(rows, c) for c in (*order, *values)):
        return rows.groupBy(*keys, time).agg(*(F.min_by(v, order[0]).alias(v) for v in values))
    first = F.min(F.struct(*order, *values))
    return rows.groupBy(*keys, time).agg(first.alias("_f")).select(*keys, time, *(F.col("_f." + v).alias(v) for v in values))


def _without_nan(rows: DataFrame, value: str) -> DataFrame:
    if dict(rows.dtypes)[value] not in ("float", "double"):
        return rows
    return rows.withColumn(value, F.when(~F.isnan(value), F.col(value)))


def _magnitude_bucket(v: Column) -> Column:
    """Whole number that never falls as ``v`` rises: 32 buckets per doubling, mirrored below zero; -100000 if missing."""
    size = F.floor(F.log2(F.greatest(F.abs(v), F.lit(2.0**-20))) * 32) + 800
    return F.when(v.isNull(), F.lit(-100000)).otherwise((F.signum(v) * size).cast("int"))


# A key with more valid values than this is not gathered in one aggregation buffer.
HOT_VALUES = 500_000


def exact_median(rows: DataFrame, keys: Sequence[str], value: str, hot_values: int = HOT_VALUES) -> DataFrame:
    """Median per key; keys with very many values go another way that never brings them together.  NaN counts as missing.

    There is at most one such key per ``hot_values`` rows, so their list is small enough to broadcast; where there is none,
    adaptive execution drops that branch before it starts.
    """
    keys = list(keys)
    rows = _without_nan(rows, value)
    sizes = rows.groupBy(*keys).agg(F.count(value).alias("_n"))
    hot = F.broadcast(sizes.where(F.col("_n") > hot_values).select(*keys))
    return _sorted_median(rows.join(hot, keys, "left_anti"), keys, value).unionByName(
        spread_median(rows.join(hot, keys, "left_semi"), keys, value)
    )


def _sorted_median(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    # One sort per partition; cheaper than merging one map of values per key and task, and able to spill.
    per_key = W.partitionBy(*keys)
    rank = F.row_number().over(per_key.orderBy(F.col(value).asc_nulls_last()))
    ranked = rows.withColumns({"_rank": rank, "_n": F.count(value).over(per_key)})
    middle = F.col("_rank").isin(F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1)
    return ranked.where(middle | ((F.col("_n") == 0) & (F.col("_rank") == 1))).groupBy(*keys).agg(F.avg(value).alias("value"))


# Each bucket that holds a middle rank is cut into so many parts of equal width, and the parts that hold one again.
PARTS, CUTS = 4096, 2


def spread_median(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median per key without bringing a key's rows together.

    Equal values are counted, counts are added per magnitude, and only the one or two magnitudes that hold the middle ranks
    are looked at again, cut by their own least and greatest value, and so once more.  A key with a third of all rows is thus
    spread over many tasks at every step, also where its values lie close to each other.
    """
    keys = list(keys)
    middle = middle_values(rows, keys, value)
    within = W.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    middle = middle.withColumn("_run", F.col("_before") + F.sum("_c").over(within))
    low = F.min(F.when(F.col("_run") >= F.col("_lo"), F.col("_v")))
    high = F.min(F.when(F.col("_run") >= F.col("_hi"), F.col("_v")))
    return middle.groupBy(*keys).agg(((low + high) / 2).alias("value"))


def middle_values(rows: DataFrame, keys: Sequence[str], value: str, cuts: int = CUTS) -> DataFrame:
    """The different values ``_v`` near the middle of each key with their number ``_c``, in buckets ``_b`` that hold a middle rank.

    ``_before`` is how many values of the key are less than those of the bucket, ``_lo`` and ``_hi`` are the middle ranks.
    """
    keys = list(keys)
    counted = _without_nan(rows, value).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    counted = counted.withColumns(
        {"_c": F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(0), "_b": _magnitude_bucket(F.col("_v")).cast("long")}
    )
    sizes = counted.groupBy(*keys, "_b").agg(F.sum("_c").alias("_m"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    per_key = W.partitionBy(*keys)
    n = F.sum("_m").over(per_key)
    ranked = sizes.withColumns({"_lo": F.floor((n + 1) / 2), "_hi": F.floor(n / 2) + 1, "_before": F.lit(0).cast("long")})
    middle = counted.join(_holding(ranked, keys, "_b"), [*keys, "_b"])
    for _ in range(cuts):
        wide = F.col("_max") > F.col("_min")
        part = F.least(F.floor((F.col("_v") - F.col("_min")) / (F.col("_max") - F.col("_min")) * PARTS), F.lit(PARTS - 1))
        cut = middle.withColumn("_p", F.when(wide, part).otherwise(0).cast("long"))
        ranks = ["_before", "_lo", "_hi"]
        sizes = cut.groupBy(*keys, "_b", *ranks, "_p").agg(F.sum("_c").alias("_m"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        held = _holding(sizes, [*keys, "_b"], "_p")
        middle = cut.select(*keys, "_v", "_c", "_b", "_p").join(held, [*keys, "_b", "_p"]).withColumn("_b", F.col("_b") * PARTS + F.col("_p")).drop("_p")
    return middle


def _holding(sizes: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Of the buckets of a key, in order, those that hold one of its middle ranks, with the number of values before them."""
    upto = F.col("_before") + F.sum("_m").over(W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, 0))
    found = sizes.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_m"))
    holds = (F.col("_before") < F.col("_hi")) & (F.col("_upto") >= F.col("_lo"))
    return found.where(holds).select(*keys, bucket, "_before", "_lo", "_hi", "_min", "_max")


def resample(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    op: str = "max",
    freq: str = "m",
    fill: bool = False,
) -> DataFrame:
    """One row per key and period from the key's first to its last: ``period`` (its closing date) and ``value``.

    Periods without a valid value carry NULL or, with ``fill``, the last value before them.  Rows are reduced to one per
    key and period first; what the window then holds per key is bounded by the calendar, not by the data.
    """
    labelled = rows.select(*keys, PERIOD_LABELS[freq](F.col(time)).alias("period"), F.col(value).alias("_value"))
    labelled = labelled.where(all_of(F.col(k).isNotNull() for k in (*keys, "period")))
    if op == "median":
        reduced = exact_median(labelled, [*keys, "period"], "_value")
    else:
        reduced = labelled.groupBy(*keys, "period").agg(OPERATIONS[op]("_value").alias("value"))
    in_order = W.partitionBy(*keys).orderBy("period")
    steps = F.coalesce(periods_between(F.col("period"), F.lead("period").over(in_order), freq), F.lit(1))
    carried = F.last("value", ignorenulls=True).over(in_order.rowsBetween(W.unboundedPreceding, 0))
    spread = reduced.withColumns({"_steps": steps, "_carried": carried}).withColumn(
        "_k", F.explode(F.sequence(F.lit(0), F.col("_steps") - 1))
    )
    shown = F.col("_carried") if fill else F.when(F.col("_k") == 0, F.col("value"))
    return spread.select(*keys, shift_period(F.col("period"), F.col("_k"), freq).alias("period"), shown.alias("value"))


def series_statistics(resampled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean, maximum and count of the valid values of a resampled series; a key without any is left out."""
    return (
        resampled.where(F.col("value").isNotNull())
        .groupBy(*keys)
        .agg(F.avg("value").alias("mean"), F.max("value").alias("max"), F.count("value").alias("n"))
    )
