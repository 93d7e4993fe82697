"""As-of join: for each probe the nearest, last or next value of its own axis, where axes are rows of a table.

A key's axis is cut into parts of equal width by arithmetic on its ends, about ``PER_PART`` values each if they are spread evenly.
A probe's part follows from its value, so both sides meet by an equi-join key, without comparing a probe with every axis value.
Within a part, rows are put in order once upwards and once downwards, and each probe takes the last axis value met.  What lies
beyond a part is known from one summary row per part, so parts never look at each other's rows.  Probes are also spread over
``SALTS`` shares of their part by a hash of their own columns, each share with its own copy of that part's axis values: a key, or
a single place, that holds a third of all probes is many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firnflow.operators.bounded import SALTS, plain_columns

PER_PART = 256
MAX_PARTS = 1 << 20

DIRECTIONS = ("nearest", "backward", "forward")


def _part(value: Column) -> Column:
    """Number of the part a value belongs to; never falls as the value rises, and the outer parts reach on without end."""
    steps = F.floor((F.greatest(F.least(value, F.col("_hi")), F.col("_lo")) - F.col("_lo")) / F.col("_width"))
    return F.when(F.col("_width") > 0, F.least(steps, F.col("_parts") - 1)).otherwise(0).cast("long")


def nearest_on_axes(
    probes: DataFrame,
    axes: DataFrame,
    keys: Sequence[str],
    value: str,
    coordinate: str,
    carry: Sequence[str] = (),
    direction: str = "nearest",
    tolerance: float | None = None,
    per_part: int = PER_PART,
    salts: int = SALTS,
) -> DataFrame:
    """Every probe with ``coordinate`` and ``carry`` of the axis row it belongs to; NULL where there is none.

    ``axes`` holds ``keys``, the numeric ``coordinate`` and what to carry along, in any order; NULL and NaN coordinates are no
    part of an axis, and of rows that repeat a coordinate the one with the smallest ``carry`` counts.  ``backward`` takes the
    largest coordinate not above the probe's ``value``, ``forward`` the smallest not below it, ``nearest`` the closer of these,
    on a tie the larger.  ``tolerance`` bounds the distance.  Rows of probes that repeat come out as often as they went in; a
    NULL or NaN value, or a key without axis, gets NULL; an infinite one lies beyond the axis' end.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction {direction!r}: wanted one of {DIRECTIONS}")
    if clash := {coordinate, *carry} & set(probes.columns):
        raise ValueError(f"probes already have {', '.join(sorted(clash))}")
    keys = list(keys)
    c = F.col
    own = axes.select(*keys, c(coordinate).cast("double").alias("_at"), F.struct(*carry, F.lit(0).alias("_")).alias("_row"))
    own = own.where(c("_at").isNotNull() & ~F.isnan("_at"))
    for k in keys:
        own = own.where(c(k).isNotNull())
    spans = own.groupBy(*keys).agg(F.min("_at").alias("_lo"), F.max("_at").alias("_hi"), F.count("*").alias("_n"))
    parts = F.least(F.ceil(c("_n") / per_part), F.lit(MAX_PARTS)).cast("long")
    spans = spans.withColumn("_parts", parts).withColumn("_width", (c("_hi") - c("_lo")) / c("_parts")).drop("_n")

    axis = own.join(spans, keys).withColumn("_part", _part(c("_at"))).select(*keys, "_part", "_at", "_row")
    # One row per part, also of empty ones: the last axis row before it and the first one after it.
    ends = axis.groupBy(*keys, "_part").agg(F.min(F.struct("_at", "_row")).alias("_first"), F.max("_at").alias("_last_at"))
    lasts = axis.groupBy(*keys, "_part", "_at").agg(F.min("_row").alias("_row"))
    lasts = ends.join(lasts.withColumnRenamed("_at", "_last_at"), [*keys, "_part", "_last_at"])
    lasts = lasts.select(*keys, "_part", "_first", F.struct(c("_last_at").alias("_at"), "_row").alias("_last"))
    every = spans.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), c("_parts") - 1)).alias("_part"))
    by_part = W.partitionBy(*keys).orderBy("_part")
    fences = every.join(lasts, [*keys, "_part"], "left").select(
        *keys,
        "_part",
        F.last("_last", ignorenulls=True).over(by_part.rowsBetween(W.unboundedPreceding, -1)).alias("_below"),
        F.last("_first", ignorenulls=True).over(W.partitionBy(*keys).orderBy(c("_part").desc()).rowsBetween(W.unboundedPreceding, -1)).alias("_above"),
    )
    outer = fences.select(*keys, "_part", F.explode(F.array("_below", "_above")).alias("_edge")).where("_edge IS NOT NULL")
    known = axis.unionByName(outer.select(*keys, "_part", "_edge._at", "_edge._row"))
    known = known.groupBy(*keys, "_part", "_at").agg(F.min("_row").alias("_row"))

    names = probes.columns
    at = c(value).cast("double")
    salt = F.pmod(F.xxhash64(*plain_columns(probes)), F.lit(salts)).cast("int")
    asked = probes.select(F.struct(*names).alias("_probe"), *keys, F.when(~F.isnan(at), at).alias("_at"), salt.alias("_salt"))
    # Few keys have an axis at all, so their spans are a table of unique keys; a crowded key is split by adaptive execution.
    asked = asked.join(spans, keys, "left").withColumn("_part", F.when(c("_at").isNotNull(), _part(c("_at"))))
    hopeless = c("_part").isNull() | c("_parts").isNull()
    nothing = F.lit(None).cast(known.schema["_row"].dataType)
    asked = asked.withColumn("_part", F.when(~hopeless, c("_part"))).select(*keys, "_part", "_salt", "_at", "_probe")

    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    values = known.select(*keys, "_part", copies, "_at", "_row").withColumn("_probe", F.lit(None).cast(asked.schema["_probe"].dataType))
    both = values.unionByName(asked.where("_part IS NOT NULL").withColumn("_row", nothing))
    found = F.when(c("_probe").isNull(), F.struct("_at", "_row"))
    share = W.partitionBy(*keys, "_part", "_salt")
    is_probe = c("_probe").isNotNull()
    upwards = share.orderBy("_at", is_probe).rowsBetween(W.unboundedPreceding, 0)
    downwards = share.orderBy(c("_at").desc(), is_probe).rowsBetween(W.unboundedPreceding, 0)
    met = both.select(
        "*", F.last(found, ignorenulls=True).over(upwards).alias("_before"), F.last(found, ignorenulls=True).over(downwards).alias("_after")
    ).where(is_probe)
    before, after = c("_before"), c("_after")
    closer = F.when(after.isNull() | (c("_at") - before["_at"] < after["_at"] - c("_at")), before).otherwise(after)
    taken = {"backward": before, "forward": after, "nearest": closer}[direction]
    out = met.select("_probe", "_at", taken.alias("_taken"))
    if tolerance is not None:
        out = out.withColumn("_taken", F.when(F.abs(c("_at") - c("_taken._at")) <= tolerance, c("_taken")))
    rest = asked.where("_part IS NULL").select("_probe", "_at", F.lit(None).cast(out.schema["_taken"].dataType).alias("_taken"))
    return out.unionByName(rest).select(
        *(c("_probe").getField(n).alias(n) for n in names),
        c("_taken._at").alias(coordinate),
        *(c("_taken._row").getField(n).alias(n) for n in carry),
    )


def snap_on_axes(located: DataFrame, axes: DataFrame, px: str = "px", py: str = "py") -> DataFrame:
    """Located points on the nearest cell of grids with irregular axes: adds ``ix, x, iy, y``.

    ``axes`` holds ``cube_id, axis`` (``x`` or ``y``), ``i`` and ``coordinate``, one row per grid line of every cube.
    """
    out = located
    for name, value in (("x", px), ("y", py)):
        lines = axes.where(F.col("axis") == name).select("cube_id", F.col("i").alias("i" + name), F.col("coordinate").alias(name))
        out = nearest_on_axes(out, lines, ["cube_id"], value, name, ["i" + name])
    return out
