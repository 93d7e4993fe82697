"""What is left to see when many intervals are drawn over one another.

Each interval, of whole days, is cut into blocks of days.  Of the parts of a key's block that cover the same days the one on top is
kept, a minimum that is taken before anything is shuffled, so a key with very many intervals leaves no more rows than a block has
pairs of days.  The parts of a block meet in one task, cut there into the few nodes of a binary tree of days that make them up.  In
one pass by day, the last node of each level is the only one of it that can lie above a day, so the top of a piece between two ends
is the best of one node per level: no join, and neither nodes nor pieces are shuffled.  Neighbouring pieces of one interval are put
together again, first within blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEVELS = 9  # of a block's tree: 512 days
FIRST_DAY = "1700-01-01"
_DAYS = 1 << 18
_BLOCK = 1 << LEVELS
ROWS_PER_TASK = 200_000  # intervals, each of which makes some ten rows there


def _day(date: Column) -> Column:
    return F.date_diff(date.cast("date"), F.lit(FIRST_DAY).cast("date"))


def _marks(first: Column, after: Column, top: Column) -> Column:
    """``day, kind, top`` of the nodes that make up the days from first up to, but not including, after, with their level as kind, and
    of the two ends, which come behind the nodes of their day."""
    mark = lambda day, kind, top: F.struct(day.cast("int").alias("_day"), F.lit(kind).alias("_kind"), top.alias("_top"))
    found = []
    for level in range(LEVELS + 1):
        size = 1 << level
        low, high = F.ceil(first / size).cast("int"), F.floor(after / size).cast("int")
        for node, odd in ((low, low), (high - 1, high)):
            found.append(F.when((low < high) & (odd % 2 == 1), mark(node * size, level, top)))
    ends = [mark(day, LEVELS + 1, F.when(F.lit(False), top)) for day in (first, after)]
    return F.array_compact(F.array(*found, *ends))


def _together(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pieces ``_day, _after, _top`` of which those that touch and are equal in ``_top`` are one."""
    c, by_day = F.col, W.partitionBy(*keys).orderBy("_day")
    before, behind = (f(F.struct("_day", "_after", "_top")).over(by_day) for f in (F.lag, F.lead))
    fresh = F.coalesce((before["_after"] != c("_day")) | (before["_top"] != c("_top")), F.lit(True))
    last = F.coalesce((behind["_day"] != c("_after")) | (behind["_top"] != c("_top")), F.lit(True))
    edges = pieces.withColumns({"_fresh": fresh, "_last": last}).where("_fresh OR _last")
    until = F.when(c("_last"), c("_after")).otherwise(F.lead("_after").over(by_day))
    return edges.withColumn("_after", until).where("_fresh").drop("_fresh", "_last")


def visible_segments(
    rows: DataFrame, keys: Sequence[str], start: str, stop: str, order: Sequence[str], columns: Sequence[str] = ()
) -> DataFrame:
    """``keys, first, after`` and the ``order`` and other columns of the interval that is seen from ``first`` up to ``after``.

    ``start`` and ``stop`` are dates, the last day not included; an interval of no length, or with a missing end, is not drawn.  The
    least by ``order`` lies on top, so rows in draw order, the longest separation first, have the order's columns descending.
    Intervals equal in ``order`` and ``columns`` are one; ``order`` has to tell others apart.  Segments of a key do not overlap, and
    days without an interval have none.  Dates are those of the 717 years from 1700 on; others raise.
    """
    c, keys = F.col, list(keys)
    top = F.struct(*order, *(n for n in columns if n not in order))
    days = rows.select(*keys, _day(c(start)).alias("_a"), _day(c(stop)).alias("_b"), top.alias("_top")).where("_a < _b")
    outside = (c("_a") < 0) | (c("_b") > _DAYS)
    days = days.withColumn("_a", F.when(outside, F.raise_error(F.lit(f"an interval outside {_DAYS} days from {FIRST_DAY}")).cast("int")).otherwise(c("_a")))

    parts = days.withColumn("_block", F.explode(F.sequence(F.expr(f"_a div {_BLOCK}"), F.expr(f"(_b - 1) div {_BLOCK}"))))
    start_of = c("_block") * _BLOCK
    cut = parts.select(*keys, "_block", F.greatest(c("_a"), start_of).alias("_a"), F.least(c("_b"), start_of + _BLOCK).alias("_b"), "_top")
    best = cut.groupBy(*keys, "_block", "_a", "_b").agg(F.min("_top").alias("_top"))
    # As many tasks as the marks need: they are far more than what is shuffled, by whose size Spark would choose.
    tasks = days.count() // ROWS_PER_TASK + 1
    met = best.repartition(tasks, *keys, "_block").select(*keys, "_block", F.inline(_marks(c("_a"), c("_b"), c("_top"))))

    block = [*keys, "_block"]
    passed = W.partitionBy(*block).orderBy("_day", "_kind", F.desc("_top")).rowsBetween(W.unboundedPreceding, 0)
    names = [f"_{n}" for n in range(LEVELS + 1)]
    nodes = {name: F.last(F.when(c("_kind") == n, F.struct((c("_day") + (1 << n)).alias("until"), "_top")), True).over(passed) for n, name in enumerate(names)}
    above = F.least(*(F.when(c(name)["until"] > c("_day"), c(name)["_top"]) for name in names))
    ends = met.withColumns(nodes).where(c("_kind") > LEVELS).select(*block, "_day", above.alias("_top"))
    pieces = ends.withColumn("_after", F.lead("_day").over(W.partitionBy(*block).orderBy("_day"))).where("_after > _day AND _top IS NOT NULL")
    # At most one row per key and day, and far fewer where intervals are long.
    merged = _together(_together(pieces, block).drop("_block"), keys)
    as_date = lambda n: F.date_add(F.lit(FIRST_DAY).cast("date"), c(n))
    return merged.select(*keys, as_date("_day").alias("first"), as_date("_after").alias("after"), "_top.*")
