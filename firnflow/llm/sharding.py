"""Sharding by histogram sort: shards are ranges of a sort key that hold near equal bytes.

The key is 64 bits: 32 of a hash of the text, 32 of a hash of doc_id, so equal texts are neighbours and a text that a third
of all rows share still has fine boundaries.  Bytes and rows below candidate boundaries are counted exactly, at first for
4,096 equally spaced probes; then only bins that hold a boundary not yet known closely enough, or too large for one task, are
divided by 4,096 again.  When all splitters meet the tolerance, rows are exchanged once, by ranges much smaller than a shard
whose row counts are known, so that places within a shard need no task that sees the whole shard.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firnflow.llm.common import stored, whole

SHARDS = 40
STEP = 12  # bits of the key that each round looks at
RANGES = 24  # of the exchange, for each shard
TOLERANCE = 0.001  # of a shard's bytes
ROW_BYTES = 16

_TOP = 1 << 64


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.xxhash64(whole("text"))
    high = F.shiftleft(F.shiftrightunsigned(text, 32), 32)
    return docs.withColumn("__size", F.octet_length(whole("text")).cast("long") + ROW_BYTES).withColumn(
        "__key", high.bitwiseOR(F.shiftrightunsigned(F.xxhash64("doc_id"), 32))
    )


class Bins:
    """Exact counts by key interval, refined where asked: sorted starts, bytes and rows of each interval."""

    def __init__(self, keys: DataFrame):
        self.keys = keys
        self.bins: list[tuple[int, int, int, int]] = []  # start, shift, bytes, rows

    def count(self, shift: int, inside: list[int] | None) -> list[tuple[int, int, int, int]]:
        rows = self.keys
        if inside is not None:
            above = min(64, shift + STEP)
            # The bins to be divided are fewer than twice the ranges, whatever the data.
            wanted = [s >> above for s in inside]
            signed = [w - _TOP if w >= _TOP >> 1 else w for w in wanted]
            rows = rows.where((F.shiftrightunsigned("__key", above) if above < 64 else F.lit(0).cast("long")).isin(signed))
        counted = rows.groupBy(F.shiftrightunsigned("__key", shift).alias("bin") if shift else F.col("__key").alias("bin")).agg(
            F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("n")
        )
        return [((r["bin"] % _TOP) << shift, shift, r["bytes"], r["n"]) for r in counted.collect()]

    def refine(self, shards: int, ranges: int, tolerance: float) -> list[int]:
        """Divides bins until the splitters between shards are close enough; gives their keys."""
        shift = 64 - STEP
        self.bins = sorted(self.count(shift, None))
        total = sum(b[2] for b in self.bins)
        rows = sum(b[3] for b in self.bins)
        close = max(1.0, tolerance * total / shards)
        while True:
            starts, below = [], 0
            for b in self.bins:
                starts.append(below)
                below += b[2]
            divide, splitters = set(), []
            for j in range(1, shards):
                goal = j * total / shards
                i = max(0, bisect_right(starts, goal) - 1)
                if not self.bins:
                    splitters.append(_TOP)
                    continue
                start, own, size, _ = self.bins[i]
                nearer_end = starts[i] + size - goal < goal - starts[i]
                splitters.append(start + (1 << own) if nearer_end else start)
                if min(goal - starts[i], starts[i] + size - goal) > close and own:
                    divide.add(i)
            heavy = max(total, 1) / (shards * ranges), max(rows, 1) / (shards * ranges)
            divide |= {i for i, b in enumerate(self.bins) if b[1] and b[3] > 1 and (b[2] > 2 * heavy[0] or b[3] > 2 * heavy[1])}
            if not divide:
                return splitters
            by_shift: dict[int, list[int]] = {}
            for i in divide:
                by_shift.setdefault(self.bins[i][1], []).append(self.bins[i][0])
            kept = [b for i, b in enumerate(self.bins) if i not in divide]
            for own, at in by_shift.items():
                lower = max(0, own - STEP)
                kept += self._within(lower, own, at)
            self.bins = sorted(kept)

    def _within(self, lower: int, own: int, at: list[int]) -> list[tuple[int, int, int, int]]:
        if own - lower < STEP:  # the last few bits
            prefix = F.shiftrightunsigned("__key", own)
            signed = [s >> own for s in at]
            rows = self.keys.where(prefix.isin(signed))
            counted = rows.groupBy(F.col("__key").alias("bin")).agg(F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("n"))
            return [(r["bin"] % _TOP, 0, r["bytes"], r["n"]) for r in counted.collect()]
        return self.count(lower, at)


def sharded(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with size (UTF-8 bytes of the text plus 16), shard, slot (gapless from 0 in each shard, in key order).

    A null text has no bytes, a null doc_id hashes like a value of its own, repeated rows get slots of their own, the empty
    table stays empty, other columns pass through but for ones of these three names.  Shards are filled to within the tolerance of equal bytes, or to the nearest whole row.
    """
    keys = stored(_keyed(docs).select("__key", "__size"), "histogram-sort")
    bins = Bins(keys)
    splitters = bins.refine(shards, ranges, tolerance)

    # Consecutive bins form ranges that end at splitters at the latest; counts before each range are known.
    heavy = max(1, sum(b[2] for b in bins.bins)) / (shards * ranges)
    pieces, shard, slot, filled, number = [], 0, 0, 0.0, 0
    for start, own, size, n in bins.bins:
        here = bisect_right(splitters, start)
        if here != shard or filled and filled + size > heavy:
            number += 1
            slot = 0 if here != shard else slot
            shard, filled, base = here, 0.0, slot
        elif not filled:
            base = slot
        signed = [v - _TOP if v >= _TOP >> 1 else v for v in (start, start + (1 << own) - 1)]
        pieces.append((start >> (64 - STEP), *signed, number, shard, base))
        filled += size
        slot += n

    # Some thousand rows, set by the parameters and not by the data; an interval lies in one bin of the first round.
    shape = "__bin long, __low long, __high long, __range int, __shard int, __base long"
    plan = docs.sparkSession.createDataFrame(pieces, shape)
    rows = _keyed(docs).withColumn("__bin", F.shiftrightunsigned("__key", 64 - STEP))
    placed = rows.join(F.broadcast(plan), ["__bin"]).where(F.col("__key").between(F.col("__low"), F.col("__high")))
    order = Window.partitionBy("__range").orderBy(F.col("__key").bitwiseXOR(F.lit(-(1 << 63))), F.col("doc_id").asc_nulls_last())
    placed = placed.withColumn("__slot", F.col("__base") + F.row_number().over(order) - 1)
    kept = [F.col(f"`{n}`") for n in docs.columns if n not in ("size", "shard", "slot")]
    return placed.select(*kept, F.col("__size").alias("size"), F.col("__shard").alias("shard"), F.col("__slot").alias("slot"))
