"""Joins whose broadcast side is measured first, and the grid join built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnflow.functions.filters import all_of
from firnflow.functions.rings import boxes_overlap

# A side is broadcast only while it has at most this many rows: some tens of megabytes per executor.
BROADCAST_ROWS = 200_000
# Copies of the smaller side, and shares of each key of the larger one, when a join has to shuffle.
SALTS = 16

_SALT = "_salt"


def is_bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True if the table has at most ``rows`` rows; every task counts its own, so no row leaves its task."""
    return df.count() <= rows


def plain_columns(df: DataFrame) -> list[str]:
    """Columns whose values can be hashed, which together spread the rows of any key."""
    return [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def settled(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds columns whose values are computed here and once.

    The optimizer copies the expression behind a column into every filter, join key and projection above it; chains of
    projections grow beyond what the JVM compiles that way.  Behind a generator of one row it cannot.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*(v.alias(k) for k, v in columns.items())))))


def join_bounded(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    *,
    salt_by: Sequence[str],
    measured: DataFrame | bool | None = None,
) -> DataFrame:
    """Equi-join that broadcasts ``small`` when it is measured to be small and shuffles otherwise.

    In the shuffle, each key of ``big`` is spread over ``salts`` partitions by a hash of its ``salt_by`` columns and
    ``small`` is repeated that often, so a key that holds a third of all rows is no single task.  The hash depends on the
    row alone, so a task run again after the loss of an executor sends every row to the same place.

    ``measured`` is a table known to have no fewer rows than ``small`` but cheaper to count, or the outcome of a count.
    """
    fits = measured if isinstance(measured, bool) else is_bounded(small if measured is None else measured, rows)
    if fits:
        return big.join(F.broadcast(small), list(on), how)
    return join_salted(big, small, on, salt_by, how, salts, hint="merge")


def join_salted(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
    hint: str | None = None,
) -> DataFrame:
    """The shuffle branch of ``join_bounded``, for sides that would be costly to measure beforehand.

    Without ``hint`` adaptive execution may still broadcast ``small`` once its measured size allows that.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no salted form of a {how} join")
    copies = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    big = big.withColumn(_SALT, F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
    small = small.withColumn(_SALT, F.explode(copies))
    return big.join(small.hint(hint) if hint else small, [*on, _SALT], how).drop(_SALT)


# Most rows of the small side that stand in one array.
LISTED = 1024
# Where both sides are shuffled: rows of the large side in a block, of the small side in an array (eights, as files pack them), and shares of a key.
BLOCK, REPEATED, SHARES = 16, 128, 4


def join_listed(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    *,
    salt_by: Sequence[str],
    measured: DataFrame | bool | None = None,
    shared: Sequence[str] = (),
) -> DataFrame:
    """Inner ``join_bounded`` for keys that many rows of both sides share.

    Rows of ``small`` stand in arrays, some for each key, and a row of ``big`` meets arrays, which are unfolded in compiled code: a
    pair costs a step in an array instead of a look-up.  Every column of ``small`` is carried, so it should have those needed only.
    ``shared`` names columns that are the same for most rows of a key: they stand beside the arrays, once for each.

    Where it has to shuffle, rows of ``big`` stand in blocks too, and all rows of a block go through one array before the next one: what is
    written then repeats short sequences, which files hold in a fraction of the room.
    """
    fits = measured if isinstance(measured, bool) else is_bounded(small if measured is None else measured, rows)
    key = [*on, *shared]
    own = [c for c in small.columns if c not in key]
    # Places of a crowded key are numbered in shares, so it is no single task.
    share = small.withColumn(_SALT, F.pmod(F.xxhash64(*key, *own), F.lit(salts if fits else SHARES)))
    place = F.row_number().over(Window.partitionBy(*key, _SALT).orderBy(F.xxhash64(*own))) - 1
    blocks = share.withColumn("_block", F.floor(place / (LISTED if fits else REPEATED))).groupBy(*key, _SALT, "_block")
    lists = blocks.agg(F.collect_list(F.struct(*own)).alias("_listed")).drop(_SALT, "_block")
    if len(own) == 1:  # values alone are quicker to step through than rows of one
        lists = lists.withColumn("_listed", F.col("_listed").getField(own[0]))
    if fits:
        joined = join_bounded(big, lists, on, salts=salts, salt_by=salt_by, measured=True)
    else:
        joined = _join_blocks(big, lists, on, salt_by, salts)
    unfolded = F.explode("_listed").alias(own[0]) if len(own) == 1 else F.inline("_listed")
    return joined.select(*big.columns, *shared, unfolded)


def _join_blocks(big: DataFrame, lists: DataFrame, on: Sequence[str], salt_by: Sequence[str], salts: int) -> DataFrame:
    """Rows of ``big`` with the arrays of their key as ``join_salted`` pairs them, a block of rows with one array after the other."""
    own = [c for c in big.columns if c not in on]
    keyed = big.where(all_of(F.col(c).isNotNull() for c in on))
    salted = keyed.withColumn(_SALT, F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
    # Any order will do: the numbers don't leave the task.
    place = F.row_number().over(Window.partitionBy(*on, _SALT).orderBy(F.lit(0))) - 1
    blocks = salted.withColumn("_block", F.floor(place / BLOCK)).groupBy(*on, _SALT, "_block")
    rows = blocks.agg(F.collect_list(F.struct(*own)).alias("_rows")).drop("_block")
    copies = lists.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    joined = rows.join(copies.hint("merge"), [*on, _SALT])
    return joined.select(*(c for c in joined.columns if c not in (_SALT, "_rows")), F.inline("_rows"))


_KEY = "_grid_key"


def _key(level: Column, cx: Column, cy: Column) -> Column:
    """Level and cell in one number, which hashes faster than three: 6 bits of level and 28 of each index."""
    half = 1 << 27
    packed = level.cast("long") * (1 << 56) + (cx.cast("long") + half) * (1 << 28)
    return packed + (cy.cast("long") + half)


def _cell(value: Column, size: Column) -> Column:
    return F.floor(value / size).cast("int")


def _levels(base: float, max_extent: float) -> int:
    n = 0
    while base * 2**n < max_extent:
        n += 1
    return n


def _spans(box: Sequence[Column], base: float, max_extent: float) -> list:
    """First and last cell of a small-side box per axis, for each level."""
    x0, y0, x1, y1 = box
    reach = 1 if max_extent > 0 else 0
    sides = [F.lit(base * 2.0**k) for k in range(_levels(base, max_extent) + 1)]
    return [((_cell(x0, s) - reach, _cell(x1, s)), (_cell(y0, s) - reach, _cell(y1, s))) for s in sides]


def listed_rows(box: Sequence[Column], base: float, max_extent: float = 0.0) -> Column:
    """In how many cells ``grid_join`` lists a row of the small side, reckoned from its box."""
    total = F.lit(1 if max_extent > 0 else 0).cast("long")
    for (x_first, x_last), (y_first, y_last) in _spans(box, base, max_extent):
        total = total + (x_last - x_first + 1).cast("long") * (y_last - y_first + 1)
    return total


def grid_join(
    big: DataFrame,
    small: DataFrame,
    big_box: Sequence[Column],
    small_box: Sequence[Column],
    base: float,
    max_extent: float = 0.0,
    rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    *,
    salt_by: Sequence[str],
    fits: bool | None = None,
    how: str = "inner",
) -> DataFrame:
    """Pairs of rows whose boxes share a point; every pair comes out once.

    The large side is never multiplied: each of its rows lies in one cell of one level, the level being the first power
    of two (times ``base``) that is not smaller than the row's box.  The small side is listed in all cells, per level, from
    which a box can reach it.  Rows larger than ``max_extent`` share one extra level that every small row is listed in.
    With ``max_extent`` 0 the large side is points.  Column names of the two sides must differ.  ``fits`` tells, where it is
    known, whether the listed small side may be broadcast.  With ``how`` as ``left`` every row of the large side comes out, and the
    pairs of a cell are not yet tested: the caller does so where it reduces them.
    """
    top = _levels(base, max_extent)
    bx0, by0, bx1, by1 = big_box
    if max_extent > 0:
        extent = F.greatest(bx1 - bx0, by1 - by0)
        # The small margins keep rounding from choosing a cell that is a hair too small.
        level = F.when(extent <= base * (1 - 1e-9), 0).otherwise(F.greatest(F.ceil(F.log2(extent / base) + 1e-8), F.lit(1)).cast("int"))
        level = F.least(level, F.lit(top + 1))
    else:
        level = F.lit(0)  # the folded constants below then leave only the two divisions
    size = F.lit(float(base)) * F.pow(F.lit(2.0), level)
    whole = level > top
    cx, cy = (F.when(whole, 0).otherwise(_cell(v, size)) for v in (bx0, by0))
    keyed = big.withColumn(_KEY, _key(level, cx, cy))

    spans = _spans(small_box, base, max_extent)

    def cells(k: int) -> Column:
        (x_first, x_last), (y_first, y_last) = spans[k]
        return F.flatten(
            F.transform(
                F.sequence(x_first, x_last),
                lambda cx: F.transform(
                    F.sequence(y_first, y_last),
                    lambda cy: _key(F.lit(k), cx, cy),
                ),
            )
        )

    covers = [cells(k) for k in range(top + 1)]
    if max_extent > 0:
        covers.append(F.array(_key(F.lit(top + 1), F.lit(0), F.lit(0))))
    listed = small.withColumn(_KEY, F.explode(F.concat(*covers)))

    if fits is None:
        fits = (small.agg(F.sum(listed_rows(small_box, base, max_extent))).first()[0] or 0) <= rows
    joined = join_bounded(keyed, listed, [_KEY], how, rows, salts, salt_by=salt_by, measured=fits)
    return (joined if how == "left" else joined.where(boxes_overlap(big_box, small_box))).drop(_KEY)
