"""Filter interaction audit by decision diagrams.

Every document becomes a mask of the filters that it fails; Spark counts the documents of each part and mask, which leaves at
most 32 rows a part however many documents it holds.  The counts of a part are then an ordered decision diagram: a level for
each filter, a low edge for pass and a high edge for fail, equal sub-diagrams shared, and on every node the documents below it.
For one order of the filters the path of low edges from the root is a document that passes all so far: the weight of the high
edge is what a step removes, that of the low edge what it keeps.  Other orders are reached by swapping two adjacent levels at
a time, in the sequence of plain changes, which meets every order once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnflow.llm.common import BLANKS, stored, whole

FEWEST_WORDS = 50
LEAST_DISTINCT = 65  # of 100 words
MOST_CAPITALS = 5  # of 100 code points
SYMBOLS = "[#$%&*|]"
FILTERS = "ABCDE"

Weight = tuple[int, ...]


class Diagram:
    """Ordered decision diagram whose terminals are the weights of the masks; ``order`` names the filter of each level."""

    def __init__(self, weights: dict[int, Weight], filters: int):
        self._shared: dict = {}
        self.edges: list[tuple[int, int] | None] = []  # low and high; none for terminals
        self.below: list[Weight] = []
        self.order = list(range(filters))
        width = len(next(iter(weights.values()), ()))
        row = [self._terminal(weights.get(sum(bit << f for f, bit in enumerate(bits)), (0,) * width)) for bits in _paths(filters)]
        while len(row) > 1:
            row = [self._node(low, high) for low, high in zip(row[::2], row[1::2])]
        self.root = row[0]

    def _terminal(self, weight: Weight) -> int:
        return self._made(weight, None, weight)

    def _node(self, low: int, high: int) -> int:
        return self._made((low, high, "node"), (low, high), tuple(a + b for a, b in zip(self.below[low], self.below[high])))

    def _made(self, key: tuple, edges: tuple[int, int] | None, weight: Weight) -> int:
        if key not in self._shared:
            self._shared[key] = len(self.edges)
            self.edges.append(edges)
            self.below.append(weight)
        return self._shared[key]

    def swap(self, level: int) -> None:
        """Exchanges the filters of ``level`` and the next one."""
        done: dict[int, int] = {}

        def moved(node: int, depth: int) -> int:
            if node not in done:
                low, high = self.edges[node]
                if depth:
                    done[node] = self._node(moved(low, depth - 1), moved(high, depth - 1))
                else:
                    (pass_pass, pass_fail), (fail_pass, fail_fail) = self.edges[low], self.edges[high]
                    done[node] = self._node(self._node(pass_pass, fail_pass), self._node(pass_fail, fail_fail))
            return done[node]

        self.root = moved(self.root, level)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """Filter, weight kept and weight removed of each step of the present order: the path of those that pass all."""
        node = self.root
        for f in self.order:
            low, high = self.edges[node]
            yield f, self.below[low], self.below[high]
            node = low


def _paths(filters: int) -> Iterator[tuple[int, ...]]:
    """Outcomes of all filters in the order of the diagram's terminals: the first filter changes slowest."""
    for i in range(1 << filters):
        yield tuple(i >> (filters - 1 - f) & 1 for f in range(filters))


def plain_changes(n: int) -> Iterator[int]:
    """Positions to exchange with the next one, so that all n! orders are met once each, the starting one first."""
    if n < 2:
        return
    down, up = range(n - 2, -1, -1), range(n - 1)
    yield from down
    leftmost = True
    for at in plain_changes(n - 1):
        yield at + leftmost
        yield from up if leftmost else down
        leftmost = not leftmost


def audited(weights: dict[int, Weight], names: Sequence[str]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique fails, the further weights removed, removed over all orders) of a part."""
    k = len(names)
    diagram = Diagram(weights, k)
    swaps, found = plain_changes(k), []
    while True:
        order = "".join(names[f] for f in diagram.order)
        found.extend((order, step, f, kept, removed) for step, (f, kept, removed) in enumerate(diagram.steps(), 1))
        if (at := next(swaps, None)) is None:
            break
        diagram.swap(at)
    fails, alone, over_all = [0] * k, [0] * k, [0] * k
    for _, step, f, _, removed in found:
        over_all[f] += removed[0]
        if step == 1:
            fails[f] = removed[0]
        if step == k:  # after all others: what fails this one only
            alone[f] = removed[0]
    return [(order, step, kept[0], removed[0], fails[f] - removed[0], alone[f], *removed[1:], over_all[f]) for order, step, f, kept, removed in found]


def audit(masks: DataFrame, names: Sequence[str], part: str, weights: Sequence[str]) -> DataFrame:
    """Audit of any filters: ``masks`` has a string column ``part``, an int ``mask`` with bit i set where filter i fails, and
    further integer columns ``weights`` summed per step as ``<weight>_lost``.  Each part and mask is one row of counts before
    a part meets in one task: 2 to the power of the filters at most.  The rows of a part are the orders times the filters.
    """
    counts = masks.groupBy(F.col(part).alias("part"), "mask").agg(
        F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(w), F.lit(0)).cast("long").alias(w) for w in weights)
    )
    columns = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", *(f"{w}_lost" for w in weights), "shapley"]

    def of_part(group: pd.DataFrame) -> pd.DataFrame:
        rows = audited({int(m): tuple(map(int, w)) for m, *w in group[["mask", "n", *weights]].itertuples(index=False)}, names)
        made = pd.DataFrame(rows, columns=columns)
        made.insert(0, "part", group["part"].iloc[0])
        return made

    shape = ", ".join(f"{c} {'string' if c == 'filter_order' else 'int' if c == 'step' else 'long'}" for c in columns)
    return counts.groupBy("part").applyInPandas(of_part, f"part string, {shape}")


def text_failures(text: Column) -> Column:
    """Mask of the filters A to D that look at the text alone."""
    words = F.split(F.btrim(text, F.lit("\x20\t\n\x0b\x0c\r")), BLANKS)
    n = F.when(F.length(F.regexp_replace(text, BLANKS, "")) > 0, F.size(words)).otherwise(0).cast("long")
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    failed = [
        n < FEWEST_WORDS,
        100 * F.size(F.array_distinct(words)).cast("long") < LEAST_DISTINCT * n,
        100 * capitals.cast("long") > MOST_CAPITALS * F.length(text).cast("long"),
        text.rlike(SYMBOLS),
    ]
    return sum((F.shiftleft(f.cast("int"), i) for i, f in enumerate(failed)), F.lit(0))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic for every row of ``docs``.

    A null text is empty, a null source the empty part.  Filter E fails where a smaller doc_id has the same text; rows that
    repeat the smallest one pass, and a null doc_id is compared with nothing and passes.  A document without a label is neither
    good nor toxic; of several labels of a document one that says so is enough.  Other columns are ignored and may have any name.
    """
    texts = docs.select(docs["doc_id"], F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"), whole(docs["text"]).alias("_text"))
    key = F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("key")
    rows = stored(texts.select("doc_id", "part", key, text_failures(F.col("_text")).alias("mask")), "filter-audit")
    # A text's smallest doc_id is met by (text, doc_id), which no text's copies crowd.
    firsts = rows.where("doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = rows.join(firsts, ["key", "doc_id"], "left")
    repeated = F.col("doc_id").isNotNull() & F.col("first").isNull()
    marked = marked.select("doc_id", "part", (F.col("mask") + F.shiftleft(repeated.cast("int"), 4)).alias("mask"))
    known = labels.where(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].alias("doc_id"))
    known = known.agg(F.max((labels["quality"] == 1).cast("int")).alias("good"), F.max((labels["toxic"] == 1).cast("int")).alias("toxic"))
    return marked.join(known, "doc_id", "left").select("part", "mask", "good", "toxic")


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over ``docs`` in all 120 orders: see ``failures`` and ``audit``.  The empty table gives no part."""
    return audit(failures(docs, labels), FILTERS, "part", ["good", "toxic"])
