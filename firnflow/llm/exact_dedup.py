"""Exact dedup by content sort.

Rows are ordered by their normalised text: a short head, the digest of the whole text, the whole text, then doc_id.  Spark
samples splitters from (head, digest, doc_id), all of bounded size, range-partitions, and sorts each range externally; equal
texts are then neighbours and are told apart by comparing whole texts.  As doc_id is part of the range key, a text that a
third of all rows share fills many ranges evenly instead of one task.  Groups that cross the border of a range are joined
afterwards from one record per border group and range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from firnflow.llm.common import BLANKS, stored, whole

HEAD = 24  # characters of the text that lead the sort key


def _runs(batches: Iterator[pa.RecordBatch], carried: bool, out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbouring texts of one sorted range; a run's rows leave with the batch in which it ends.

    Of a run only ids and one text are held, and its first row as an Arrow value; carried rows never become Python objects.
    """
    part = TaskContext.get().partitionId()
    text = None  # of the current run
    ids: list = []
    sha, first, run = "", None, -1
    at = 0  # of the current run's first row: 0 in an earlier batch, else its place in this one, from 1
    rows: list[tuple] = []
    firsts: list[int | None] = []  # for each of ``rows`` the place of the row that it carries

    def close(last: bool) -> None:
        edge = run == 0 or last
        for i, d in enumerate(ids):
            rows.append((d, first, len(ids), i == 0, sha, part, run, edge))
            firsts.append(at if i == 0 else None)

    def batch(row: pa.Array | None) -> pa.RecordBatch:
        columns = [pa.array(c, t.type) for c, t in zip(zip(*rows), out)]
        if carried:
            columns.append(row.take(pa.array(firsts, pa.int64())))
        rows.clear()
        firsts.clear()
        return pa.RecordBatch.from_arrays(columns, schema=out)

    held = pa.nulls(1, out.field("row").type) if carried else None
    for b in batches:
        docs, digests = (b.column(n).to_pylist() for n in ("_id", "_sha"))
        own = pa.concat_arrays([held, b.column("_row")]) if carried else None
        for i, value in enumerate(b.column("_norm")):
            t = value.as_py()
            if t != text or text is None:
                if run >= 0:
                    close(False)
                text, ids, sha, first, at = t, [], digests[i], docs[i], i + 1
                run += 1
            ids.append(docs[i])
        if rows:
            yield batch(own)
        if carried and b.num_rows:
            held, at = own.take(pa.array([at])), 0
    if run >= 0:
        close(True)
        yield batch(held)


def grouped(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 and, for kept rows, ``carry`` as struct ``row``.

    Texts are equal when identical after replacing each run of space and controls 9-13 by one space; null is the empty text.
    Of equal texts one row stays: the smallest doc_id, a null doc_id coming last; of rows that repeat a doc_id and a text, one.
    The empty table gives the empty table.  Other columns are ignored and may have any name.
    """
    norm = F.regexp_replace(whole(docs["text"]), BLANKS, " ")
    kept_row = [F.struct(*(docs[f"`{c}`"] for c in carry)).alias("_row")] if carry else []
    keyed = docs.select(docs["doc_id"].alias("_id"), norm.alias("_norm"), *kept_row)
    keyed = keyed.withColumn("_sha", F.sha2(F.encode("_norm", "UTF-8"), 256)).withColumn("_head", F.substring("_norm", 1, HEAD))
    # One text is shuffled: normalised, or where the row goes along, as it stands there, to be normalised again after.
    again = "text" in carry
    ranges = keyed.drop(*(["_norm"] if again else [])).repartitionByRange("_head", "_sha", F.col("_id").asc_nulls_last())
    if again:
        ranges = ranges.withColumn("_norm", F.regexp_replace(whole("_row.text"), BLANKS, " "))
    ranges = ranges.sortWithinPartitions("_head", "_sha", "_norm", F.col("_id").asc_nulls_last()).drop("_head")

    doc_type = docs.schema["doc_id"].dataType
    fields = [("doc_id", doc_type), ("keep_id", doc_type), ("group_size", T.LongType()), ("kept", T.BooleanType()),
              ("text_sha256", T.StringType()), ("part", T.IntegerType()), ("run", T.LongType()), ("edge", T.BooleanType())]
    if carry:
        fields.append(("row", keyed.schema["_row"].dataType))
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    arrow = to_arrow_schema(schema)
    carried = bool(carry)
    local = stored(ranges.mapInArrow(lambda b: _runs(b, carried, arrow), schema), "content-sort")

    # One record per border run and range, at most two a range: joined in range order on the driver.
    border = local.where("edge").groupBy("part", "run").agg(
        F.max("text_sha256").alias("sha"), F.max("group_size").alias("n"), F.max(F.when(F.col("kept"), F.col("keep_id"))).alias("first")
    )
    crossing, chain = [], []

    def settle() -> None:
        if len(chain) > 1:
            total = sum(r["n"] for r in chain)
            crossing.extend((r["part"], r["run"], chain[0]["first"], total, i == 0) for i, r in enumerate(chain))

    for r in sorted(border.collect(), key=lambda r: (r["part"], r["run"])):
        if chain and r["sha"] == chain[-1]["sha"]:
            chain.append(r)
        else:
            settle()
            chain = [r]
    settle()
    shape = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("_keep", doc_type),
                          T.StructField("_n", T.LongType()), T.StructField("_first", T.BooleanType())])
    joined = local.join(F.broadcast(docs.sparkSession.createDataFrame(crossing, shape)), ["part", "run"], "left")
    met = F.col("_n").isNotNull()
    return joined.select(
        "doc_id",
        F.when(met, F.col("_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(met, F.col("_n")).otherwise(F.col("group_size")).alias("group_size"),
        F.when(met, F.col("kept") & F.col("_first")).otherwise(F.col("kept")).alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    names = docs.columns
    rows = grouped(docs, names).where("kept")
    return rows.select(*(F.col("row").getField(n).alias(n) for n in names))
