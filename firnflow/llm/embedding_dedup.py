"""Near-dedup of embeddings by iterative quantisation.

Rotations learned on a bounded sample turn vectors into balanced binary codes.  The codes are cut into substrings, each with a
Hamming table of its own: vectors of one label that agree in a substring are candidates, so vectors that differ in fewer bits
than there are tables always meet.  The length of a substring follows the logarithm of the largest label, so that tables stay
sparse, and the number of tables follows from the wanted recall at the threshold.  Candidates are compared by the original
vectors in double precision.  Equal vectors are one vector with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnflow.llm.common import components, groups_of, in_blocks, stored

THRESHOLD = 0.98
SAMPLE_ROWS = 20_000  # of the fit at most
SAMPLE_BYTES = 64 << 20
RECALL = 0.998  # wanted of pairs at the threshold, were bits independent
ROUNDS = 40
NEAR = 0.05  # quantile of the sample's distances from its mean for which the tables are planned
MOST_TABLES = 128
BLOCK = 1024


class Codes:
    """Rotations and thresholds that give each vector a bit string, read as ``tables`` substrings of ``bits`` bits."""

    def __init__(self, sample: np.ndarray, tables: int, bits: int):
        self.tables, self.bits = tables, bits
        n, d = sample.shape
        self.mean = sample.mean(0)
        centred = sample - self.mean
        _, _, axes = np.linalg.svd(centred, full_matrices=False) if n <= 4 * d else (0, 0, np.linalg.eigh(centred.T @ centred)[1].T[::-1])
        axes = axes[: max(1, min(d, len(axes)))]
        width = len(axes)
        flat = centred @ axes.T
        parts = []
        for seed in range(math.ceil(tables * bits / width)):
            turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))[0]
            for _ in range(ROUNDS):
                u, _, v = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
                turn = (u @ v).T
            parts.append(axes.T @ turn)
        self.turn = np.concatenate(parts, axis=1)[:, : tables * bits]
        self.middle = np.median(centred @ self.turn, axis=0)  # half of the sample on either side

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        """Rows of one number per table."""
        d = len(self.mean)
        if vectors.shape[1] != d:  # another length than the sample's: still a fixed code
            fitted = np.zeros((len(vectors), d))
            fitted[:, : min(d, vectors.shape[1])] = vectors[:, :d]
            vectors = fitted
        on = ((vectors - self.mean) @ self.turn >= self.middle).reshape(len(vectors), self.tables, self.bits)
        return on @ (1 << np.arange(self.bits, dtype=np.int64))


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors as bytes of doubles; those with null, non-finite or only zero components are left out."""
    for b in batches:
        keep, units = [], []
        for i, v in enumerate(b.column("embedding").to_pylist()):
            if v and None not in v:
                x = np.array(v, dtype=np.float64)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top  # no overflow or underflow in the squares
                    keep.append(i)
                    units.append((x / np.sqrt(x @ x) + 0.0).tobytes())
        own = b.select(["vec_id", "label"]).take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*own.columns, pa.array(units, pa.binary())], ["vec_id", "label", "unit"])


def _plan(size: int, threshold: float, sample: np.ndarray) -> tuple[int, int]:
    """Tables and bits per substring for the largest label.

    Codes are taken about the sample's mean, from where two vectors at the threshold are seen under a wider angle than from the
    origin, the more so the nearer they are to the mean; the angle counts as seen by a near one.  Where vectors share so much of
    their direction that more tables would be needed than there may be, substrings get shorter, and buckets larger.
    """
    half = math.sqrt((1 - threshold) / 2)
    near = float(np.quantile(np.linalg.norm(sample - sample.mean(0), axis=1), NEAR))
    bit = 1 - 2 * math.asin(half / max(near, 1.2 * half)) / math.pi if half else 1 - 1e-9
    bits = min(40, max(8, math.ceil(math.log2(max(2, size)))))
    while bits > 1 and math.log(1 - RECALL) / math.log1p(-(bit**bits)) > MOST_TABLES:
        bits -= 1
    return max(2, math.ceil(math.log(1 - RECALL) / math.log1p(-(bit**bits)))), bits


def _linked(threshold: float, tables: int):
    """Per group of candidates: weights of the vectors linked to each, and the smallest one of its group it is connected with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, roots = [], [], []
        for g in groups_of(batches, ["vec_id", "weight", "unit", "codes", "at", "_block", "_inner"]):
            vec = g["vec_id"]
            x = np.frombuffer(b"".join(g["unit"]), np.float64).reshape(len(vec), -1)
            link = x @ x.T >= threshold
            np.fill_diagonal(link, False)
            link &= (g["_block"][:, None] == g["_block"][None, :]) == bool(g["_inner"][0])
            if not link.any():
                continue
            # A pair counts in the first table in which it meets.
            a, b = np.nonzero(link)
            codes, at = np.frombuffer(b"".join(g["codes"]), "<i8").reshape(len(vec), tables), int(g["at"][0])
            if at:
                for lo in range(0, len(a), 200_000):
                    i, j = a[lo : lo + 200_000], b[lo : lo + 200_000]
                    met = (codes[i, :at] == codes[j, :at]).any(1)
                    link[i[met], j[met]] = False
            own = link @ g["weight"]
            root = np.arange(len(vec))
            order = np.argsort(vec, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(vec))
            low = rank.copy()
            while True:
                new = np.minimum(low, np.where(link, low[None, :], len(vec)).min(1))
                new = new[order[new]]
                if (new == low).all():
                    break
                low = new
            root = vec[order[low]]
            some = own > 0
            ids.append(vec[some])
            counts.append(own[some])
            roots.append(root[some])
            if sum(map(len, ids)) > 20_000:
                yield _rows(ids, counts, roots)
                ids, counts, roots = [], [], []
        if ids:
            yield _rows(ids, counts, roots)

    return run


def _rows(ids: list, counts: list, roots: list) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(c).astype("<i8")) for c in (ids, counts, roots)]
    return pa.RecordBatch.from_arrays(columns, ["vec_id", "n", "root"])


def deduplicated(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row: links within a label at a cosine of at least ``threshold``.

    A row without label, or whose vector is null, empty, zero or holds null or non-finite components, links with nothing, as do
    vectors of different lengths.  Rows of one vec_id are one vector each; their ids are one node of the components.  An empty
    table gives an empty table; other columns are ignored and may have any name.
    """
    plain = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("string").alias("label"), vectors["embedding"])
    usable = plain.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.col("vec_id").isNotNull())
    units = stored(usable.mapInArrow(_usable, "vec_id long, label string, unit binary"), "itq-units")
    # Equal vectors of a label: one representative with their number.
    copies = units.select("vec_id", "label", F.sha2("unit", 256).alias("same"), F.octet_length("unit").alias("bytes"))
    same = copies.groupBy("label", "same").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.max("bytes").alias("bytes"))
    same = stored(same, "itq-copies")
    sizes = same.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"), F.lit(1)).first()
    largest = sizes["n"] or 0
    width = (same.agg(F.max("bytes")).first()[0] or 8) // 8
    reps = units.withColumn("same", F.sha2("unit", 256)).join(same.drop("bytes"), ["label", "same"]).where("vec_id = rep")
    reps = stored(reps.dropDuplicates(["label", "same"]).select("vec_id", "label", "unit", "weight"), "itq-representatives")

    limit = max(2, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)))
    drawn = [np.frombuffer(r["unit"], np.float64) for r in reps.orderBy(F.xxhash64("vec_id"), "vec_id").limit(limit).select("unit").collect()]
    lengths = [len(v) for v in drawn]
    usual = max(set(lengths), key=lengths.count) if lengths else 1
    sample = np.array([v for v in drawn if len(v) == usual]) if drawn else np.eye(2)
    tables, bits = _plan(largest, threshold, sample)
    shared = vectors.sparkSession.sparkContext.broadcast(Codes(sample, tables, bits))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        for b in batches:
            rows = b.column("unit").to_pylist()
            got: list[bytes] = [b""] * len(rows)
            for size in {len(r) for r in rows}:
                at = [i for i, r in enumerate(rows) if len(r) == size]
                made = codes(np.frombuffer(b"".join(rows[i] for i in at), np.float64).reshape(len(at), -1)).astype("<i8")
                for i, c in zip(at, made):
                    got[i] = c.tobytes()
            values = [np.frombuffer(c, "<i8").tolist() for c in got]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary()), pa.array(values, pa.list_(pa.int64()))],
                                             [*b.schema.names, "codes", "values"])

    entries = reps.mapInArrow(coded, "vec_id long, label string, unit binary, weight long, codes binary, values array<long>")
    narrow = entries.select("vec_id", "label", F.octet_length("unit").alias("size"), F.posexplode("values").alias("at", "value"))
    paired = in_blocks(narrow, ["label", "size", "at", "value"], "vec_id", block)
    whole = paired.join(entries.select("vec_id", "unit", "codes", "weight"), "vec_id")
    names = ["_group", "vec_id", "weight", "unit", "codes", "at", "_block", "_inner"]
    dealt = whole.select(*names).repartition("_group").sortWithinPartitions("_group")
    links = stored(dealt.mapInArrow(_linked(threshold, tables), "vec_id long, n long, root long"), "itq-links")

    counts = links.groupBy("vec_id").agg(F.sum("n").alias("n")).withColumnRenamed("vec_id", "rep")
    nodes = components(links.select(F.col("vec_id").alias("a"), F.col("root").alias("b")), "itq-components")
    # Copies join their representative, whose component takes in the smallest id of all.
    classes = same.join(counts, "rep", "left").join(nodes.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("label").alias("_label"), "same", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    of_rows = copies.join(classes, (copies["label"] == classes["_label"]) & (copies["same"] == classes["same"])).select(
        F.col("vec_id").alias("_id"), "n_links", "component_id"
    )
    of_rows = of_rows.groupBy("_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    ids = vectors.select("vec_id").withColumn("_id", F.col("vec_id").cast("long"))
    return ids.join(of_rows, "_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", F.col("_id")).alias("component_id"),
        F.coalesce(F.coalesce("component_id", F.col("_id")) == F.col("_id"), F.lit(True)).alias("kept"),
    )
