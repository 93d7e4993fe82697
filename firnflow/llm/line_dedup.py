"""Line dedup: two Bloom filters, of keys seen once and of keys seen twice, leave only suspected repeats to be shuffled.

Each task turns its line keys into 128-bit digests and tells the bits of those it met in one document and of those it met in
more.  Bits are merged by segments of the filter; where a bit was set before by another task, it is set in the second filter
too, so every key of two documents has all its bits there.  Lines found in the second filter go on, by digest, to an exact
count of documents and the choice of the one that keeps them.  Keys are dealt to slices by their digest, each with filters of
bounded size, so that the filters grow in number and not in size with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnflow.llm.common import stored, whole

SHORTEST = 40  # code points of a key
DOCUMENTS = 5  # from so many on, lines go
BITS_PER_KEY = 16
FILTER_BITS = 1 << 30  # of one slice at most: 128 MB
BROADCAST_KEYS = 400_000  # repeated keys sent to all tasks at most, 40 bytes each; beyond, they are joined
SEGMENT = 1 << 16

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WHITE = " \t\n\x0b\x0c\r"


def key_of(line: str) -> str:
    return line.strip(_WHITE).translate(_LOWER)


def digest(key: str) -> bytes:
    return xxhash.xxh3_128_digest(key.encode())


def keys_of(text: str, shortest: int) -> set[bytes]:
    return {digest(k) for line in text.split("\n") if len(line) >= shortest and len(k := key_of(line)) >= shortest}


def _digests(shortest: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = [], []
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                own = keys_of(t.as_py(), shortest)
                keys += own
                ids += [d] * len(own)
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            first = halves[:, 0].view("<u8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, b.schema.field("doc_id").type), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                 pa.array((first % np.uint64(slices)).astype("<i4"))],
                ["doc_id", "h1", "h2", "slice"],
            )

    return run


def _bits(h1: np.ndarray, h2: np.ndarray, bits: int) -> list[np.ndarray]:
    size = np.uint64(bits)
    return [(h1.view("<u8") >> np.uint64(7)) % size, h2.view("<u8") % size]


def _parts(bits: int):
    """Bits of each segment for keys met once and twice within the task, as sorted 16-bit places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column("h1").to_numpy(zero_copy_only=False), b.column("h2").to_numpy(zero_copy_only=False)) for b in batches]
        if not got:
            return
        h1, h2 = (np.concatenate(x) for x in zip(*got))
        pairs, counts = np.unique(np.rec.fromarrays([h1, h2]), return_counts=True)
        segments, places, levels = [], [], []
        for level, wanted in ((1, counts > 0), (2, counts > 1)):
            a = pairs[wanted]
            at = np.unique(np.concatenate(_bits(np.ascontiguousarray(a.f0), np.ascontiguousarray(a.f1), bits)))
            cuts = np.flatnonzero(np.diff(at // SEGMENT)) + 1
            for piece in np.split(at, cuts):
                if len(piece):
                    segments.append(int(piece[0]) // SEGMENT)
                    places.append((piece % SEGMENT).astype("<u2").tobytes())
                    levels.append(level)
        yield pa.RecordBatch.from_arrays(
            [pa.array(segments, pa.int32()), pa.array(levels, pa.int32()), pa.array(places, pa.binary())], ["segment", "level", "places"]
        )

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The second filter of the segments in this partition: bits set twice within a task, or once in each of two tasks."""
    once: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for b in batches:
        for s, level, p in zip(*(b.column(i).to_pylist() for i in range(3))):
            if s not in once:
                once[s], twice[s] = np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)
            at = np.frombuffer(p, "<u2")
            if level == 2:
                twice[s][at] = True
            else:
                twice[s][at[once[s][at]]] = True
                once[s][at] = True
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(twice), pa.int32()), pa.array([np.packbits(v, bitorder="little").tobytes() for v in twice.values()], pa.binary())],
        ["segment", "twice"],
    )


def repeated(docs: DataFrame, shortest: int = SHORTEST, documents: int = DOCUMENTS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """h1, h2, keep_id: digests of the keys found in at least ``documents`` different doc_ids, and the largest of these.

    Digests have 128 bits, so that different keys do not meet.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", whole(docs["text"]).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # An upper bound of the number of keys: no key is shorter than that.
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = max(SEGMENT, int(chars / shortest * BITS_PER_KEY))
    slices = -(-bits // filter_bits)
    bits = -(-min(bits, filter_bits) // SEGMENT) * SEGMENT
    keys = stored(texts.mapInArrow(_digests(shortest, slices), f"doc_id {kind}, h1 long, h2 long, slice int"), "line-keys")

    suspects = []
    for s in range(slices):
        own = keys.where(F.col("slice") == s) if slices > 1 else keys
        parts = own.select("h1", "h2").mapInArrow(_parts(bits), "segment int, level int, places binary")
        merged = parts.repartition("segment").mapInArrow(_merged, "segment int, twice binary")
        seen = np.zeros(bits // 8, np.uint8)
        for r in merged.toLocalIterator():  # one slice of the filter, of bounded size
            at = r["segment"] * (SEGMENT // 8)
            seen[at : at + SEGMENT // 8] = np.frombuffer(r["twice"], np.uint8)
        shared = spark.sparkContext.broadcast(seen)

        def again(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                h1, h2 = (b.column(n).to_numpy(zero_copy_only=False) for n in ("h1", "h2"))
                hit = np.ones(len(h1), bool)
                for at in _bits(h1, h2, bits):
                    hit &= (shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                yield b.filter(pa.array(hit))

        suspects.append(own.select("doc_id", "h1", "h2").mapInArrow(again, f"doc_id {kind}, h1 long, h2 long"))
    rows = reduce(DataFrame.unionByName, suspects)
    exact = rows.groupBy("h1", "h2").agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("keep_id"))
    return stored(exact.where(F.col("n") >= documents).select("h1", "h2", "keep_id"), "line-repeats")


def _joined(b: pa.RecordBatch, drops: Iterator, shortest: int) -> pa.RecordBatch:
    """doc_id, line counts and kept lines; ``drops`` gives, for each row, the test whether a digest goes."""
    lines, dropped, texts = [], [], []
    for t, drop in zip(b.column("text"), drops):
        own = t.as_py().split("\n")
        kept = own
        if drop is not None:
            kept = [x for x in own if not (len(x) >= shortest and len(k := key_of(x)) >= shortest and drop(digest(k)))]
        lines.append(len(own))
        dropped.append(len(own) - len(kept))
        texts.append("\n".join(kept))
    return pa.RecordBatch.from_arrays(
        [b.column("doc_id"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())],
        ["doc_id", "n_lines", "n_dropped", "text"],
    )


def without_repeats(docs: DataFrame, shortest: int = SHORTEST, documents: int = DOCUMENTS, filter_bits: int = FILTER_BITS,
                    broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text without repeated lines, one row per row.

    A null or empty text has one empty line, which stays.  Rows that repeat a doc_id count as one document; a null doc_id is
    no document, and as none can be larger it loses lines that repeat.  Other columns are ignored and may have any name.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_lines long, n_dropped long, text string"
    texts = docs.select("doc_id", whole(docs["text"]).alias("text"))
    found = repeated(docs, shortest, documents, filter_bits)
    if found.count() <= broadcast_keys:
        table = {r["h1"].to_bytes(8, "little", signed=True) + r["h2"].to_bytes(8, "little", signed=True): r["keep_id"] for r in found.toLocalIterator()}
        shared = spark.sparkContext.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keep = shared.value
            for b in batches:
                ids = b.column("doc_id").to_pylist()
                yield _joined(b, ((lambda h, d=d: h in keep and keep[h] != d) for d in ids), shortest)

        return texts.mapInArrow(run, shape)

    # Too many to send to all: the digests that each document loses are gathered by document, its own lines at most.
    keys = texts.mapInArrow(_digests(shortest, 1), f"doc_id {kind}, h1 long, h2 long, slice int").drop("slice")
    lost = keys.join(found, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    lost = lost.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set(F.struct("h1", "h2")).alias("lost"))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = []
            for x in b.column("lost").to_pylist():
                gone = {r["h1"].to_bytes(8, "little", signed=True) + r["h2"].to_bytes(8, "little", signed=True) for r in x or ()}
                own.append(gone.__contains__ if gone else None)
            yield _joined(b, iter(own), shortest)

    both = texts.join(lost, texts["doc_id"].eqNullSafe(lost["_id"]), "left").select("doc_id", "text", "lost")
    return both.mapInArrow(drop, shape)
