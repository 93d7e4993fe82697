"""Near-dedup of documents: MinHash bands find candidates, odd sketches estimate them, whole shingle sets confirm them.

A document's set holds its distinct shingles of five words.  Its MinHash samples are used twice: bands of five samples bring
together documents that share one, and all samples folded into a bitmap of parities give an odd sketch, in which the number of
bits that differ between two documents tells how many samples differ.  Candidates that differ too much go; the others are
confirmed by counting both whole sets.

Texts with the same words are one document from the start.  In a band's bucket every document first meets the smallest one, so
a group of n near copies costs n comparisons.  Only documents that then are still in different components meet each other, those
of a bucket's largest component only the others, in blocks that carry whole texts: the most similar first, as long as their
components stay apart, and only links leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnflow.llm.common import across_blocks, components, groups_of, release, stored, whole

WORDS = 5
PERCENT = 85  # of op4; a caller without a threshold of its own takes less, see ``planned``
ROWS = 5  # samples of a band
MISSED = 4.5e-7  # chance that two documents at the threshold share no band
SKETCH = 512  # bits
DEVIATIONS = 5  # above the bits that differ at the threshold, up to which sketches are let through
BLOCK = 384  # documents of a bucket that one task compares with as many others
MEMBERS = 256  # compared with one copy of their leader
REMEMBERED = 500_000

_WORD_MIX = np.random.default_rng(20_240_518).integers(0, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # public finaliser constants of a 64-bit mix


class Plan(NamedTuple):
    """What follows from the threshold."""

    percent: int
    bands: int
    most_bits: int  # of two sketches that differ
    factors: np.ndarray
    shifts: np.ndarray
    band_mix: np.ndarray


def planned(percent: int) -> Plan:
    """Bands of ``ROWS`` samples and the bound on sketches; 25 bands and 71 bits at 85, 37 and 110 at 80."""
    alike = percent / 100
    bands = 1 if percent >= 100 else math.ceil(math.log(MISSED) / math.log1p(-(alike**ROWS)))
    n = bands * ROWS
    # Each sample that differs flips two bits; some of these meet.
    flips = 2 * n * (1 - alike)
    left = math.exp(-2 * flips / SKETCH)
    mean = SKETCH / 2 * (1 - left)
    spread = (2 * left) ** 2 * n * alike * (1 - alike) + SKETCH / 4 * (1 - left**2) - flips * left**2
    most = math.ceil(mean + DEVIATIONS * math.sqrt(max(spread, 0)))
    rng = np.random.default_rng(20_240_517)
    factors = (rng.integers(0, 1 << 32, n, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    shifts = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    return Plan(percent, bands, most, factors, shifts, rng.integers(0, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _A
    x = (x ^ (x >> np.uint64(33))) * _B
    return x ^ (x >> np.uint64(33))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 48:
            self[word] = h
        return h


_HASHES = _Hashes()


def words_of(text: str) -> list[bytes]:
    """Words between space and controls 9 to 13, A-Z in lower case; both as bytes methods define them."""
    return text.encode().lower().split()


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles; of all words where they are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(_HASHES.__getitem__, words)), np.uint64)
    n = len(h) - WORDS + 1
    if n < 1:
        return _mixed((h * _WORD_MIX[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    total = np.zeros(n, np.uint64)
    for i in range(WORDS):
        total += h[i : i + n] * _WORD_MIX[i]
    return np.unique(_mixed(total))


def samples(hashes: np.ndarray, plan: Plan) -> np.ndarray:
    """The smallest value of the set under each of the hash functions."""
    low = np.full(len(plan.factors), 0xFFFFFFFF, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 1024):
        part = short[i : i + 1024, None]
        values = part * plan.factors
        values ^= values >> np.uint32(15)
        values += plan.shifts
        values *= np.uint32(0x9E3779B1)
        np.minimum(low, values.min(0), out=low)
    return low


def bands_of(low: np.ndarray, plan: Plan) -> np.ndarray:
    rows = low.reshape(plan.bands, ROWS).astype(np.uint64)
    return _mixed((rows * plan.band_mix).sum(1) + np.arange(plan.bands, dtype=np.uint64) * _A).view(np.int64)


def odd_sketch(low: np.ndarray) -> bytes:
    """Each sample flips one bit of the bitmap; equal samples of two documents flip the same."""
    at = _mixed(low.astype(np.uint64) + (np.arange(len(low), dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH)
    odd = np.bincount(at.astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _profiles(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    for b in batches:
        same, sizes, bands, sketches = [], [], [], []
        for t in b.column("text"):
            words = words_of(t.as_py())
            s = shingles(words)
            same.append(xxhash.xxh3_128_digest(b" ".join(words)))
            sizes.append(len(s))
            low = samples(s, plan)
            bands.append(bands_of(low, plan).tobytes())
            sketches.append(odd_sketch(low))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("text_hash"), pa.array(same, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.binary()),
             pa.array(sketches, pa.binary())],
            ["doc_id", "text_hash", "same", "n_shingles", "bands", "sketch"],
        )
    _HASHES.clear()
    release()


def _opened(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """One row per band."""
    for b in batches:
        raw = b"".join(b.column("bands").to_pylist())
        at = np.repeat(np.arange(b.num_rows), plan.bands)
        yield pa.RecordBatch.from_arrays([b.column("node").take(pa.array(at)), pa.array(np.frombuffer(raw, "<i8"))], ["node", "bucket"])


def _alike(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches and sizes allow the threshold."""
    for b in batches:
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("sketch_a", "sketch_b"))
        n, m = (b.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
        good = (np.bitwise_count(x ^ y).sum(1, dtype=np.int64) <= plan.most_bits) & (100 * np.minimum(n, m) >= plan.percent * np.maximum(n, m))
        yield b.select(["a", "b"]).filter(pa.array(good))


def _confirmed(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a leader followed by its members: members whose sets meet the threshold."""
    leader, own = None, np.empty(0, np.uint64)
    for b in batches:
        a, doc = [], []
        for lead, i, first, t in zip(*(b.column(n).to_pylist() for n in ("a", "node", "lead")), b.column("text")):
            if first:
                leader, own = lead, shingles(words_of(t.as_py()))
                continue
            if lead != leader:
                raise ValueError("a member came before its leader")
            other = shingles(words_of(t.as_py()))
            both = len(np.intersect1d(own, other, assume_unique=True))
            if 100 * both >= plan.percent * (len(own) + len(other) - both):
                a.append(lead)
                doc.append(i)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(doc, pa.int64())], ["a", "b"])
    _HASHES.clear()
    release()


def confirmed(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], plan: Plan) -> DataFrame:
    """Pairs (a, b) that meet the threshold on whole sets; ``texts`` adds the text to rows with a node.  A leader's text is sent once for every ``MEMBERS`` members."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
    members = pairs.join(counts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    leaders = members.select("a", "part").distinct()
    wanted = members.select("a", "part", F.col("b").alias("node"), F.lit(False).alias("lead")).unionByName(
        leaders.select("a", "part", F.col("a").alias("node"), F.lit(True).alias("lead"))
    )
    rows = texts(wanted).repartition("a", "part").sortWithinPartitions("a", "part", F.col("lead").desc())
    return stored(rows.select("a", "node", "lead", "text").mapInArrow(lambda batches: _confirmed(batches, plan), "a long, b long"), "minhash-links")


def _apart(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Rows of a group that have partners: documents of other components that the sketches allow, the most similar first.

    A pair belongs to the first band that both share, so that it is looked at once.
    """
    for g in groups_of(batches, ["node", "component", "n_shingles", "sketch", "bands", "bucket", "_block", "_inner"]):
        doc, comp, n = g["node"], g["component"], g["n_shingles"]
        bits = np.frombuffer(b"".join(g["sketch"]), np.uint64).reshape(len(doc), -1)
        bands = np.frombuffer(b"".join(g["bands"]), "<i8").reshape(len(doc), -1)
        band = int(np.flatnonzero(bands[0] == g["bucket"][0])[0])
        good = (comp[:, None] != comp[None, :]) & (doc[:, None] < doc[None, :])
        good &= (g["_block"][:, None] == g["_block"][None, :]) == bool(g["_inner"][0])
        good &= 100 * np.minimum(n[:, None], n[None, :]) >= plan.percent * np.maximum(n[:, None], n[None, :])
        a, b = np.nonzero(good)
        found = []
        for lo in range(0, len(a), 50_000):
            i, j = a[lo : lo + 50_000], b[lo : lo + 50_000]
            differ = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
            keep = differ <= plan.most_bits
            i, j, differ = i[keep], j[keep], differ[keep]
            keep = ~(bands[i, :band] == bands[j, :band]).any(1)
            found.append((i[keep], j[keep], differ[keep]))
        if not found:
            continue
        i, j, differ = (np.concatenate(x) for x in zip(*found))
        if not len(i):
            continue
        order = np.lexsort((differ, i))
        i, j = i[order], j[order]
        partners = dict(zip(doc[np.unique(i)].tolist(), np.split(doc[j], np.flatnonzero(np.diff(i)) + 1)))
        at = np.union1d(i, j)
        yield pa.RecordBatch.from_arrays(
            [pa.array(g["_group"][at]), pa.array(doc[at].astype("<i8")), pa.array(comp[at].astype("<i8")),
             pa.array([partners[d].astype("<i8").tobytes() if d in partners else b"" for d in doc[at].tolist()], pa.binary())],
            ["_group", "node", "component", "partners"],
        )


def _joining(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Links between components of a group, confirmed on whole sets; pairs that links so far have joined are not looked at."""
    for g in groups_of(batches, ["node", "component", "partners", "text"]):
        sets = {d: shingles(words_of(t)) for d, t in zip(g["node"].tolist(), g["text"])}
        comp = dict(zip(g["node"].tolist(), g["component"].tolist()))
        parent = {c: c for c in comp.values()}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        a, b = [], []
        for d, raw in zip(g["node"].tolist(), g["partners"]):
            own = sets[d]
            for other in np.frombuffer(raw, "<i8").tolist():
                x, y = root(comp[d]), root(comp[other])
                if x == y:
                    continue
                theirs = sets[other]
                both = len(np.intersect1d(own, theirs, assume_unique=True))
                if 100 * both >= plan.percent * (len(own) + len(theirs) - both):
                    parent[max(x, y)] = min(x, y)
                    a.append(d)
                    b.append(other)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    _HASHES.clear()
    release()


def classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Links join documents whose sets share at least ``percent`` of 100 parts of their union.  A null text, or one without words, has no
    shingles and links with nothing; fewer than five words are one shingle.  Rows of one doc_id are one node; of equal rows each
    is returned.  A null doc_id links with nothing, has no component and is kept.  Other columns are ignored and may have any name.
    """
    plan = planned(percent)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole(docs["text"]).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))  # tells the texts of one doc_id apart
    shape = "doc_id long, text_hash long, same binary, n_shingles long, bands binary, sketch binary"
    profiles = stored(texts.mapInArrow(lambda batches: _profiles(batches, plan), shape), "minhash-profiles")
    usable = profiles.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Equal sequences of words are one node, for which one row of its smallest document stands.
    same = usable.groupBy("same").agg(F.min("doc_id").alias("rep")).withColumn("node", F.monotonically_increasing_id())
    same = stored(same, "minhash-copies")
    reps = usable.join(same, "same").where("doc_id = rep").dropDuplicates(["node"])
    reps = stored(reps.select("node", "doc_id", "text_hash", "n_shingles", "bands", "sketch"), "minhash-representatives")
    narrow = reps.select("node", "n_shingles", "sketch")
    places = reps.select("node", "doc_id", "text_hash")
    standing = texts.join(places.drop("node"), ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])

    def with_text(rows: DataFrame) -> DataFrame:
        return rows.join(places, "node").join(standing, ["doc_id", "text_hash"])

    rows = stored(profiles.select("doc_id", "n_shingles", "same").join(same.drop("rep"), "same", "left").drop("same"), "minhash-rows")
    # Documents whose rows hold different texts join the nodes of these.
    known = rows.where("node IS NOT NULL AND doc_id IS NOT NULL")
    several = known.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("_last")).where("a <> _last").drop("_last")
    one_document = stored(known.join(several, "doc_id").where("a <> node").select("a", F.col("node").alias("b")).distinct(), "minhash-documents")

    buckets = reps.select("node", "bands").mapInArrow(lambda batches: _opened(batches, plan), "node long, bucket long")
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    entries = stored(buckets.join(shared, "bucket"), "minhash-buckets")
    pairs = entries.where("a <> node").select("a", F.col("node").alias("b")).distinct()
    sides = pairs.join(narrow.toDF("a", "n_a", "sketch_a"), "a").join(narrow.toDF("b", "n_b", "sketch_b"), "b")
    pairs = stored(sides.mapInArrow(lambda batches: _alike(batches, plan), "a long, b long"), "minhash-candidates")
    links = confirmed(pairs, with_text, plan).unionByName(one_document)
    found = components(links, "minhash-components")

    # Buckets of three or more in which the smallest one has not connected all.
    placed = entries.where("n > 2").join(found, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node")).drop("a", "n")
    dealt = across_blocks(placed, ["bucket"], "component", "node", BLOCK).join(reps.drop("doc_id", "text_hash"), "node")
    names = ["_group", "node", "component", "n_shingles", "sketch", "bands", "bucket", "_block", "_inner"]
    dealt = dealt.select(*names).repartition("_group").sortWithinPartitions("_group")
    apart = stored(dealt.mapInArrow(lambda batches: _apart(batches, plan), "_group long, node long, component long, partners binary"), "minhash-apart")
    if not apart.isEmpty():
        both = with_text(apart).select("_group", "node", "component", "partners", "text")
        both = both.repartition("_group").sortWithinPartitions("_group", "node")
        new = stored(both.mapInArrow(lambda batches: _joining(batches, plan), "a long, b long"), "minhash-links")
        if not new.isEmpty():
            found = components(links.unionByName(new), "minhash-components")

    # From nodes to documents: a component is named by its smallest one.
    classed = same.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = classed.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_copies = classed.join(smallest, "component").select("node", "component_id")
    rows = rows.join(of_copies, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(component, "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document stays: one of each component."""
    gone = classes(docs, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")
