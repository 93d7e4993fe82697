"""Phrase collocations: frequent phrases counted level by level with double-array tries, and scored by their weakest cut.

Texts are cut into words once and written as arrays of word numbers with a small dictionary for each array, so later passes do
not see strings.  A word's code is a 64-bit hash of its language and itself, so phrases of different languages never meet; a
collision of two codes is looked for and leads to another seed.

A level's candidates are in a double-array trie that every task holds, its states advanced for all text positions at once with
numpy, one word at a time; positions whose state accepts are counted with ``bincount`` and the counts of all shards summed.  The
same pass meets what follows each accepted phrase, and lets go what a small filter says does not end in another candidate.
These extensions, summed over shards, are the next candidates: both a phrase's first and its last words must be frequent.  A trie holds a bounded number of candidates; more
candidates make more tries, dealt by a hash of the phrase, and a pass for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firnflow.llm.common import release, stored, whole
from firnflow.session import shared_folder

LEAST = 100  # occurrences of a candidate
LONGEST = 5  # words
BEST = 2000  # phrases of a language
CANDIDATES = 250_000  # of one trie, which then takes some 20 MB
LOOKED = 200_000  # places of the double array that are tried at once for a state's children
ROW_WORDS = 1_000_000  # of one array of word numbers, if no text is longer
REMEMBERED = 250_000  # different words a task holds before it passes on their counts
MOST_BITS = 1 << 27  # of the filter of a level's candidates; 16 bits for each up to there, and fewer beyond
SALTS = 32  # parts of a language that are ranked before the whole

# What ends a piece becomes a full stop, a tab a space, A-Z lower-case; so a full stop is never part of a word.
_LETTERS = bytes(0x2E if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_STOP = b"."
_MIX = np.uint64(0x9E3779B97F4A7C15)  # public constant of multiplicative hashing


class _Codes(dict):
    """Number in the task of each word of a language; ``known`` of the task holds language, word and code of each number."""

    def __init__(self, lang: str, known: list, seed: int):
        super().__init__({_STOP: 0})
        self.lang, self.known, self.seed = lang, known, seed

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.known)
        self.known.append((self.lang, word, xxhash.xxh3_64_intdigest(self.lang.encode() + b"\n" + word, self.seed)))
        return number


def _encoded(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Rows of arrays (``words`` null) and rows of counted words (``numbers`` null)."""
    shape = pa.schema([("numbers", pa.binary()), ("codes", pa.binary()), ("lang", pa.string()), ("word", pa.string()), ("code", pa.int64()),
                       ("n", pa.int64()), ("kind", pa.string())])
    known: list = [("", _STOP, 0)]
    codes: dict[str, _Codes] = {}
    held: list[np.ndarray] = []
    size = 0
    counts = np.zeros(1, np.int64)

    def arrays() -> pa.RecordBatch:
        nonlocal counts, size
        numbers = np.concatenate(held)
        counts = np.bincount(numbers, minlength=len(known)) + np.pad(counts, (0, len(known) - len(counts)))
        met = np.unique(np.append(numbers, 0))  # 0, the end of a piece, stays 0
        own = np.searchsorted(met, numbers).astype("<i4")
        values = np.array([known[i][2] for i in met.tolist()], "<u8")
        held.clear()
        size = 0
        columns = [[own.tobytes()], [values.tobytes()], [None], [None], [None], [len(own)], ["array"]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, shape.types)], schema=shape)

    def words() -> Iterator[pa.RecordBatch]:
        for lo in range(1, len(known), 50_000):
            part = known[lo : lo + 50_000]
            lang, word, code = zip(*part)
            none = pa.nulls(len(part), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.array(lang, pa.string()), pa.array([w.decode() for w in word], pa.string()),
                 pa.array(np.array(code, np.uint64).view(np.int64)), pa.array(counts[lo : lo + 50_000]), pa.array(["word"] * len(part))],
                schema=shape,
            )

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
            if lang not in codes:
                codes[lang] = _Codes(lang, known, seed)
            tokens = text.as_py().encode().translate(_LETTERS).replace(_STOP, b" . ").split()
            tokens.append(_STOP)
            held.append(np.fromiter(map(codes[lang].__getitem__, tokens), np.int32, len(tokens)))
            size += len(tokens)
            if size >= ROW_WORDS or len(known) > REMEMBERED:
                yield arrays()
                if len(known) > REMEMBERED:
                    yield from words()
                    del known[1:]
                    codes.clear()
                    counts = np.zeros(1, np.int64)
    if held:
        yield arrays()
    yield from words()
    known.clear()
    codes.clear()
    release()


class Trie(NamedTuple):
    """Double array over symbols 1 to n: from ``state`` a symbol leads to ``base[state] + symbol`` if ``check`` there is the state."""

    symbols: np.ndarray  # codes, sorted; symbol ``rank`` of each
    rank: np.ndarray
    base: np.ndarray
    check: np.ndarray
    accepts: np.ndarray  # by state, the candidate that ends there, or -1
    phrases: np.ndarray  # codes of each candidate
    depth: int


def trie(phrases: np.ndarray) -> Trie:
    """Trie of distinct phrases of equal length, given as rows of codes."""
    n, depth = phrases.shape
    symbols, numbered, uses = np.unique(phrases, return_inverse=True, return_counts=True)
    rank = np.empty(len(symbols), np.int64)
    rank[np.argsort(-uses, kind="stable")] = np.arange(1, len(symbols) + 1)  # frequent symbols are close together, so children are
    rows = rank[numbered.reshape(n, depth)]
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]

    width = len(symbols) + 1
    size = 2 * n * depth + 2 * width + 4096
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    free = np.ones(size, bool)
    free[0] = False
    full = 1  # no free place is before this one
    parent = np.zeros(n, np.int64)  # state of each row
    for level in range(depth):
        symbol = rows[:, level]
        first = np.flatnonzero(np.concatenate([[True], (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])]))
        children = symbol[first]
        owner = parent[first]
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        ends = np.append(starts[1:], len(owner))
        # Many children first, while there is room; those of one child then fill any place.  The search goes on from where the
        # last one ended, and back to the first free place when half as many children are to be placed.
        at, most = full, 0
        for s, e in sorted(zip(starts.tolist(), ends.tolist()), key=lambda x: x[0] - x[1]):
            if e - s == 1:
                break
            own = children[s:e]
            low = int(own.min())
            if 2 * (e - s) <= most or not most:
                at, most = full, e - s
            look = 64
            while True:
                if at + look + width >= len(free):
                    more = len(free)
                    base, check = np.concatenate([base, np.zeros(more, np.int32)]), np.concatenate([check, np.full(more, -1, np.int32)])
                    free = np.concatenate([free, np.ones(more, bool)])
                places = at + np.flatnonzero(free[at : at + look])
                fits = free[places[:, None] - low + own].all(1) if len(places) else np.zeros(0, bool)
                if fits.any():
                    at = int(places[fits.argmax()])
                    start = at - low
                    break
                at += look
                look = max(1, min(2 * look, LOOKED // (e - s)))
            base[owner[s]] = start
            free[start + own] = False
            check[start + own] = owner[s]
        lone = starts[ends - starts == 1]
        places = np.flatnonzero(free[full:])[: len(lone)] + full
        if len(places) < len(lone):
            more = len(lone)
            base, check = np.concatenate([base, np.zeros(more, np.int32)]), np.concatenate([check, np.full(more, -1, np.int32)])
            places = np.append(places, np.arange(len(free), len(free) + len(lone) - len(places)))
            free = np.concatenate([free, np.ones(more, bool)])
        base[owner[lone]] = places - children[lone]
        check[places] = owner[lone]
        free[places] = False
        full += int(free[full:].argmax())
        state = base[owner] + children
        parent = np.repeat(state, np.diff(np.append(first, n)))
    accepts = np.full(len(free), -1, np.int32)
    accepts[parent] = order
    return Trie(symbols, rank.astype(np.int32), base, check, accepts, phrases, depth)


def matches(t: Trie, numbers: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the array at which a candidate starts, and the candidate."""
    at = np.searchsorted(t.symbols, codes)
    known = t.symbols[np.minimum(at, len(t.symbols) - 1)] == codes
    symbol_of = np.where(known, t.rank[np.minimum(at, len(t.symbols) - 1)], 0).astype(np.int32)
    symbol_of[0] = 0
    symbols = symbol_of[numbers]
    places = np.flatnonzero(symbols[: max(len(symbols) - t.depth + 1, 0)])
    states = np.zeros(len(places), np.int32)
    for level in range(t.depth):
        symbol = symbols[places + level]
        following = t.base[states] + symbol
        good = (symbol > 0) & (following >= 0) & (following < len(t.check))
        good[good] = t.check[following[good]] == states[good]
        places, states = places[good], following[good]
    return places, t.accepts[states]


def _keys(values: np.ndarray) -> pa.Array:
    """Rows of codes as binary."""
    raw = np.ascontiguousarray(values, "<u8")
    wide = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * raw.shape[1]), len(raw), [None, pa.py_buffer(raw.tobytes())])
    return wide.cast(pa.binary())


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of codes in a filter of ``bits`` bits, a power of two."""
    total = np.zeros(len(keys), np.uint64)
    for i in range(keys.shape[1]):
        total = (total ^ keys[:, i]) * _MIX
        total ^= total >> np.uint64(29)
    return (total * _MIX) >> np.uint64(65 - bits.bit_length())


def _marked(keys: np.ndarray, bits: np.ndarray) -> None:
    at = _places(keys, 8 * len(bits))
    np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))


def _passed(batches: Iterator[pa.RecordBatch], t: Trie, ends: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Counts of the candidates in all arrays of a task, with ``code`` 0, and of their extensions by a word's code in each array.

    ``ends`` is a filter of all candidates of this length: an extension whose last words are surely none is not frequent.
    """
    total = np.zeros(len(t.phrases), np.int64)
    for b in batches:
        release()  # positions of the last arrays, or what earlier levels have left
        for raw, values in zip(b.column("numbers"), b.column("codes")):
            numbers, codes = np.frombuffer(raw.as_py(), "<i4"), np.frombuffer(values.as_py(), "<u8")
            places, found = matches(t, numbers, codes)
            total += np.bincount(found, minlength=len(total))
            if ends is not None and len(places):
                following = numbers[places + t.depth]  # every array ends with the end of a piece
                inner = following > 0
                last = np.column_stack([codes[numbers[places[inner] + i]] for i in range(1, t.depth + 1)])
                at = _places(last, 8 * len(ends))
                known = (ends[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                pair, n = np.unique((found[inner][known].astype(np.int64) << 32) | following[inner][known], return_counts=True)
                for lo in range(0, len(pair), 100_000):
                    some = pair[lo : lo + 100_000]
                    yield _counted(some >> 32, codes[some & 0xFFFFFFFF], n[lo : lo + 100_000])
    met = np.flatnonzero(total)
    for lo in range(0, len(met), 100_000):
        some = met[lo : lo + 100_000]
        yield _counted(some, np.zeros(len(some), np.uint64), total[some])
    release()


def _counted(at: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(code.view(np.int64)), pa.array(n)], ["at", "code", "n"])


def _spelled(batches: Iterator[pa.RecordBatch], t: Trie) -> Iterator[pa.RecordBatch]:
    """Candidates and extensions by their codes, from the numbers that they have in the trie."""
    for b in batches:
        phrases, code = t.phrases[b.column("at").to_numpy()], b.column("code").to_numpy().view(np.uint64)
        for following in (False, True):
            here = (code != 0) == following
            keys = np.column_stack([phrases[here], code[here]]) if following else phrases[here]
            n = b.column("n").filter(pa.array(here))
            yield pa.RecordBatch.from_arrays([_keys(keys), n, pa.array(np.full(len(n), following))], ["key", "n", "following"])
    release()


def _level(arrays: DataFrame, candidates: DataFrame, size: int, extend: bool, least: int, per_trie: int) -> DataFrame:
    """key, n, following: candidates of ``size`` words, and their extensions by one word, that are found ``least`` times."""
    spark = arrays.sparkSession
    number = candidates.count()
    tries = -(-number // per_trie)

    def keys_of(i: int) -> np.ndarray:
        own = candidates.where(F.pmod(F.xxhash64("key"), F.lit(tries)) == i).select("key").toArrow()
        keys = np.frombuffer(b"".join(own.column("key").to_pylist()), "<u8").reshape(-1, size)
        return keys[np.lexsort(keys.T[::-1])]

    ends = None
    if extend:
        ends = np.zeros(min(MOST_BITS, 1 << max(10, (16 * number).bit_length())) // 8, np.uint8)
        for i in range(tries):
            _marked(keys_of(i), ends)
    found = []
    for i in range(tries):
        keys = keys_of(i)
        if not len(keys):
            continue
        sent = spark.sparkContext.broadcast((trie(keys), ends))
        rows = arrays.mapInArrow(lambda batches, sent=sent: _passed(batches, *sent.value), "at int, code long, n long")
        sums = rows.groupBy("at", "code").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        named = sums.mapInArrow(lambda batches, sent=sent: _spelled(batches, sent.value[0]), "key binary, n long, following boolean")
        found.append(stored(named, f"collocations-{size}"))
        sent.destroy()
    return reduce(DataFrame.unionByName, found)


def encoded(docs: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Arrays of word numbers with their codes, and the counted words: lang, word, code, n; both written."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), whole(docs["text"]).alias("text"))
    path = shared_folder(spark, "collocations")
    shape = "numbers binary, codes binary, lang string, word string, code long, n long, kind string"
    texts.mapInArrow(lambda b: _encoded(b, seed), shape).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    rows = spark.read.schema(shape).parquet(path)
    words = rows.where("kind = 'word'").groupBy("lang", "word", "code").agg(F.sum("n").alias("n"))
    return rows.where("kind = 'array'").select("numbers", "codes"), stored(words, "collocations-words")


def _told_apart(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``encoded``, with a seed under which no two words share a code."""
    for seed in count():
        arrays, words = encoded(docs, seed)
        if words.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR code = 0").isEmpty():
            return arrays, words


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, per_trie: int = CANDIDATES) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words with at least ``least`` occurrences: key, size, lang, phrase, a; and lang, n."""
    arrays, words = _told_apart(docs)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least).select(_reversed_bytes("code").alias("key"), "lang", F.col("word").alias("phrase"))
    frequent = stored(frequent, "collocations-frequent")
    level, found = frequent, []
    for size in range(1, longest + 1):
        if level.isEmpty():
            break
        extend = size < longest
        rows = _level(arrays, level, size, extend, least, per_trie)
        counted = rows.where("NOT following").join(level, "key")
        counted = stored(counted.select("key", F.lit(size).alias("size"), "lang", "phrase", F.col("n").alias("a")), "collocations-phrases")
        found.append(counted)
        if extend:
            longer = rows.where("following").select("key")
            longer = longer.withColumn("_first", F.expr(f"substring(key, 1, {8 * size})")).withColumn("_last", F.expr(f"substring(key, {8 * size + 1}, 8)"))
            longer = longer.withColumn("_rest", F.expr(f"substring(key, 9, {8 * size})"))
            longer = longer.join(counted.select(F.col("key").alias("_first"), "lang", "phrase"), "_first")
            longer = longer.join(frequent.select(F.col("key").alias("_last"), F.col("phrase").alias("_word")), "_last")
            longer = longer.join(counted.select(F.col("key").alias("_rest")), "_rest", "left_semi")
            level = stored(longer.select("key", "lang", F.concat_ws(" ", "phrase", "_word").alias("phrase")), "collocations-candidates")
    if not found:
        shape = "key binary, size int, lang string, phrase string, a long"
        return docs.sparkSession.createDataFrame([], shape), totals
    return reduce(DataFrame.unionByName, found), totals


def _reversed_bytes(code: str) -> Column:
    """A 64-bit number as its eight bytes, the lowest first, as numpy writes them."""
    digits = F.lpad(F.hex(code), 16, "0")
    return F.unhex(F.concat(*(F.substring(digits, 15 - 2 * i, 2) for i in range(8))))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, best: int = BEST, per_trie: int = CANDIDATES) -> DataFrame:
    """The first ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A null text is empty, a null language ``und``.  Words end at spaces and tabs, pieces at ``. , ; : ! ?`` and the controls 10
    to 13; A-Z become lower-case.  ``n`` counts the words of the language, ``a`` a phrase's occurrences within pieces, overlaps
    included.  Of a phrase's cuts into a first part, found ``l`` times, and a rest, found ``r`` times, the one with the lowest
    score ``floor(1000 * a * n / (l * r))`` counts, then the shortest first part.  A phrase that lies in a longer one of the same
    count is left out.  Repeated rows count as often as they stand.  The empty table gives the empty table.  Other columns are
    ignored and may have any name.
    """
    known, totals = phrases(docs, least, longest, per_trie)
    longer = known.where("size > 2")
    inside = [longer.select(F.expr(f"substring(key, {at}, 8 * (size - 1))").alias("key"), F.col("a").alias("_longer")) for at in (1, 9)]
    # A longer phrase as frequent as this one implies one that is a single word longer.
    covered = inside[0].unionByName(inside[1]).groupBy("key").agg(F.max("_longer").alias("_longer"))
    kept = known.where("size > 1").join(covered, "key", "left").where("_longer IS NULL OR _longer < a")

    cuts = kept.select("key", "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size")
    cuts = cuts.withColumn("_left", F.expr("substring(key, 1, 8 * k)")).withColumn("_right", F.expr("substring(key, 8 * k + 1, 8 * (size - k))"))
    parts = known.select("key", "a")
    cuts = cuts.join(parts.toDF("_left", "l"), "_left").join(parts.toDF("_right", "r"), "_right").join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in "alrn"}
    above = F.lit(1000).cast("decimal(4,0)") * (wide["a"] * wide["n"])
    cuts = cuts.withColumn("_above", above).withColumn("_below", wide["l"] * wide["r"]).withColumn("score", F.expr("_above div _below"))
    lowest = cuts.groupBy("key", "lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    scored = lowest.select("key", "lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = scored.withColumn("_part", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    salted = salted.withColumn("_nth", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_nth") <= best)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
