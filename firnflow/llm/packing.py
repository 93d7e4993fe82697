"""Packing by concatenate and cut: documents follow one another in one stream of tokens, cut into windows of equal length.

First pass: tokens of every document, its offset within its partition, and one token total for each partition.  The prefix
sums of these totals give every document its global offset.  Second pass: a document's pieces are what the windows that it
crosses cut from it.  Nothing is shuffled by document; only the last window is padded.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firnflow.llm.common import release, stored, whole

WINDOW = 4096
END_ID = 2
REMEMBERED = 1_000_000  # words, and stretches between white space, kept by each task: some 160 MB
KEPT = 800_000  # up to which they stay for the worker's next task, which finds most of its words there: some 130 MB
LONGEST = 64  # characters of one that is kept
BATCH = 2_000

# Up to here characters are already composed and lower-case one by one, so words can be told apart beforehand.
_SIMPLE = "ſ"
_LETTERS = "".join(re.escape(chr(c)) for c in range(ord(_SIMPLE) + 1) if unicodedata.category(chr(c))[0] == "L")
_NUMBERS = "".join(re.escape(chr(c)) for c in range(ord(_SIMPLE) + 1) if unicodedata.category(chr(c))[0] == "N")
# With the controls 28 to 31 out of the way, these are what str.split takes for white space as well.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_WHITE}{_LETTERS}{_NUMBERS}]+")
_OTHER = re.compile(f"[^\\x00-\\x1b\\x20-{_SIMPLE}]")
_SPECIAL = "<|"


class Words(dict):
    """Ids, as little-endian unsigned 32-bit integers, of words and of stretches between white space, learnt when first met."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        # Every word ends with an id whose piece ends a word, and only there.
        self.ends = {i for piece, i in tokenizer.get_vocab().items() if piece.endswith("</w>")}

    def learn(self, words: Iterable[str]) -> None:
        """Encodes new words in one call, as one text, and tells them apart by the ids that end a word."""
        words = [w for w in words if w not in self]
        held: list[int] = []
        ends, order = self.ends, iter(words)
        for i in self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids:
            held.append(i)
            if i in ends:
                self[next(order)] = struct.pack(f"<{len(held)}I", *held)
                held = []

    def found(self, stretches: list[str]) -> bytes:
        """Ids of all stretches, one after the other; each is looked up once, and again only if it is new."""
        if len(self) > REMEMBERED:
            self.clear()
        ids = list(map(self.get, stretches))
        missing = [k for k, i in enumerate(ids) if i is None]
        if not missing:
            return b"".join(ids)
        new = {stretches[k] for k in missing}
        cut = {s: _WORDS.findall(s) for s in new if not s.isalpha()}
        words = {s for s in new if s not in cut}.union(*cut.values())
        self.learn(words)
        for s, own in cut.items():
            self[s] = b"".join([self[w] for w in own])
        for k in missing:
            ids[k] = self[stretches[k]]
        # A word is no longer than a stretch that holds it.
        if max(map(len, new)) > LONGEST:
            for s in new | words:
                if len(s) > LONGEST:
                    del self[s]
        return b"".join(ids)


@cache
def loaded(path: str) -> Words:
    return Words(Tokenizer.from_file(path))


def token_bytes(words: Words, text: str) -> bytes:
    """Ids of a text.  The tokenizer's words are independent of each other; texts with characters beyond the simple ones, or
    that may spell a special token, go to the library whole, with the same result."""
    if _OTHER.search(text) or _SPECIAL in text:
        ids = words.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)
    return words.found(text.lower().split())


def tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary) with the end id, n, part, start_in_part: first pass, not yet written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # the vocabulary and what is remembered come on top of what earlier stages have left
        words, part, before = loaded(path), TaskContext.get().partitionId(), 0
        end = struct.pack("<I", END_ID)
        for b in batches:
            for at in range(0, b.num_rows, BATCH):
                piece = b.slice(at, BATCH)
                ids = [token_bytes(words, t.as_py()) + end for t in piece.column("text")]
                counts = [len(i) // 4 for i in ids]
                ends = list(accumulate(counts, initial=before))
                before = ends[-1]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(ids, pa.binary()), pa.array(counts, pa.int64()),
                     pa.array([part] * len(ids), pa.int32()), pa.array(ends[:-1], pa.int64())],
                    ["doc_id", "ids", "n", "part", "start_in_part"],
                )
        if len(words) > KEPT:
            words.clear()
        release()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole(docs["text"]).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids binary, n long, part int, start_in_part long"
    )


def packed(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset.

    A null or empty text is just the end id.  Repeated rows are documents of their own.  The empty table has no piece.
    Other columns are ignored and may have any name.
    """
    first = stored(tokens(docs, path), "packing")
    # One row per partition.
    totals = sorted((r["part"], r["n"]) for r in first.groupBy("part").agg(F.sum("n").alias("n")).collect())
    starts = accumulate((n for _, n in totals), initial=0)
    offsets = docs.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(totals, starts)], "part int, _before long")
    at = first.join(F.broadcast(offsets), "part").withColumn("_from", F.col("_before") + F.col("start_in_part"))
    first_window, last_window = F.expr(f"_from div {window}"), F.expr(f"(_from + n - 1) div {window}")
    cut = at.withColumn("sequence_id", F.explode(F.sequence(first_window, last_window)))
    cut = cut.withColumn("start", F.greatest(F.lit(0), F.col("sequence_id") * window - F.col("_from")))
    cut = cut.withColumn("length", F.least(F.col("n"), (F.col("sequence_id") + 1) * window - F.col("_from")) - F.col("start"))
    return cut.select(
        "doc_id",
        F.col("start").cast("long").alias("start"),
        F.col("length").cast("long").alias("length"),
        F.substring("ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")).alias("ids"),
        F.col("n").alias("doc_tokens"),
        "sequence_id",
        (F.col("_from") + F.col("start") - F.col("sequence_id") * window).alias("offset"),
    )
