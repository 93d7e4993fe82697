"""Language by compression: a text belongs to the language whose sample helps most to compress it.

Each language has a raw-content dictionary of labelled texts.  A text is cut into pieces of a few kilobytes, all of them are
compressed once per dictionary, and the smallest sum wins.  How much larger the second smallest is, is the score; where the
margin is narrow the row is marked as rejected, as is a text without letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the sample that the dictionaries are made from.
DICTIONARY_BYTES = 96 << 10  # for each language
SAMPLE_ROWS = 300  # expected of each language, chosen by a hash of doc_id
SAMPLE_TEXT = 32 << 10  # bytes; longer texts are left out of the sample
PIECE = 1200  # characters compressed at a time
LEVEL = 5
NARROW = 0.002  # margins below this are rejected
UNKNOWN = "und"

_OTHERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """What is compressed: the text in lower case, every run of other characters than letters as one space."""
    return _OTHERS.sub(" ", text.lower()).strip()


def fitted(labelled: DataFrame) -> dict[str, bytes]:
    """One dictionary per language from doc_id, text and lang; rows without text or lang are ignored.

    The sample is bounded: by rows expected of each language, by bytes of a text, and by the size of a dictionary.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.octet_length("text") <= SAMPLE_TEXT))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, SAMPLE_ROWS / n)).otherwise(share)
    rows = usable.where(spread < share).select("lang", "text", F.xxhash64("doc_id").alias("h")).collect()
    out: dict[str, bytearray] = {lang: bytearray() for lang in sorted(counts, key=lambda x: (-counts[x], x))}
    for r in sorted(rows, key=lambda r: (r["h"], r["text"])):
        held = out[r["lang"]]
        if len(held) < DICTIONARY_BYTES:
            held += letters(r["text"]).encode() + b" "
    return {lang: bytes(v[:DICTIONARY_BYTES]) for lang, v in out.items() if v}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = list(dictionaries)  # the most frequent first, which decides ties
        self.compressors = []
        for lang in self.languages:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float]:
        text = letters(text or "")
        if not text or not self.languages:
            return UNKNOWN, 0.0
        pieces = [text[i : i + PIECE].encode() for i in range(0, len(text), PIECE)]
        sizes = [sum([len(c.compress(p)) for p in pieces]) for c in self.compressors]
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(sizes) == 1:
            return self.languages[0], 1.0
        second = min(s for i, s in enumerate(sizes) if i != best)
        return self.languages[best], 1.0 - sizes[best] / second


def predicted(docs: DataFrame, dictionaries: dict[str, bytes], *keep: Column) -> DataFrame:
    """``keep`` columns, lang_pred (``und`` for a text that is null or has no letter), score (0 to 1), rejected."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(dictionaries)  # bounded: DICTIONARY_BYTES for each language
    made: list[Classifier] = []

    def run(batches: Iterator[tuple[pa.Array]]) -> Iterator[pa.Array]:
        model = made[0] if made else Classifier(shared.value)
        for texts in batches:
            got = [model.predict(t.as_py()) for t in texts]
            names, scores = pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())
            yield pa.StructArray.from_arrays([names, scores], ["lang_pred", "score"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    judged = F.arrow_udf(run, "struct<lang_pred:string,score:double>")
    rows = docs.select(*keep, judged(docs["text"]).alias("__said"))
    names = rows.columns[:-1]
    lang, score = F.col("__said.lang_pred"), F.col("__said.score")
    return rows.select(
        *(F.col(f"`{n}`") for n in names), lang.alias("lang_pred"), score.alias("score"),
        ((lang == UNKNOWN) | (score < NARROW)).alias("rejected"),
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of the documents that nothing is learned from."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
