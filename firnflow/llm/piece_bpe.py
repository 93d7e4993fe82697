"""Exact encoding and decoding with a merge-type SentencePiece model, by backtracking.

A text becomes one chain of pieces in which every two neighbours are compatible: merging their joined characters again,
best score first and leftmost among equals, ends at exactly these two pieces.  Such a chain is the model's own result.  An
Aho-Corasick pass gives the longest piece from each position; the search walks left to right, tries shorter prefixes where a
neighbour is not compatible or the end position is known to fail, and steps back where none is left.  A bitfield marks the
positions from which no chain continues, so each position fails at most once.

Where no piece holds two characters next to each other no piece crosses, so the stretches between such places are independent,
and their results are remembered.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnflow.llm.common import whole

MARK = "▁"  # stands for a space inside pieces
REMEMBERED = 500_000  # words kept by each task, of at most LONGEST characters
LONGEST = 32
PAIRS = 300_000  # neighbours kept by each task


class PieceBpe:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses a word border; words cannot be encoded one by one")
        self.byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(len(model)) if model.is_byte(i)}
        self.text_of = {i: p.replace(MARK, " ") for p, i in self.ids.items()}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.automaton = ahocorasick.Automaton()
        # What a piece's right and left end are after each of its own merges, None where a merge is further inside.
        self.right: dict[str, list] = {}
        self.left: dict[str, list] = {}
        reachable = {p for p in self.ids if self._recorded(p)}
        for p in reachable:
            self.automaton.add_word(p, (p, len(p) - 1))
        self.automaton.make_automaton()
        # The longest proper prefix of a piece that is a piece too.
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in reachable), None) for p in reachable}
        self.borders = self._borders()
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, tuple[bytes, str]] = {}

    def _borders(self) -> re.Pattern:
        """Cuts a text where no piece can cross: no piece holds the two characters beside the cut next to each other.

        That is so before every run of marks, on both sides of characters that are in no longer piece, and between a letter and
        punctuation that no piece has after a letter.
        """
        beside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        inside = {c for b in beside for c in b}
        alone = re.escape("".join(chr(c) for c in range(128) if chr(c) not in inside))
        ends = {chr(c) for c in range(33, 127) if not chr(c).isalnum()} - {b[1] for b in beside if b[0].isalpha()}
        ends = re.escape("".join(sorted(ends)))
        letters = "A-Za-z" + "".join(chr(c) for c in range(0xC0, 0x180) if chr(c).isalpha())
        return re.compile(f"{MARK}*[{letters}]++(?=[{MARK}{ends}{alone}]|\\Z)|{MARK}*[^{MARK}{alone}]+|{MARK}*[{alone}]|{MARK}+")

    def _recorded(self, text: str) -> bool:
        """Merges a piece's characters, best first and leftmost among equals, and notes the steps; true if they end at the piece."""
        parts, right, left = list(text), [], []
        while True:
            at, best = -1, None
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    at, best = i, s
            if at < 0:
                self.right[text], self.left[text] = right, left
                return len(parts) == 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            right.append((best, parts[at] if at == len(parts) - 1 else None))
            left.append((best, parts[at] if at == 0 else None))

    def compatible(self, left: str, right: str) -> bool:
        """Merges both pieces again side by side, best step first; false if a merge across the border would come first."""
        score = self.score.get
        steps, others = iter(self.right.get(left, ())), iter(self.left.get(right, ()))
        own, other = next(steps, None), next(others, None)
        last, first = left[-1], right[0]
        across = score(last + first)
        while True:
            if across is not None and (own is None or across > own[0]) and (other is None or across >= other[0]):
                return False
            if own is not None and (other is None or own[0] >= other[0]):
                edge, own = own[1], next(steps, None)
                if edge is not None:
                    last = edge
                    across = score(last + first)
            elif other is not None:
                edge, other = other[1], next(others, None)
                if edge is not None:
                    first = edge
                    across = score(last + first)
            else:
                return True

    def pieces(self, text: str) -> list[str]:
        n = len(text)
        longest = list(text)  # a character that is no piece stands for itself
        for end, (p, before) in self.automaton.iter(text):
            longest[end - before] = p  # ends grow, so the last is the longest
        fits, compatible, shorter = self.fits, self.compatible, self.shorter
        if len(fits) > PAIRS:
            fits.clear()
        fails = 0
        chain: list[str] = []
        last = None
        pos, piece = 0, longest[0] if n else ""
        while pos < n:
            end = pos + len(piece)
            if not fails or not fails >> end & 1:
                if last is None:
                    good = True
                else:
                    good = fits.get((last, piece))
                    if good is None:
                        good = fits[last, piece] = compatible(last, piece)
                if good:
                    chain.append(piece)
                    last = piece
                    pos = end
                    if pos < n:
                        piece = longest[pos]
                    continue
            piece = shorter.get(piece)
            if piece is None:
                fails |= 1 << pos
                piece = chain.pop()
                last = chain[-1] if chain else None
                pos -= len(piece)
        return chain

    def word(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the text they decode to."""
        ids: list[int] = []
        of = self.ids.get
        for p in self.pieces(text):
            i = of(p)
            if i is None:
                ids.extend([self.byte[b] for b in p.encode()])
            else:
                ids.append(i)
        found = struct.pack(f"<{len(ids)}I", *ids), self._text(ids)
        if len(text) <= LONGEST:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[text] = found
        return found

    def _text(self, ids: list[int]) -> str:
        try:
            return "".join([self.text_of[i] for i in ids])
        except KeyError:  # bytes among them
            pass
        out, held = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(self.text_of.get(i, ""))
        out.append(held.decode("utf-8", "replace"))
        return "".join(out)

    def encoded(self, text: str) -> tuple[bytes, str]:
        """All ids with begin and end, and the text that they decode to."""
        ends = struct.pack("<I", self.begin), struct.pack("<I", self.end)
        if not text:
            return ends[0] + ends[1], ""
        words = self.borders.findall(MARK + text.replace(" ", MARK))
        got, missing = self.words.get, self.word
        both = [got(w) or missing(w) for w in words]
        ids = b"".join([ends[0], *[b[0] for b in both], ends[1]])
        return ids, "".join([b[1] for b in both])[1:]

    def decoded(self, ids: list[int]) -> str:
        """The text of ids as ``encoded`` gives them: control ids have none, the first space is the model's own."""
        text = self._text([i for i in ids if i not in (self.begin, self.end)])
        return text[1:] if text.startswith(" ") else text


@cache
def loaded(path: str) -> PieceBpe:
    return PieceBpe(path)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit, begin and end included) and decoded text of every row.

    A null or empty text has just the two ids and decodes to the empty text.  Rows are independent: repeated rows repeat,
    an empty table stays empty, other columns are ignored and may have any name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for b in batches:
            got = [model.encoded(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole(docs["text"]).alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def digests(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
