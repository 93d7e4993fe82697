"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Four base kinds (email, ip, card, phone) always stay.  Added kinds need a score of at least ``ACCEPT``: account numbers whose
remainder modulo 97 is 1, social security numbers, access keys and values given to secrets, the latter kinds by their form
and the words before them.  All patterns run in linear time, so a very long text is no trouble.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnflow.llm.common import whole

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "key", "secret")
ACCEPT = 0.5
NEAR = 48  # characters before a span that are looked at for context

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_KEY = re.compile(r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])")
_SECRET = re.compile(r"(?i:\b(?:password|passwd|secret|token|api[_-]?key))\s{0,3}[=:]\s{0,3}([\"']?)([A-Za-z0-9_+/=-]{12,})\1")
_DIGITS = str.maketrans("", "", " -")
_NOT_DIGIT = re.compile("[^0-9]")

# What the words before a span add to its score.
CONTEXT = {
    "email": ("mail", "contact"), "ip": ("ip", "host", "server"), "card": ("card", "visa", "credit"), "phone": ("phone", "call", "tel"),
    "iban": ("iban", "account", "bank"), "ssn": ("ssn", "social security", "taxpayer"), "key": ("aws", "access", "key"),
    "secret": (),
}
START = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "key": 0.8, "secret": 0.6}
BONUS = 0.3


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def mod97(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str):
    before = 0
    for m in _DOMAIN.finditer(text):
        start = at = m.start()
        while start > before and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            before = m.end()
            yield start, before


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _accounts(text: str):
    """Account numbers from the left: after one the search goes on at its end, after a proposal without one at its next word."""
    at = 0
    while m := _IBAN.search(text, at):
        # Capital words may follow an account number: the longest cut at a space that the checksum confirms.
        part = m.group()
        while part and not (15 <= len(part.replace(" ", "")) <= 34 and mod97(part.replace(" ", ""))):
            part = part.rpartition(" ")[0]
        at = m.start() + len(part or m.group().partition(" ")[0])
        if part:
            yield m.start(), at


def spans(text: str) -> list[Span]:
    """All spans by start, then kind; positions in code points, ends exclusive."""
    found: list[tuple[int, int, int]] = []
    if "@" in text:
        found += [(s, 0, e) for s, e in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := m.group().translate(_DIGITS)) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    found += [(s, 4, e) for s, e in _accounts(text)]
    found += [(m.start(), 5, m.end()) for m in _SSN.finditer(text)]
    found += [(m.start(), 6, m.end()) for m in _KEY.finditer(text)]
    for m in _SECRET.finditer(text):
        value = m.group(2)
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            found.append((m.start(2), 7, m.end(2)))
    out = []
    for s, k, e in sorted(found):
        name = KINDS[k]
        near = text[max(0, s - NEAR) : s].lower()
        score = min(1.0, START[name] + (BONUS if any(w in near for w in CONTEXT[name]) else 0.0))
        if k < len(BASE) or score >= ACCEPT:
            out.append(Span(s, k, e, score))
    return out


def redacted(text: str, found: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; spans that overlap are replaced together."""
    out, end = [], 0
    for s in found:
        if s.start >= end:
            out += [text[end : s.start], f"[{KINDS[s.kind].upper()}]"]
        end = max(end, s.end)
    return "".join([*out, text[end:]])


SHAPE = "struct<n_email:long,n_ip:long,n_card:long,n_phone:long,base:string,spans:string,scores:string,redacted:string>"


def _found(texts: pa.Array) -> pa.Array:
    rows = []
    for t in texts:
        text = t.as_py()
        got = spans(text)
        own = [f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in got]
        counts = [0] * len(KINDS)
        for s in got:
            counts[s.kind] += 1
        rows.append((*counts[:4], ",".join(o for o, s in zip(own, got) if s.kind < 4), ",".join(own),
                     ",".join(f"{s.score:.2f}" for s in got), redacted(text, got) if got else None))
    names = ["n_email", "n_ip", "n_card", "n_phone", "base", "spans", "scores", "redacted"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 4
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def found(text: Column) -> Column:
    """Struct of counts, base spans, all spans, scores and the redacted text (null where nothing is found); null is empty."""
    return F.arrow_udf(_found, SHAPE)(whole(text))


def detected(docs: DataFrame) -> DataFrame:
    """doc_id with counts and spans, one row per row; null or empty texts have none, other columns may have any name."""
    rows = docs.select("doc_id", found(docs["text"]).alias("pii"))
    return rows.select("doc_id", *(F.col("pii")[n].alias(n) for n in ("n_email", "n_ip", "n_card", "n_phone", "base", "spans", "scores")))


def without(docs: DataFrame) -> DataFrame:
    """``docs`` with spans replaced in ``text`` and ``n_chars`` counted anew where something was; other rows as they are."""
    names = docs.columns
    rows = docs.select(*(docs[f"`{n}`"] for n in names), found(docs["text"])["redacted"].alias("__redacted"))
    changed = F.col("__redacted").isNotNull()
    new = {"text": F.when(changed, F.col("__redacted")).otherwise(F.col("text"))}
    if "n_chars" in names:
        new["n_chars"] = F.when(changed, F.length("__redacted").cast("long")).otherwise(F.col("n_chars"))
    return rows.select(*(new[n].alias(n) if n in new else F.col(f"`{n}`") for n in names))
