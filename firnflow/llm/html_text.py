"""Main text of web pages, by deducing each host's template from equivalence classes of tokens.

Tokens are elements, told apart by their path, and whole text blocks.  A token's occurrence vector, how often it stands on each
page of its host, is kept as MinHash samples, which combine over pages, so that no task needs all pages of a host.  Tokens that
share a sample form a class; their vectors are equal but for a few pages, such as those cut off or with an error.  Classes that
are large, stand on most pages and whose elements nest in one another make up the template.
What remains are slots: runs of text in the deepest template element round them.  Template text goes, as do slots that the
template marks as menus, notices and the like, or that hold links for the most part.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnflow.llm.common import stored, whole

FEWEST_PAGES = 5  # of a host; with fewer, what is equal on all may be content
SUPPORT = 0.75  # share of a host's pages on which a template's tokens stand; others may be broken
LARGE = 3  # tokens of a class
SAMPLES = 3  # of an occurrence vector
BROADCAST_HOSTS = 50_000  # templates sent to all tasks at most; beyond, they are joined by host
LONGEST_TEMPLATE = 2_000  # tokens of one host's template that are sent; what is beyond is joined

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)[^<>]*+>")
_RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "svg", "title", "select", "object", "xmp")
_RAW_END = {t: re.compile(f"</{t}(?=[\\s/>])[^>]*>", re.I) for t in _RAW}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5"
    " h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
# An element that starts closes an open one of these, unless one of the second kind lies between.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)), "option": (("option",), ("select",)),
}
_NOT_IN_P = _BLOCKS - {"tr", "tbody", "thead", "tfoot", "option", "optgroup", "caption", "legend", "summary", "body", "html", "head"}
_LIMITS = frozenset("article aside body button div footer form header li main nav section table td th".split())

_SIDE_TAGS = frozenset("aside button dialog footer form head menu nav search".split())
_SIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adbox|advert\w*|banner\w*|bread-?crumbs?|comments?|commentlist|consent|cookies?|copyright|disclaimer|disqus|footer"
    r"|gdpr|login|menu\w*|modal|nav|navbar|navigation|newsletter|notices?|pager|pagination|popup|promo\w*|related|replies|respond|share|sharing"
    r"|sidebar\w*|signup|skip|social|sponsor\w*|subscribe|toolbar|widget\w*)(?=$|[\s_-])",
    re.I,
)
_HEAD_NAMES = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar)(?=$|[\s_-])", re.I)
_SIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Block(NamedTuple):
    text: str
    linked: int  # characters of it that are links
    path: tuple[int, ...]  # hashes of the elements round it
    main: str  # "article" or "main" inside such an element, or empty
    unit: int  # which of the page's article and main elements, from 1
    side: bool  # inside a menu, notice, form and so on

    def token(self) -> int:
        return xxhash.xxh3_64_intdigest(f"{self.path[-1] if self.path else 0} {self.text}".encode())


class _Element(NamedTuple):
    tag: str
    path: int
    main: str
    unit: int
    side: bool
    link: bool


def parsed(page: str) -> tuple[list[Block], dict[int, int], dict[int, int]]:
    """Text blocks in page order, how often each element path starts, and the path round each path.  Broken markup does no harm."""
    blocks: list[Block] = []
    counts: dict[int, int] = {}
    above: dict[int, int] = {}
    stack: list[_Element] = [_Element("", 0, "", 0, False, False)]
    held: list[str] = []
    linked = units = 0
    pos, n = 0, len(page)

    def close_block() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                top = stack[-1]
                blocks.append(Block(text, linked, tuple(e.path for e in stack[1:]), top.main, top.unit, top.side))
            held.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text)
            held.append(text)
            if stack[-1].link:
                linked += len("".join(text.split()))

    while pos < n:
        lt = page.find("<", pos)
        if lt < 0:
            add(page[pos:])
            break
        add(page[pos:lt])
        m = _TAG.match(page, lt)
        if m is None:
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                pos = n if end < 0 else end + 3
            elif page.startswith(("<!", "<?"), lt):
                end = page.find(">", lt)
                pos = n if end < 0 else end + 1
            else:
                add("<")
                pos = lt + 1
            continue
        pos = m.end()
        tag, attributes = m.group(2).lower(), m.group(3)
        if m.group(1):
            at = len(stack) - 1
            while at > 0 and stack[at].tag != tag and not (stack[at].tag in _LIMITS and tag not in _LIMITS):
                at -= 1
            if at > 0 and stack[at].tag == tag:
                if any(e.tag in _BLOCKS for e in stack[at:]):
                    close_block()
                elif tag in ("td", "th"):
                    held.append(" ")
                del stack[at:]
            elif tag == "p":
                close_block()
            continue
        if tag in _RAW_END:
            end = _RAW_END[tag].search(page, pos)
            pos = n if end is None else end.end()
            continue
        if tag in _BLOCKS:
            close_block()
            if tag in _NOT_IN_P:
                _close(stack, ("p",), _LIMITS)
        elif tag in ("br", "td", "th", "img"):
            held.append(" ")
        if tag in _CLOSES:
            _close(stack, *_CLOSES[tag])
        if tag in _VOID:
            continue
        near = stack[-1]
        names, role, hidden = "", "", False
        main = near.main
        if attributes.strip():
            given = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(attributes)}
            names = f"{given.get('class', '')} {given.get('id', '')}".strip()
            role = given.get("role", "").lower()
            hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "")
            if given.get("itemprop", "").lower() == "articlebody":
                main = "article"
        if tag == "article" or tag == "main" and not main or role in ("main", "article") and not main:
            main = "article" if tag == "article" or role == "article" else "main"
        unit = near.unit
        if main != near.main:
            unit = units = units + 1
        side = near.side or hidden or tag in _SIDE_TAGS or role in _SIDE_ROLES or bool(names and _SIDE_NAMES.search(names))
        if not main and (tag == "header" or names and _HEAD_NAMES.search(names)):
            side = True
        path = xxhash.xxh3_64_intdigest(f"{near.path} {tag} {re.sub('[0-9]+', '0', names)}".encode())
        if path not in counts:
            above[path] = near.path
        counts[path] = counts.get(path, 0) + 1
        if not attributes.rstrip().endswith("/") or tag in _BLOCKS:
            stack.append(_Element(tag, path, main, unit, side, near.link or tag == "a"))
    close_block()
    return blocks, counts, above


def _close(stack: list[_Element], tags: tuple[str, ...], limits) -> None:
    for at in range(len(stack) - 1, 0, -1):
        if stack[at].tag in tags:
            del stack[at:]
            return
        if stack[at].tag in limits:
            return


def _letters(blocks: list[Block]) -> int:
    return sum(len(b.text.replace(" ", "")) for b in blocks)


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """Blocks of the slots that hold main text, joined by newlines.

    Menus, notices, adverts, forms and comments go, and so does template text, also inside articles; but where it is most of
    their text, the host's pages are copies of one another, and it stays.  An article or main element is one slot and evidence
    for its text: it goes only if it holds links for the most part and other text outweighs it, as with teasers.  Other slots go
    if they hold links for the most part.
    """
    blocks, _, _ = parsed(page)
    kept = [b for b in blocks if not b.side]
    if template:
        fixed = {t for b in kept if (t := b.token()) in template}
        inside = [b for b in kept if b.main]
        copied = 2 * _letters([b for b in inside if b.token() in fixed]) > _letters(inside)
        kept = [b for b in kept if b.main and copied or b.token() not in fixed]
    slots: dict[tuple[int, int], list[Block]] = {}
    own = []
    for b in kept:
        own.append((b.unit, 0) if b.unit else (0, next((p for p in reversed(b.path) if p in template), 0)))
        slots.setdefault(own[-1], []).append(b)
    size = {s: _letters(x) for s, x in slots.items()}
    links = {s for s, x in slots.items() if 2 * sum(b.linked for b in x) > size[s]}
    prose = sum(n for s, n in size.items() if s not in links)
    gone = {s for s in links if not s[0] or prose > size[s]}
    return "\n".join(b.text for b, s in zip(kept, own) if s not in gone)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements and text blocks of each page, with the element round an element and how often they stand there.

    A block's element stands wherever the block does, so it has none to look for.
    """
    for b in batches:
        at, tokens, times, rounds = [], [], [], []
        for i, p in enumerate(b.column("html")):
            blocks, counts, above = parsed(p.as_py())
            texts: dict[int, int] = {}
            for x in blocks:
                t = x.token()
                texts[t] = texts.get(t, 0) + 1
                above[t] = 0
            own = {**counts, **texts}
            if not own:
                continue
            at += [i] * (len(own) + 1)
            tokens += [0, *own]
            times += [1, *own.values()]
            rounds += [0, *(above[t] for t in own)]
        signed = [[t - (1 << 64) if t >= 1 << 63 else t for t in c] for c in (tokens, rounds)]
        pages = b.column("page").take(pa.array(at, pa.int64()))
        hosts = b.column("host").take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [hosts, pages, pa.array(signed[0], pa.int64()), pa.array(signed[1], pa.int64()), pa.array(times, pa.int64())],
            ["host", "page", "token", "above", "times"],
        )


def templates(pages: DataFrame) -> DataFrame:
    """host and the tokens of its template: those of large classes that stand on most pages, elements nested in one another.

    Pages without tokens, as null and empty ones, do not count.  A template has at most 4/3 of the tokens of a mean page.
    """
    rows = pages.mapInArrow(_tokens, "host string, page long, token long, above long, times long")
    least = [F.min(F.xxhash64(F.lit(i), "page", "times")).alias(f"least{i}") for i in range(SAMPLES)]
    vectors = rows.groupBy("host", "token").agg(F.count(F.lit(1)).alias("n"), *least, F.min("above").alias("above"))
    vectors = stored(vectors.where(F.col("n") >= SUPPORT * FEWEST_PAGES), "html-vectors")
    hosts = vectors.where("token = 0").select("host", F.col("n").alias("pages")).where(F.col("pages") >= FEWEST_PAGES)
    most = vectors.where("token <> 0").join(hosts, "host").where(F.col("n") >= SUPPORT * F.col("pages"))
    shared = F.posexplode(F.array(*(f"least{i}" for i in range(SAMPLES)))).alias("sample", "least")
    classed = stored(most.select("host", "token", "above", shared), "html-samples")
    large = classed.groupBy("host", "sample", "least").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= LARGE).drop("size")
    valid = classed.join(large, ["host", "sample", "least"], "left_semi").select("host", "token", "above").distinct()
    valid = stored(valid, "html-classes")
    nested = valid.join(valid.select("host", F.col("token").alias("above")), ["host", "above"], "left_semi")
    nested = nested.unionByName(valid.where("above = 0"))
    return nested.groupBy("host").agg(F.collect_list("token").alias("template"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, frozenset[int]] = {}
    for b in batches:
        out = []
        for p, h, t in zip(b.column("html"), b.column("host").to_pylist(), b.column("template")):
            if h not in known:
                if len(known) > 1000:
                    known.clear()
                known[h] = frozenset(x % (1 << 64) for x in t.as_py() or ())
            out.append(main_text(p.as_py(), known[h]))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text: one row per row of ``pages``; a null or empty page, or one without main text, has the empty text.

    Pages whose address has no host are one host.  Rows of one page_id are pages of their own.  An empty table stays empty; other
    columns are ignored and may have any name.
    """
    host = F.lower(F.regexp_extract(F.coalesce(pages["url"], F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(pages["page_id"], pages["url"], whole(pages["html"]).alias("html"), host.alias("host"))
    keyed = rows.select("host", F.xxhash64("page_id", "url").alias("page"), "html")
    found = stored(templates(keyed), "html-templates")
    size = found.agg(F.count(F.lit(1)).alias("hosts"), F.max(F.size("template")).alias("longest")).first()
    if size["hosts"] <= BROADCAST_HOSTS and (size["longest"] or 0) <= LONGEST_TEMPLATE:
        found = F.broadcast(found)
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.join(found, "host", "left").select("page_id", "url", "html", "host", "template").mapInArrow(
        _texts, f"page_id {kind}, url string, text string"
    )
