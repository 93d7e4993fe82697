"""Archives, phrases and the filter audit against plain loops; null, empty, repeated, long and oddly named input."""

import collections
import gzip
import hashlib
import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnflow.llm import collocations, filter_audit, warc
from firnflow.session import shared_folder

PAGE = "page_id long, url string, html string, payload string, digest int, shard string, target int"
DOC = "doc_id long, text string, lang string, source string, key int, mask string, n string, word int, first string"
LABEL = "doc_id long, quality int, toxic int, mask int, good string"


# ---- archives


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "y", 2) for i, u, h in rows], PAGE)


LONG = "<p>long text</p>" * 20
PAGES = [
    (1, "http://a.example/1", LONG), (2, None, LONG), (3, "http://a.example/3 x\r\ny", LONG + "é😀"), (4, "u", None), (5, "u", ""), (6, "", "short"),
    (7, "u", "short"), (7, "u", "short"), (8, "u", "b" * 99), (9, "u", "b" * 99), (10, "u", "c" * 100), (11, "u", "c" * 100), (None, "u", "c" * 100),
    (None, "u", "d" * 200), (None, "v", "d" * 200), (12, "u", LONG), (12, "u", LONG), (1, "other", LONG), (13, "u", "WARC/1.1\r\n\r\n" * 50),
    (14, "u", "x y\n" * 300_000),
]


def expected(rows):
    groups = collections.defaultdict(list)
    for i, _, h in rows:
        groups[(h or "").encode()].append(i)
    out = []
    for payload, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        for nth, i in enumerate(known + [None] * (len(ids) - len(known))):
            revisit = len(payload) >= 100 and nth > 0 and bool(known)
            out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", known[0] if revisit else None))
    return sorted(out, key=str)


def archived(spark, rows, **options):
    folder = shared_folder(spark, "warc-test")
    manifest = warc.written(pages(spark, rows).repartition(3), folder, **options)
    got = warc.read(spark, folder).collect()
    return folder, manifest, got


def number(text):
    return None if text is None else int(text)


def test_warc(spark):
    folder, manifest, got = archived(spark, PAGES)
    assert sorted(((number(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in got), key=str) == expected(PAGES)
    texts = {hashlib.sha256((h or "").encode()).hexdigest(): h or "" for _, _, h in PAGES}
    assert all(bytes(r.payload).decode() == texts[r.payload_digest] for r in got if r.record_type == "response")
    assert {r.url for r in got if r.page_id == "2"} == {None} and {r.url for r in got if r.page_id == "3"} == {"http://a.example/3%20x%0D%0Ay"}
    for r in manifest.collect():
        with open(f"{folder}/{r.name}", "rb") as f:
            raw = f.read()
        assert (len(raw), hashlib.sha256(raw).hexdigest()) == (r.bytes, r.sha256)
        text = gzip.decompress(raw)
        assert text.count(b"WARC/1.1\r\nWARC-Type: ") == r.records + 1 and text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_warc_is_the_same_every_time(spark):
    rows = [(i, f"http://h/{i}", f"{i % 700} " * 80) for i in range(2000)]
    options = {"roll_bytes": 20_000, "shard_bytes": (40_000, 40_000)}
    made = []
    for parts in (1, 7):
        folder = shared_folder(spark, "warc-test")
        files = warc.written(pages(spark, rows).repartition(parts, "url"), folder, **options).collect()
        made.append(sorted((r.name, r.shard, r.part, r.records, r.bytes, r.sha256) for r in files))
    assert made[0] == made[1] and len({m[1] for m in made[0]}) > 3 and max(m[2] for m in made[0]) > 0
    assert sum(m[3] for m in made[0]) == 2000
    shards = warc.read(spark, folder, payloads=False).select(F.col("page_id").cast("long"), "refers_to").collect()
    assert {int(r.refers_to) for r in shards if r.refers_to} == set(range(700))


def test_warc_rename_runs_twice(spark, tmp_path):
    import pyarrow as pa

    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.1").write_bytes(b"xyz")
    rows = [pa.RecordBatch.from_pydict({"name": ["a"], "temporary": ["a.1"], "bytes": [3]})]
    for _ in range(2):
        assert [b.num_rows for b in warc._rename(iter(rows), str(tmp_path / "t"), str(tmp_path))] == [1]
    assert (tmp_path / "a").read_bytes() == b"xyz"
    (tmp_path / "a").unlink()
    with pytest.raises(FileNotFoundError):
        list(warc._rename(iter(rows), str(tmp_path / "t"), str(tmp_path)))


def test_warc_empty(spark):
    _, manifest, got = archived(spark, [])
    assert manifest.count() == 0 and got == []


def test_warc_damage(spark):
    folder, manifest, _ = archived(spark, PAGES[:3])
    path = f"{folder}/{manifest.first().name}"
    with open(path, "rb") as f:
        text = gzip.decompress(f.read())
    with open(path, "wb") as f:
        f.write(gzip.compress(text.replace(b"long", b"Long", 1)))
    with pytest.raises(Exception, match="does not fit its digest"):
        warc.read(spark, folder).count()


# ---- phrases


def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 1, "m", "n", 2, "f") for i, (g, t) in enumerate(rows)], DOC)


def by_hand(rows, least, longest, best):
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[(lang, *words[i : i + k])] += 1
    frequent = {p: n for p, n in counts.items() if n >= least}
    out = collections.defaultdict(list)
    for (lang, *words), a in frequent.items():
        k = len(words)
        if k < 2:
            continue
        if any(f >= a for (g, *w), f in frequent.items() if g == lang and len(w) > k and any(w[i : i + k] == words for i in range(len(w) - k + 1))):
            continue
        cuts = [(counts[(lang, *words[:j])], counts[(lang, *words[j:])]) for j in range(1, k)]
        score, _, left, right = min((1000 * a * totals[lang] // (x * y), j, x, y) for j, (x, y) in enumerate(cuts))
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return [
        (lang, rank, p.decode(), -a, left, right, totals[lang], -s)
        for lang, found in sorted(out.items())
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1)
    ]


def prose(seed, n):
    rng = np.random.default_rng(seed)
    words = np.array(["aa", "bB", "c", "d", "é", "ﬁ", "zz", "Zz", "日本", "\x1c", "x\x00", "long" * 50])
    marks = np.array([" ", " ", " ", "\t ", ". ", "\n", "  ", "!", "\x0b", "\x85", "\xa0"])
    picked = words[np.minimum(rng.zipf(1.6, n) - 1, len(words) - 1)]
    return "".join(w + m for w, m in zip(picked, marks[rng.integers(0, len(marks), n)]))


TEXTS = [("en", prose(1, 3000)), ("en", prose(2, 3000)), (None, prose(3, 2000)), ("und", "aa bb aa bb " * 300), ("de", "aa aa aa aa aa aa " * 30),
         ("de", None), ("fr", ""), ("fr", " .,\n"), ("en", "one"), ("de", "same words here. " * 50), ("de", "same words here. " * 50)]


@pytest.mark.parametrize("least, longest, best", [(20, 5, 2000), (5, 4, 7), (100, 2, 2000), (10_000, 5, 10)])
def test_collocations(spark, least, longest, best):
    got = collocations.collocations(docs(spark, TEXTS).repartition(3), least, longest, best)
    assert sorted(map(tuple, got.collect())) == by_hand(TEXTS, least, longest, best)


def test_collocations_with_small_arrays_and_tries(spark, monkeypatch):
    monkeypatch.setattr(collocations, "ROW_WORDS", 500)
    monkeypatch.setattr(collocations, "REMEMBERED", 8)
    # The functions run in workers of their own, so the limits are also tried here.
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": [g or "und" for g, _ in TEXTS], "text": [t or "" for _, t in TEXTS]})
    rows = pa.Table.from_batches(collocations._encoded(iter([batch, batch]), 0)).to_pylist()
    total = collections.Counter()
    for r in rows:
        if r["kind"] == "word":
            total[r["lang"]] += r["n"]
    n = {g: 2 * t for g, t in ((g, x[6]) for x in by_hand(TEXTS, 5, 2, 1) for g in [x[0]])}
    assert all(total[g] == t for g, t in n.items()) and sum(r["kind"] == "array" for r in rows) >= 10
    got = collocations.collocations(docs(spark, TEXTS), 5, 5, 2000, per_trie=3)
    assert sorted(map(tuple, got.collect())) == by_hand(TEXTS, 5, 5, 2000)


def test_collision_takes_another_seed(spark, monkeypatch):
    made, real = [], collocations.encoded

    def encoded(frame, seed=0):
        arrays, words = real(frame, seed)
        made.append(seed)
        return arrays, words if seed else words.withColumn("code", F.lit(7).cast("long"))

    monkeypatch.setattr(collocations, "encoded", encoded)
    assert sorted(map(tuple, collocations.collocations(docs(spark, TEXTS), 20).collect())) == by_hand(TEXTS, 20, 5, 2000)
    assert made == [0, 1]


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_trie(depth):
    rng = np.random.default_rng(depth)
    codes = np.concatenate([[0], rng.integers(1, 1 << 63, 400, dtype=np.uint64)]).astype(np.uint64)
    numbers = np.minimum(rng.zipf(1.3, 20_000), 400).astype(np.int32)
    numbers[::13] = 0
    numbers[-1] = 0
    windows = np.lib.stride_tricks.sliding_window_view(numbers, depth)
    whole = (windows > 0).all(1)
    some = np.unique(windows[whole][::3], axis=0)
    t = collocations.trie(codes[some])
    places, found = collocations.matches(t, numbers, codes)
    index = {tuple(p): i for i, p in enumerate(some.tolist())}
    assert list(zip(places.tolist(), found.tolist())) == [(i, index[tuple(w)]) for i, w in enumerate(windows.tolist()) if tuple(w) in index]


def test_collocations_empty(spark):
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, [("en", None), (None, "")]), 1).count() == 0


# ---- filter audit


def test_plain_changes():
    for n in range(1, 6):
        order, met = list(range(n)), [tuple(range(n))]
        for at in filter_audit.plain_changes(n):
            order[at], order[at + 1] = order[at + 1], order[at]
            met.append(tuple(order))
        assert len(met) == len(set(met)) == math.factorial(n)


def test_diagram():
    rng = np.random.default_rng(5)
    for k in (1, 2, 3, 5):
        weights = {m: (int(rng.integers(0, 3)), int(rng.integers(0, 2))) for m in range(1 << k) if m == 0 or rng.random() < 0.7}
        names = "ABCDE"[:k]
        got = {r[:2]: r[2:] for r in filter_audit.audited(weights, names)}
        assert len(got) == math.factorial(k) * k
        shapley = collections.Counter()
        for order in itertools.permutations(range(k)):
            for step, f in enumerate(order):
                shapley[f] += sum(w[0] for m, w in weights.items() if m >> f & 1 and not any(m >> g & 1 for g in order[:step]))
        for order in itertools.permutations(range(k)):
            left = dict(weights)
            for step, f in enumerate(order, 1):
                gone = {m: w for m, w in left.items() if m >> f & 1}
                left = {m: w for m, w in left.items() if not m >> f & 1}
                fails = sum(w[0] for m, w in weights.items() if m >> f & 1)
                removed = sum(w[0] for w in gone.values())
                alone = weights.get(1 << f, (0, 0))[0]
                row = (sum(w[0] for w in left.values()), removed, fails - removed, alone, sum(w[1] for w in gone.values()), shapley[f])
                assert got["".join(names[g] for g in order), step] == row
    assert len(filter_audit.Diagram({0: (1,), 3: (1,)}, 2).edges) == 5  # two terminals, two nodes of the second filter, the root


def failed(rows):
    """Masks of (doc_id, text, source) by plain Python."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t, source in rows:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        fails = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 bool(re.search("[#$%&*|]", t)), i is not None and i > first[t]]
        yield source or "", sum(f << n for n, f in enumerate(fails))


AUDITED = [
    (0, None, "a"), (1, "", "a"), (2, "", None), (3, " \t", ""), (4, " ".join(f"w{i}" for i in range(50)), "a"), (5, " ".join(f"w{i}" for i in range(49)), "a"),
    (6, "x " * 80, "b"), (7, "X " * 80, "b"), (8, "ÄÖ " * 80, "b"), (9, "a#" + " b" * 60, None), (4, " ".join(f"w{i}" for i in range(50)), "a"),
    (10, " ".join(f"w{i}" for i in range(50)), "c"), (None, "", "a"), (None, "lone", "c"), (11, "\x85 \x1c" * 40, "c"), (12, "x\n" * 400_000, "d"),
    (13, "x" * 95 + "A" * 5, "e"), (14, "x" * 94 + "A" * 6, "e"), (15, " ".join(["p"] * 35 + [f"q{i}" for i in range(64)]), "e"), (16, "same", "e"), (16, "other", "e"),
    (17, "other", "e"), (17, "same", "e"),
]


def test_failures(spark):
    frame = spark.createDataFrame([(i, t, "en", s, 1, "m", "n", 2, "f") for i, t, s in AUDITED], DOC).repartition(3)
    labels = spark.createDataFrame([(1, 1, None, 5, "g"), (1, 0, 1, 5, "g"), (4, 1, 0, 5, "g"), (99, 1, 1, 5, "g"), (None, 1, 1, 5, "g"), (6, None, 1, 5, "g")], LABEL)
    got = [tuple(r) for r in filter_audit.failures(frame, labels).select("part", "mask").collect()]
    assert sorted(got) == sorted(failed(AUDITED))
    marks = filter_audit.failures(frame, labels).where("good = 1 OR toxic = 1").select("part", "good", "toxic").collect()
    assert sorted(map(tuple, marks)) == [("a", 1, 0), ("a", 1, 0), ("a", 1, 1), ("b", None, 1)]
    rows = filter_audit.interactions(frame, labels).collect()
    assert len(rows) == 600 * len({p for p, _ in failed(AUDITED)})
    for part in {p for p, _ in failed(AUDITED)}:
        counts = collections.Counter(m for p, m in failed(AUDITED) if p == part)
        left = {r.filter_order: r.kept for r in rows if r.part == part and r.step == 5}
        assert set(left.values()) == {counts[0]} and len(left) == 120


def test_audit_empty(spark):
    frame = spark.createDataFrame([], DOC)
    assert filter_audit.interactions(frame, spark.createDataFrame([], LABEL)).count() == 0
    some = spark.createDataFrame([(1, "x", "en", "s", 1, "m", "n", 2, "f")], DOC)
    assert filter_audit.interactions(some, spark.createDataFrame([], LABEL)).count() == 600
