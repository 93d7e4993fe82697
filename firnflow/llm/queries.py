"""One registered query per operator, over its whole table, and comparison SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnflow.llm import (
    collocations, embedding_dedup, exact_dedup, filter_audit, html_text, language, line_dedup, minhash_dedup, packing, pii, piece_bpe, sharding, warc,
)
from firnflow.llm.common import table, whole
from firnflow.session import shared_folder


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.detected(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "scores")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicated(table(spark, sf_dir, "embeddings"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.encode(whole("text"), "UTF-8")).alias("text_crc32"))
    rows = sharding.sharded(docs)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.classes(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_text.extracted(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = language.fitted(docs.where(~language.held_out()))
    return language.predicted(docs, learned, docs["doc_id"], language.held_out().alias("held_out"))


def op8_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return piece_bpe.digests(piece_bpe.encoded(docs, public_tokenizers.path("piece_bpe_32k.model")))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.grouped(table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = shared_folder(spark, "warc")
    warc.written(pages, folder)
    kind = pages.schema["page_id"].dataType
    rows = warc.read(spark, folder, payloads=False)
    return rows.select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (op1_pii, op2_embedding_dedup, op3_sharding, op4_minhash_dedup, op5_line_dedup, op6_html_text, op7_language, op8_piece_bpe, op9_packing,
              op10_exact_dedup, op11_warc, op12_collocations, op13_filter_audit)
}

ORACLES = {
    "op2_embedding_dedup": r"""
        WITH RECURSIVE usable AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND NOT list_contains(embedding, NULL)
              AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
              ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98
        ), reach(node, low) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.low FROM reach r JOIN links l ON r.node = l.a
        ), parts AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(c.n, 0) AS n_links, p.component_id, e.vec_id = p.component_id AS kept
        FROM embeddings e JOIN parts p ON p.node = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id""",
    "op4_minhash_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
            FROM words
        ), items AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.h = b.h AND a.doc_id <> b.doc_id
             AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reach(node, low) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.low FROM reach r JOIN links l ON r.node = l.a
        ), parts AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, p.component_id, s.doc_id = p.component_id AS kept
        FROM sets s JOIN parts p ON p.node = s.doc_id""",
    "op5_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), keyed AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), repeats AS (
            SELECT key, max(doc_id) AS keep_id FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), judged AS (
            SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND r.keep_id <> k.doc_id AS gone
            FROM keyed k LEFT JOIN repeats r ON k.key = r.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op10_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
               sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op11_warc": r"""
        WITH p AS (
            SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
                   row_number() OVER w AS nth, first_value(page_id) OVER w AS first
            FROM pages WINDOW w AS (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST)
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND nth > 1 AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND nth > 1 THEN first END AS refers_to
        FROM p""",
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), words AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
        ), places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
        ), f AS (
            SELECT lang, k AS size, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM places, range(1, 6) r(k)
            WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
        ), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
        ), split AS (SELECT *, string_split(phrase, ' ') AS w FROM f
        ), inside AS (
            SELECT lang, array_to_string(w[s:s + k - 1], ' ') AS phrase, max(a) AS longer FROM split, range(2, 5) r(k), range(1, 5) p(s)
            WHERE k < size AND s + k - 1 <= size GROUP BY ALL
        ), cuts AS (
            SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, n, CAST(1000 * CAST(c.a AS HUGEINT) * n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
            FROM split c JOIN totals USING (lang) LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
            JOIN range(1, 5) q(k) ON k < c.size
            JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.size], ' ')
            WHERE c.size > 1 AND NOT coalesce(100 * longer >= 100 * c.a, false)
        ), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
        FROM lowest QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000""",
    "op13_filter_audit": r"""
        WITH words AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), known AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
        ), failed AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   {'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w),
                    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), 'D': regexp_matches(t, '[#$%&*|]'),
                    'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS f
            FROM words LEFT JOIN known USING (doc_id)
        ), marks AS (
            SELECT part, CASE WHEN f['A'] THEN 'A' ELSE '' END || CASE WHEN f['B'] THEN 'B' ELSE '' END || CASE WHEN f['C'] THEN 'C' ELSE '' END
                   || CASE WHEN f['D'] THEN 'D' ELSE '' END || CASE WHEN f['E'] THEN 'E' ELSE '' END AS fails,
                   count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
            FROM failed GROUP BY ALL
        ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
        ), orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[1:step - 1] AS before
                     FROM orders, range(1, 6) r(step)
        ), found AS (
            SELECT part, filter_order, step, own,
                   sum(n) FILTER (fails = '' OR translate(fails, before || own, '') = fails) AS kept,
                   sum(n) FILTER (contains(fails, own) AND translate(fails, before, '') = fails) AS removed,
                   sum(n) FILTER (contains(fails, own) AND translate(fails, before, '') <> fails) AS redundant,
                   sum(n) FILTER (fails = own) AS unique_fails,
                   sum(good) FILTER (contains(fails, own) AND translate(fails, before, '') = fails) AS good_lost,
                   sum(toxic) FILTER (contains(fails, own) AND translate(fails, before, '') = fails) AS toxic_lost
            FROM marks, steps GROUP BY ALL
        )
        SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
               CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
               CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
               CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
        FROM found""",
}
