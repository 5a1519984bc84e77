"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import (chat, decontamination, hard_negatives, language, licenses, main_text, manifest, nearest, pieces, simhash,
                          suffix_dedup, token_files, toxicity)
from eventide.llm.tables import table
from eventide.session import durable_dir


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.withColumn("held_out", held_out).select("doc_id", "held_out", "score", "predicted", "worst")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train(table(spark, sf_dir, "documents"))
    return language.identify_pages(table(spark, sf_dir, "pages"), model).withColumnRenamed("id", "page_id")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_turns(table(spark, sf_dir, "conversations"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = durable_dir(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.checked(spark, folder)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest.certified(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_toxicity, op3_decontamination, op4_nearest, op5_language_id, op6_sentencepiece, op7_license_scan, op8_simhash_near_dedup, op9_chat_format, op10_token_files, op11_hard_negatives, op12_merkle_manifest, op13_main_text)}
_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE: dict[str, str] = {
    "op3_decontamination": f"""
WITH items AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
          FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                 FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, i, n FROM places JOIN windows USING (n, phrase)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM found))
        GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_hard_negatives": """
WITH rows_in AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
           CAST(coalesce(list_sum(list_transform(range(1, least(len(a.v), len(r.v)) + 1), lambda i: a.v[i] * r.v[i])), 0) AS BIGINT) AS score
    FROM rows_in a, rows_in r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM scored WHERE same)
    WHERE nth <= 5),
windows AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS nth
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
      AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM windows WHERE nth <= 5""",
    "op12_merkle_manifest": """
WITH RECURSIVE bytes AS (
    SELECT doc_id, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS codes
    FROM documents),
marked AS (
    SELECT doc_id, xor(list_reduce(list_prepend(4294967295, codes), lambda crc, code: list_reduce(
               list_prepend(xor(crc, code), range(8)),
               lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 7 = 0 AS hit
    FROM bytes),
parts AS (
    SELECT d.doc_id, d.lang, d.n_chars, hit,
           coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-')
               || coalesce(strlen(d.source) || ':' || d.source, '-')
               || coalesce(strlen(d.lang) || ':' || d.lang, '-') AS head,
           coalesce(strlen(d.text) || ':' || d.text, '-') AS tail
    FROM documents d JOIN marked USING (doc_id)),
leaves AS (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
           sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS other,
           hit, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
    FROM parts),
nodes AS (
    SELECT lang, 0 AS level, idx, n AS width, leaf AS hash FROM leaves
    UNION ALL
    SELECT lang, level + 1, idx // 2, (width + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
    FROM nodes WHERE width > 1 GROUP BY lang, level, idx // 2, width),
subroots AS (SELECT lang, hash, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
             FROM nodes WHERE width = 1),
tops AS (
    SELECT 0 AS level, idx, n AS width, hash FROM subroots
    UNION ALL
    SELECT level + 1, idx // 2, (width + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
    FROM tops WHERE width > 1 GROUP BY level, idx // 2, width),
steps AS (
    SELECT l.doc_id, o.level, l.idx >> o.level AS at, o.hash FROM leaves l
    JOIN (SELECT lang, level, idx, hash, width FROM nodes) o
      ON o.lang IS NOT DISTINCT FROM l.lang AND o.idx = xor(l.idx >> o.level, 1) AND o.width > 1
    UNION ALL
    SELECT l.doc_id, 1000 + o.level, s.idx >> o.level, o.hash FROM leaves l
    JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
    JOIN tops o ON o.idx = xor(s.idx >> o.level, 1) AND o.width > 1),
folds AS (
    SELECT doc_id, 0 AS level, idx, lang, n AS width, CASE WHEN hit THEN other ELSE leaf END AS hash FROM leaves
    UNION ALL
    SELECT f.doc_id, f.level + 1, f.idx // 2, f.lang, (f.width + 1) // 2,
           CASE WHEN o.hash IS NULL THEN sha256(f.hash) WHEN f.idx % 2 = 1 THEN sha256(o.hash || f.hash)
                ELSE sha256(f.hash || o.hash) END
    FROM folds f LEFT JOIN nodes o ON o.lang IS NOT DISTINCT FROM f.lang AND o.level = f.level AND o.idx = xor(f.idx, 1)
    WHERE f.width > 1),
top_folds AS (
    SELECT f.doc_id, 0 AS level, s.idx, s.n AS width, f.hash FROM folds f
    JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.width = 1
    UNION ALL
    SELECT f.doc_id, f.level + 1, f.idx // 2, (f.width + 1) // 2,
           CASE WHEN o.hash IS NULL THEN sha256(f.hash) WHEN f.idx % 2 = 1 THEN sha256(o.hash || f.hash)
                ELSE sha256(f.hash || o.hash) END
    FROM top_folds f LEFT JOIN tops o ON o.level = f.level AND o.idx = xor(f.idx, 1) WHERE f.width > 1),
proofs AS (SELECT doc_id, sha256(string_agg(hash, '' ORDER BY level)) AS proof FROM steps GROUP BY doc_id)
SELECT l.doc_id, l.leaf, s.hash AS subroot, r.hash AS root, coalesce(proof, sha256('')) AS proof_sha256,
       f.hash AS folded_root, f.hash = r.hash AS verified
FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
JOIN tops r ON r.width = 1 JOIN top_folds f ON f.doc_id = l.doc_id AND f.width = 1
LEFT JOIN proofs p ON p.doc_id = l.doc_id""",
}
