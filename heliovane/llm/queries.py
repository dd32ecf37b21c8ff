"""The text operators over the given tables, and SQL with the same result where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
import public_tokenizers

from heliovane.llm import alignment, contextmix, decontaminate, divergence, htmltext, langid, licenses, minhash, orctokens, sentencepieces, simhash, tokencounts, toxicity
from heliovane.llm.common import crc_remainder, table
from heliovane.session import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans", "items")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    docs, rest = table(spark, sf_dir, "documents"), crc_remainder(F.col("doc_id"), 5)
    sample = langid.labelled_sample(docs, rest > 0, "doc_id", "text", "lang")
    found = langid.identify(docs, sample)
    return found.select("doc_id", (rest == 0).alias("held_out"), "lang_pred", "score")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown."""
    return tokencounts.count_tokens(table(spark, sf_dir, "documents"), PIECES)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    return minhash.compare_with_edits(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return sentencepieces.round_trip(table(spark, sf_dir, "documents"), PIECES)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs, rest = table(spark, sf_dir, "documents"), crc_remainder(F.col("doc_id"), 4)
    return toxicity.fit_and_score(docs, table(spark, sf_dir, "labels"), rest != 2).select("doc_id", (rest == 2).alias("held_out"), "score", "predicted")


def op10_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32."""
    path = scratch_path(spark, "ids")
    orctokens.write_ids(table(spark, sf_dir, "documents"), path, WORDS)
    return orctokens.checked_rows(spark, path)


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte."""
    rest = crc_remainder(F.col("doc_id"), 5)
    scored = contextmix.score(table(spark, sf_dir, "documents"), rest != 1)
    return scored.select("doc_id", (rest == 1).alias("held_out"), *scored.columns[1:])


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return alignment.summarize(table(spark, sf_dir, "documents"), BYTES, PIECES)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, source, part, item, value, rank."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_text, op2_decontaminate, op3_license_scan, op4_language_id, op5_token_counts,
        op6_fingerprints, op7_simhash, op8_sentencepiece, op9_toxicity, op10_orc_tokens,
        op11_lm_scores, op12_token_alignment, op13_source_divergence,
    )
}

_FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_FOLDED.format("coalesce(text, '')"))

ORACLES = {
    "op2_decontaminate": rf"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, array_to_string(w[i : i + 9], ' ') AS phrase, len(w[i : i + 9]) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)),
hits AS (SELECT p.doc_id, p.i, p.n, windows.item_id FROM places p JOIN windows ON p.phrase = windows.phrase AND p.n = windows.n),
hit_words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op13_source_divergence": rf"""
WITH doc AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_FOLDED.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
tokens AS (SELECT d, lang, source, unnest(w) AS term FROM doc),
groups AS (SELECT DISTINCT lang, source FROM doc),
kept AS (SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT d) >= {divergence.MIN_DOCS}),
found AS (SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY lang, source, term),
terms AS (SELECT g.lang, count(term) AS v, coalesce(sum(total), 0) AS whole FROM (SELECT DISTINCT lang FROM groups) g LEFT JOIN kept USING (lang) GROUP BY g.lang),
sizes AS (SELECT g.lang, g.source, coalesce(sum(n), 0) + any_value(v) AS size FROM groups g JOIN terms USING (lang) LEFT JOIN found USING (lang, source) GROUP BY g.lang, g.source),
shares AS (
  SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n, 1 + {divergence.SCALE}::HUGEINT * (coalesce(n, 0) + 1) // s.size AS p,
         1 + {divergence.SCALE}::HUGEINT * (k.total + 1) // (t.whole + t.v) AS q
  FROM sizes s JOIN kept k USING (lang) JOIN terms t USING (lang) LEFT JOIN found f ON f.lang = s.lang AND f.source = s.source AND f.term = k.term),
term_part AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value,
         row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // q DESC, term) AS rank
  FROM shares WHERE n > 0 AND p > q),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pair_part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value,
         row_number() OVER (PARTITION BY a.lang, a.source ORDER BY coalesce(value, 0) DESC, b.source) AS rank
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM pair_part
UNION ALL
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM term_part WHERE rank <= {divergence.TOP_TERMS}""",
}
