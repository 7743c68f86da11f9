"""Registered queries of the operators, one each, and the SQL that must give the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, divergence, exact, html, leaks, licences, lines, minhash, packing, passages, quality, spelling


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that an earlier line is nearly equal to."""
    return lines.duplicate_lines(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train(docs))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs.select("doc_id", "text"), quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeated(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(table(spark, sf_dir, "documents"), exact.DigestIndex.fresh(spark))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as token ids, and as the text that these give back."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of each language against each other and against the whole language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts with the spelling that each is a variant of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_packing": op6_packing,
    "op7_html_extraction": op7_html_extraction,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_bpe": op11_bpe,
    "op12_source_divergence": op12_source_divergence,
    "op13_spelling_variants": op13_spelling_variants,
}

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op1_line_dedup": r"""
WITH l AS (
  SELECT doc_id, CAST(k - 1 AS BIGINT) AS line_no, trim(w[k], chr(9) || chr(11) || chr(12) || chr(13) || ' ') AS line
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents))),
-- levenshtein() counts bytes: characters of more than one are replaced by control characters, of which no text has any
wide AS (SELECT coalesce(string_agg(DISTINCT c, '' ORDER BY c), '') AS c FROM (SELECT unnest(regexp_extract_all(line, '[^\x00-\x7F]')) AS c FROM l)),
narrow AS (SELECT string_agg(chr(CAST(k AS INTEGER)), '' ORDER BY k) AS c FROM (SELECT unnest(list_concat(range(1, 9), range(14, 32))) AS k)),
t AS (
  SELECT line, min({'d': doc_id, 'n': line_no}) AS first, length(line) AS n, translate(line, any_value(wide.c), any_value(narrow.c)) AS bytes
  FROM l, wide, narrow WHERE line <> '' GROUP BY line),
near AS (
  SELECT a.line, min(b.first) AS near
  FROM t a JOIN (SELECT *, unnest(range(n - 2, n + 3)) AS m FROM t WHERE n >= 20) b ON a.n = b.m AND b.first < a.first
  WHERE a.n >= 20 AND levenshtein(a.bytes, b.bytes) <= 2 GROUP BY a.line)
SELECT DISTINCT doc_id, line_no
FROM l JOIN t USING (line) LEFT JOIN near USING (line)
WHERE {'d': doc_id, 'n': line_no} > least(first, coalesce(near, first))
""",
    "op3_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(w, k, k + 9) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM win),
grams AS (
  SELECT doc_id, k, n, list_slice(w, k, k + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, k, n, item_id FROM grams JOIN win USING (win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op9_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
""",
    "op10_minhash_near_dedup": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) END) AS s FROM w),
same AS (SELECT s, min(doc_id) AS node FROM (SELECT doc_id, list_sort(s) AS s FROM sh) WHERE len(s) > 0 GROUP BY s),
ex AS (SELECT node, len(s) AS n, unnest(s) AS g FROM same),
pairs AS (
  SELECT a.node AS a, b.node AS b FROM ex a JOIN ex b ON a.g = b.g AND a.node < b.node AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT node AS a, node AS b FROM same UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
comp AS (SELECT a AS node, min(b) AS component_id FROM reach GROUP BY a)
SELECT sh.doc_id, CAST(len(sh.s) AS BIGINT) AS n_shingles, coalesce(component_id, sh.doc_id) AS component_id,
       coalesce(component_id, sh.doc_id) = sh.doc_id AS kept
FROM sh LEFT JOIN same ON list_sort(sh.s) = same.s LEFT JOIN comp USING (node)
""",
    "op12_source_divergence": rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_FOLD}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
occ AS (SELECT row_id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM occ GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3),
langs AS (SELECT lang, count(*) AS v, CAST(sum(lang_n) AS BIGINT) AS n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS n FROM occ JOIN kept USING (lang, term) GROUP BY lang, source, term),
tot AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS n FROM cnt GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000 * (coalesce(c.n, 0) + 1) // (coalesce(t.n, 0) + l.v) AS p,
         1 + 1000000000 * (k.lang_n + 1) // (l.n + l.v) AS q
  FROM grp g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN tot t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
priced AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
""",
}
