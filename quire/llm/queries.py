"""The queries op1 to op10 over the driver's tables, their DuckDB SQL where there is one, and where the tables are."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, decontaminate, fingerprint, jaccard, kneser_ney, langid, licenses, quality, secrets, toxicity

TOKENIZER = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, with_ids=False, with_decoded=False)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 8, with_offsets=False)
    n_items = F.size("items").cast("long")
    return found.select("doc_id", "n_words", "n_hit", n_items.alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_items >= 2).alias("contaminated"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(F.col("lang").isNotNull() & (langid.in_fold() != 0)))
    return langid.predict(docs, model, keep=["doc_id"]).select("doc_id", F.coalesce(langid.in_fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(table(spark, sf_dir, "documents"), 4, 85)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_candidates", F.size("secrets").cast("long").alias("n_secrets"), F.sha2(F.array_join("secrets", ","), 256).alias("secrets_sha256"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = langid.in_fold()
    scored = kneser_ney.train_and_score(table(spark, sf_dir, "documents"), F.coalesce(fold != 1, F.lit(True)))
    return scored.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_byte_bpe, op2_decontamination, op3_language_id, op4_toxicity, op5_ngram_jaccard_join, op6_license_scan, op7_secret_scan, op8_lm_score, op9_quality, op10_fingerprints)
    return {f.__name__: f for f in own}


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = rf"""
WITH item AS (SELECT item_id, regexp_extract_all({_LOW}, '{decontaminate.WORD}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(8, len(w)) AS size, array_to_string(w[i : i + least(8, len(w)) - 1], ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 7) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, regexp_extract_all({_LOW}, '{decontaminate.WORD}') AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
place AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, item_id, size, i FROM place JOIN win USING (size, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(len(items), 0) >= 2 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5_SQL = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
gram AS (SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, array_to_string(w[i : i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM doc WHERE len(w) >= 4)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') AS g FROM doc WHERE len(w) BETWEEN 1 AND 3)),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
reach(a, b) AS (SELECT doc_id, doc_id FROM doc UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(k, 0) AS n_links
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS k FROM link GROUP BY a) USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""


def op6_sql() -> str:
    marked = f"(SELECT doc_id, CASE WHEN regexp_matches(text, '{licenses.MARKS}') THEN text END AS text FROM documents)"
    ids = f"SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {licenses.ids_sql('text', 'lines', True)} END AS a, CASE WHEN text IS NULL THEN [] ELSE {licenses.ids_sql('text', 'joined', True)} END AS b FROM {marked}"
    return f"SELECT doc_id, CAST(len(a) AS BIGINT) AS n_sentences, array_to_string(a, ',') AS sentence_ids, array_to_string({licenses.licences_sql('a', 'b', True)}, ',') AS licenses FROM ({ids})"


def op7_sql() -> str:
    sql = secrets.findings_sql("coalesce(text, '')", "coalesce(source, '')", secrets.train_forest(), True)
    first = f"SELECT doc_id, text, {sql['cand']} AS cand, source FROM documents"
    second = f"SELECT doc_id, text, cand, {sql['scored']} AS scored FROM ({first})"
    third = f"SELECT doc_id, len(cand) AS n_candidates, list_concat({sql['secrets']}, regexp_extract_all(coalesce(text, ''), '{secrets.BLOCK}')) AS secrets FROM ({second})"
    return f"SELECT doc_id, CAST(n_candidates AS BIGINT) AS n_candidates, CAST(len(secrets) AS BIGINT) AS n_secrets, sha256(array_to_string(secrets, ',')) AS secrets_sha256 FROM ({third})"


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op5_ngram_jaccard_join": OP5_SQL, "op6_license_scan": op6_sql(), "op7_secret_scan": op7_sql()}
