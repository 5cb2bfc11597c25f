"""A training-data pipeline over documents: language ID, near copies, decontamination, secrets, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quire.llm import _shared, bpe, decontaminate, jaccard, langid, secrets
from quire.llm.queries import TOKENIZER, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language classifier rejects go. It learns from documents outside its held-out fifth."""
    model = langid.train(docs.where(docs["lang"].isNotNull() & (langid.in_fold() != 0)))
    return langid.reject(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.8 on five-word shingles, the one with the smallest id stays."""
    return jaccard.drop_near_copies(docs, 5, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which windows of two benchmark items or more occur go; the windows of a single item are cut from the text."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every document stays."""
    return secrets.redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, with_decoded=False)


STAGES = [("language_id", language_id), ("near_copies", near_copies), ("decontamination", decontamination), ("secret_scan", secret_scan), ("byte_bpe", byte_bpe)]

#: Language ID and encoding have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = _shared.materialize(stage(spark, docs, sf_dir), name)
    return docs
