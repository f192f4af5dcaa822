"""A training-data pipeline over ``documents``: toxic documents go, one document of each near-duplicate group stays,
live secrets are masked, sources are mixed to target weights, and the rest is packed into sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs. All but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import mixing, ngram_join, packing, secrets, toxicity
from stratum.llm.tables import cut, ensure_importable, table, text_or_empty


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.7 stay; the model learns from the training third of ``labels``."""
    ensure_importable(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a 5-word-shingle similarity of 0.8 the smallest doc_id stays."""
    ensure_importable(spark)
    return ngram_join.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets that are not widely copied examples are masked in the text."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins of 512 to 8192 tokens (words and one end mark per document)."""
    ensure_importable(spark)
    return packing.best_fit(docs.select("doc_id", (mixing.words(text_or_empty("text")) + F.lit(1)).alias("n_tokens")))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_duplicates), ("secret_scan", mask_secrets),
          ("source_mixing", mix_sources), ("best_fit_packing", pack_sequences)]

#: SQL cannot express the learned toxicity score and the packing; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
