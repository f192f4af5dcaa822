"""The registered queries of the operators: thin digests over the whole driver tables, and their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (fingerprints, lattice, licenses, lm, mixing, negatives, ngram_join, packing, secrets, token_counts, topk,
               toxicity, whitening)
from .tables import ensure_importable, table, text_or_empty


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    return token_counts.section_tokens(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens are words plus one end mark."""
    ensure_importable(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", (mixing.words(text_or_empty("text")) + 1).alias("n_tokens"))
    return packing.best_fit(docs)


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = topk.sign_codes(table(spark, sf_dir, "embeddings"))
    return topk.search(codes, codes.where(F.col("id") % 20 == 0))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    return lm.score(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    return negatives.mine(table(spark, sf_dir, "embeddings"), label=negatives.shifted_label())


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_importable(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_topk_search": op3_topk_search,
    "op4_secret_scan": op4_secret_scan,
    "op5_toxicity": op5_toxicity,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_license_scan": op7_license_scan,
    "op8_source_mixing": op8_source_mixing,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_document_fingerprints": op13_document_fingerprints,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_topk_search": topk.ORACLE_SQL,
        "op4_secret_scan": secrets.ORACLE_SQL,
        "op6_ngram_jaccard_join": ngram_join.ORACLE_SQL,
        "op7_license_scan": licenses.oracle_sql(),
        "op8_source_mixing": mixing.oracle_sql(),
        "op11_hard_negatives": negatives.ORACLE_SQL,
    }
