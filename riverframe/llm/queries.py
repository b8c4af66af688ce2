"""Registered queries of the training-data operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from riverframe.llm import decontam, hard_negatives, htmltext, langid, licenses, lloyd, mixing, ngram_join, oracles, packing, quality, tokencount, toxicity, vectors
from riverframe.llm.tables import table


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents"))
    # The digest is taken while the tokens are at hand, so that they need not be stored.
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("tokens")).drop("tokens"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0, label)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = lloyd.compress(table(spark, sf_dir, "embeddings"))
    digest = F.create_map(*[F.lit(x) for dim, book in coded.books.items() for x in (dim, book.digest())]) if coded.books else F.create_map(F.lit(0), F.lit(""))
    rows = lloyd.errors_by_label(coded.rows)
    return rows.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", digest[F.col("dim")].alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_vectors": op1_near_vectors,
    "op2_quality": op2_quality,
    "op3_token_counts": op3_token_counts,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_html_text": op8_html_text,
    "op9_ngram_join": op9_ngram_join,
    "op10_licenses": op10_licenses,
    "op11_packing": op11_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = oracles.ORACLES | ({} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL})
