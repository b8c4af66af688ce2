"""The corpus pipeline: raw documents in, a mixing plan of clean, distinct documents out.

Every stage takes the documents that its predecessor kept and decides on all of them: documents in no known
language go, documents of low quality go, one document of each group of near copies stays, documents
that hold a benchmark item go, and what is left is given its place in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverframe.llm import decontam, langid, mixing, ngram_join, quality
from riverframe.llm.tables import table
from riverframe.operators.settle import settle


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_first(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.plan(docs)


STAGES = [("language_id", language), ("quality", good), ("ngram_join", distinct), ("decontamination", clean), ("mixing", mixture)]

#: No SQL trains the first two stages; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared checkpoint folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
