"""Small shared steps: fold tests, bounded samples by hash, guarded column picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts)


def hash_share(*cols: Column) -> Column:
    """A value in [0, 1) that depends on the columns alone, evenly spread."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def pick_text(df: DataFrame, *extra: str) -> DataFrame:
    """doc_id, text and ``extra`` alone: other columns, whatever they are called, play no part."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
