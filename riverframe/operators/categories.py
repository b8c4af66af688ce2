"""Categories of any number: one sparse block instead of one column per category.

A category's place is its rank in alphabetical order, found by ranges: the distinct values are cut into key ranges, each is ordered on
its own, and only one row per range is ordered across all. The table of categories (one row each, with its share of the rows) stays a
table: it is joined to the rows, measured first, so that few categories are broadcast and many are joined by shuffle, where a hot
one is split. Rows carry the place alone (:data:`INDEX`); the block of 0/1 columns that it stands for is spelled out where it is needed:

* :func:`one_hot_sparse` as (size, indices, values), scaled if asked. Scaling a 0/1 column moves its zeros to ``-mean / scale``, for
  every row alike, so the block holds what the hot column differs by, ``1 / scale``, and the moved zeros are a column of the table.
* :func:`sparse_features` as the sparse vector that Spark ML reads, behind the dense features;
* an injected model gets the places beside its sequences, as an embedding layer takes them.

Rows without a key, and keys that the table does not have, have no place: an empty block.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverframe.operators.joins import join_groups
from riverframe.operators.ordered import ranges_of
from riverframe.operators.settle import settle

INDEX = "loc_index"
SCHEMA = "category string, index int, n bigint, mean double, scale double, cold double"


@dataclass(frozen=True)
class Categories:
    """``table``: category, index, n (its rows), and the scaler of its 0/1 column: mean, scale, cold (a scaled zero)."""

    table: DataFrame
    size: int

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)


def load_categories(spark: SparkSession, path: str) -> Categories:
    table = spark.read.schema(SCHEMA).parquet(path)
    return Categories(table, table.count())


def fit_categories(df: DataFrame, c: str) -> Categories:
    """All values of a column in alphabetical order, with their shares of all rows (rows without a value count, and are cold)."""
    counts = df.groupBy(F.col(c).cast("string").alias("category")).agg(F.count("*").alias("n"))
    counts = settle(counts, "category-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    places, size = ranges_of(counts.filter(F.col("category").isNotNull()).withColumn("__one", F.lit(1)), "category", "__one")
    mean = F.col("n") / F.lit(max(total, 1))
    deviation = F.sqrt(mean * (1 - mean))
    table = places.select("category", F.col("__before").cast("int").alias("index"), "n", mean.alias("mean"), F.when(deviation == 0, 1.0).otherwise(deviation).alias("scale"))
    return Categories(settle(table.withColumn("cold", -F.col("mean") / F.col("scale")), "categories"), size)


def with_index(df: DataFrame, c: str, categories: Categories, out: str = INDEX) -> DataFrame:
    """The place of each row's category; NULL without one."""
    known = categories.table.select(F.col("category").alias("__category"), F.col("index").alias(out))
    named = df.drop(out).withColumn("__category", F.col(c).cast("string"))
    return join_groups(named, known, ["__category"], measured=True).drop("__category")


def one_hot_sparse(df: DataFrame, c: str, categories: Categories, out: str | None = None, scaled: bool = False) -> DataFrame:
    """The block of 0/1 columns as a struct (size, indices, values). ``scaled`` holds what the hot column differs by from a scaled zero."""
    known = categories.table.select(F.col("category").alias("__category"), F.col("index").alias("__index"), (1 / F.col("scale") if scaled else F.lit(1.0)).alias("__hot"))
    held = join_groups(df.withColumn("__category", F.col(c).cast("string")), known, ["__category"], measured=True)
    return held.withColumn(out or f"{c}_hot", _block(F.lit(categories.size), F.col("__index"), F.col("__hot"))).drop("__category", "__index", "__hot")


def _block(size: Column, index: Column, value: Column) -> Column:
    empty = F.struct(size.alias("size"), F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("values"))
    hot = F.struct(size.alias("size"), F.array(index).alias("indices"), F.array(value.cast("double")).alias("values"))
    return F.when(index.isNull(), empty).otherwise(hot)


def sparse_features(df: DataFrame, dense: str, width: int, size: int, index: str = INDEX, out: str = "features") -> DataFrame:
    """Dense values (an array of ``width``) and the place of the category as one sparse vector of ``width + size``.

    A vector is stored as (type, size, indices, values); the rows are written in that form and read as vectors, as no
    built-in function makes sparse ones.
    """
    from pyspark.ml.linalg import VectorUDT

    rest = [c for c in df.columns if c not in (out, dense)]
    places = F.sequence(F.lit(0), F.lit(width - 1)) if width else F.array().cast("array<int>")
    hot = F.col(index).isNotNull()
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(width + size).alias("size"),
        F.when(hot, F.concat(places, F.array(F.lit(width) + F.col(index)))).otherwise(places).alias("indices"),
        F.when(hot, F.concat(F.col(dense), F.array(F.lit(1.0)))).otherwise(F.col(dense)).alias("values"),
    )
    stored = settle(df.select(*rest, vector.alias(out)), "sparse")
    schema = T.StructType([f if f.name != out else T.StructField(out, VectorUDT()) for f in stored.schema.fields])
    return df.sparkSession.read.schema(schema).parquet(*stored.inputFiles())


def cold_sum(categories: Categories, weights: DataFrame | None = None) -> float:
    """What the scaled zeros of the block add to a linear model: the sum of ``cold * weight`` over (category, weight) rows."""
    table = categories.table if weights is None else categories.table.join(weights, "category")
    product = F.col("cold") if weights is None else F.col("cold") * F.col("weight")
    return table.agg(F.sum(product)).first()[0] or 0.0


def feature_order(features: Sequence[str], prefix: str = "loc") -> list[str]:
    """The model's feature order: the dense ones, then the block as one entry."""
    return [*features, f"{prefix}[*]"]
