"""Table, artifact and metric readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverframe.operators.scaling import STATS_SCHEMA
from riverframe.operators.select import floats_nan_to_null, require_columns


def read_table(
    spark: SparkSession, path: str, schema: str | None = None, fmt: str = "csv", nan_to_null: bool = True
) -> DataFrame:
    """CSV with a header and a given schema, or Parquet. A missing path fails at once in Spark."""
    reader = spark.read.schema(schema) if schema else spark.read
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV read needs a schema; inferring one scans the data twice")
        # enforceSchema off: a file whose header does not match the schema is an error.
        df = reader.option("header", True).option("enforceSchema", False).csv(path)
    else:
        df = reader.format(fmt).load(path)
    return floats_nan_to_null(df) if nan_to_null else df


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    dynamic: bool = False,
) -> None:
    """Write with one directory per partition value; ``dynamic`` replaces only the directories that ``df`` has rows for.

    The rebalance hint gathers each value into few files, yet lets AQE split a value that is far
    larger than the others, so one hot location is not written by one task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    elif sort_by:
        df = df.orderBy(*sort_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_metadata(df: DataFrame, path: str) -> None:
    """One-row run metadata as JSON."""
    df.limit(1).coalesce(1).write.mode("overwrite").json(path)


def write_feature_list(spark: SparkSession, features: Sequence[str], path: str) -> None:
    rows = [(i, f) for i, f in enumerate(features)]
    spark.createDataFrame(rows, "position int, feature string").coalesce(1).write.mode("overwrite").json(path)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.schema("position int, feature string").json(path).orderBy("position").collect()
    return [r["feature"] for r in rows]


def save_stats(stats: DataFrame, path: str) -> None:
    stats.write.mode("overwrite").parquet(path)


def load_stats(spark: SparkSession, path: str, expect: Sequence[str] | None = None) -> DataFrame:
    """Scaler statistics, checked against the feature list they must serve (one row per feature)."""
    stats = spark.read.schema(STATS_SCHEMA).parquet(path)
    if expect is not None:
        have = {r["feature"] for r in stats.select("feature").collect()}
        if have != set(expect):
            raise ValueError(f"scaler statistics do not fit the features: differ in {sorted(have ^ set(expect))}")
    return stats


METRICS = "Model string, Accuracy double, Precision double, Recall double, `F1-Score` double"


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A model comparison as :func:`write_metrics` wrote it."""
    return read_table(spark, path, METRICS)


def write_metrics(df: DataFrame, path: str) -> None:
    """Model comparison, one row per model."""
    require_columns(df, ["Model", "Accuracy", "Precision", "Recall", "F1-Score"])
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def order_report(spark: SparkSession, path: str, sort_by: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """One row per file of a Parquet table: its directory's values, name, rows, first and last key, and whether its rows, as they
    lie in the file, are sorted by ``sort_by``. A file is looked at by one task, as it was written by one."""
    key = F.struct(*sort_by)
    rows = spark.read.parquet(path).select(*partition_by, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("__at"), key.alias("__key"))
    before = F.lag("__key").over(Window.partitionBy(*partition_by, "file").orderBy("__at"))
    return (
        rows.withColumn("__ok", F.coalesce(before <= F.col("__key"), F.lit(True)))
        .groupBy(*partition_by, "file")
        .agg(F.count("*").alias("n_rows"), F.min_by("__key", "__at").alias("first"), F.max_by("__key", "__at").alias("last"), F.every("__ok").alias("sorted"))
    )


def order_summary(report: DataFrame, sort_by: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """One row per directory (or one in all) of an order report: rows, first and last key, whether every file is sorted, and whether
    the files in the order of their names follow one another without overlap."""
    by_name = (Window.partitionBy(*partition_by) if partition_by else Window.partitionBy(F.lit(0))).orderBy("file")
    apart = F.coalesce(F.lag("last").over(by_name) <= F.col("first"), F.lit(True))
    held = report.withColumn("__apart", apart).groupBy(*partition_by).agg(
        F.sum("n_rows").alias("n_rows"), F.min("first").alias("__first"), F.max("last").alias("__last"), F.every("sorted").alias("sorted"), F.every("__apart").alias("apart")
    )
    ends = [F.col(f"__{side}")[c].alias(f"{side}_{c}") for side in ("first", "last") for c in sort_by]
    return held.select(*partition_by, "n_rows", *ends, "sorted", "apart")
