"""Standard scaling with the population deviation, as stored statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverframe.operators.joins import with_row

STATS_SCHEMA = "feature string, mean double, scale double, var double, n bigint"


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, mean, scale, var, n)``: one pass for all columns; zero variance scales by 1."""
    pieces = [
        F.struct(
            F.lit(c).alias("feature"),
            F.avg(F.col(c).cast("double")).alias("mean"),
            F.var_pop(F.col(c).cast("double")).alias("var"),
            F.count(c).alias("n"),
        ).alias(f"__{i}")
        for i, c in enumerate(cols)
    ]
    row = df.agg(*pieces).select(F.explode(F.array(*[F.col(f"__{i}") for i in range(len(cols))])).alias("s"))
    scale = F.when(F.col("s.var") == 0, F.lit(1.0)).otherwise(F.sqrt("s.var"))
    return row.select("s.feature", "s.mean", scale.alias("scale"), "s.var", "s.n")


def _scaled(c: str, mean: Column, scale: Column, with_mean: bool, with_std: bool) -> Column:
    value = F.col(c).cast("double")
    value = value - mean if with_mean else value
    if not with_std:
        return value
    return value / F.when(scale == 0, F.lit(1.0)).otherwise(scale)


def apply_scaler(
    df: DataFrame, stats: DataFrame, cols: Sequence[str], with_mean: bool = True, with_std: bool = True
) -> DataFrame:
    """Scale ``cols`` in place with stored statistics, which may come from another table or run.

    The statistics (one row per feature) reach the rows as a scalar subquery holding a map.
    """
    lookup = stats.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "scale")))).alias("m"))
    held = with_row(df, lookup, "__scaler")
    entry = {c: F.col("__scaler.m")[c] for c in cols}
    return held.withColumns(
        {c: _scaled(c, e.getField("mean"), e.getField("scale"), with_mean, with_std) for c, e in entry.items()}
    ).drop("__scaler")


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fit and apply in one plan. ``fit_on`` restricts the rows the statistics come from."""
    source = df if fit_on is None else fit_on
    row = source.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
    )
    held = with_row(df, row, "__scaler")
    scaled = {
        c: _scaled(c, F.col(f"__scaler.m{i}"), F.col(f"__scaler.s{i}"), True, True) for i, c in enumerate(cols)
    }
    return held.withColumns(scaled).drop("__scaler")


def one_hot(df: DataFrame, c: str, categories: Sequence[str] | None = None, prefix: str = "loc") -> DataFrame:
    """0/1 column per category. Pass the categories to save a job. For more of them than a table should have columns, use
    the sparse block of :mod:`riverframe.operators.categories`."""
    if categories is None:
        categories = [r[0] for r in df.select(c).dropna().distinct().orderBy(c).limit(MAX_ONE_HOT + 1).collect()]
        if len(categories) > MAX_ONE_HOT:
            raise ValueError(f"{c} has more than {MAX_ONE_HOT} categories; use fit_categories and one_hot_sparse")
    return df.withColumns({f"{prefix}_{v}": F.coalesce(F.col(c) == v, F.lit(False)).cast("int") for v in categories})


#: From here on :func:`riverframe.plans.run.run` takes the sparse block.
MAX_ONE_HOT = 200


def category_index(df: DataFrame, c: str, out: str | None = None):
    """Index and sparse one-hot vector of Spark ML, which holds all values on the driver; :func:`riverframe.operators.categories.fit_categories` does not."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    out = out or f"{c}_vec"
    index = StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetAsc", handleInvalid="keep")
    encode = OneHotEncoder(inputCol=f"{c}_idx", outputCol=out, dropLast=False)
    return Pipeline(stages=[index, encode]).fit(df)
