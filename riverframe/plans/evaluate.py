"""Scores of one or several models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.functions.columns import decide, flag
from riverframe.operators.metrics import binary_metrics, class_report, compare_models, confusion, regression_error


def evaluate(df: DataFrame, y: str = "label", probability: str = "p1", cut: float = 0.5, strict: bool = False) -> dict[str, DataFrame]:
    """All classification tables at one probability cut."""
    decided = df.withColumn("predicted", decide(probability, cut, strict))
    return {
        "metrics": binary_metrics(decided, y, "predicted"),
        "confusion": confusion(decided, y, "predicted"),
        "report": class_report(decided, y, "predicted"),
    }


def stack_predictions(df: DataFrame, y: str, predictions: Mapping[str, str]) -> DataFrame:
    """``(model, y, predicted)`` rows from one prediction column per model, in one scan."""
    pairs = [
        F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("predicted"))
        for name, c in predictions.items()
    ]
    return df.select(F.col(y).alias("actual"), F.explode(F.array(*pairs)).alias("__p")).select("actual", "__p.*")


def compare_at_threshold(df: DataFrame, y: str, predictions: Mapping[str, str], threshold: float) -> DataFrame:
    """Comparison table of regressors judged as detectors of ``value >= threshold``."""
    stacked = stack_predictions(df, y, predictions).dropna()
    judged = stacked.withColumns(
        {"label": flag("actual", ">=", threshold), "hit": flag("predicted", ">=", threshold)}
    )
    return compare_models(judged, "label", "hit")


def compare_errors(df: DataFrame, y: str, predictions: Mapping[str, str]) -> DataFrame:
    return regression_error(stack_predictions(df, y, predictions).dropna(), "actual", "predicted", ["model"])
