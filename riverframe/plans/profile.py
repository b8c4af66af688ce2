"""Exploratory profile of a daily table, as a set of small result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.functions.columns import label_if
from riverframe.operators import stats
from riverframe.operators.resample import month_means
from riverframe.operators.select import numeric_columns
from riverframe.operators.settle import settle


def with_rain_label(df: DataFrame, c: str = "rain_sum_mm") -> DataFrame:
    return df.withColumn("rain_label", label_if(F.col(c) > 0, "Rain", "No Rain"))


def profile(
    df: DataFrame,
    ts: str,
    key: str = "location",
    values: Sequence[str] | None = None,
    rain: str | None = None,
    bins: int = 40,
    method: str = "exact",
) -> dict[str, DataFrame]:
    """Result tables by name, each computed when it is used. All of them, and the quantiles that some need at once, read the
    daily table as it is written here: joins and roll-ups behind it run once, not once per table."""
    values = list(values or numeric_columns(df))
    df = settle(df, "profile")
    report = {
        "overview": stats.overview(df, ts, values),
        "keys": stats.distinct_values(df, key),
        "nulls": stats.null_report(df).orderBy(F.desc("pct"), "column"),
        "describe": stats.describe(df, values, method=method),
        "describe_by_key": stats.describe(df, values, [key], method=method),
        "corr": stats.corr_matrix(df, values),
        "months": month_means(df, ts, values, [key]),
    }
    for c in values:
        report[f"histogram_{c}"] = stats.histogram(df, c, bins)
        report[f"box_{c}"] = stats.box_stats(df, c, [key], method)
    if rain:
        labelled = with_rain_label(df, rain)
        report["rain_days"] = stats.cross_count(labelled, "rain_label", key)
        report["rain_share"] = stats.value_share(labelled, "rain_label").orderBy(F.desc("n"))
    return report
