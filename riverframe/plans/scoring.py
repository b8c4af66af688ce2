"""Batch scoring of forecasts and per-key horizon forecasts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverframe.functions.columns import RISK_CUTS, risk_class
from riverframe.operators.blocks import score_rows
from riverframe.operators.models import score
from riverframe.operators.ordered import DAILY, add_rows
from riverframe.operators.resample import resample
from riverframe.operators.scaling import apply_scaler
from riverframe.operators.select import align_columns
from riverframe.operators.sequences import eligible, horizon_windows
from riverframe.operators.windows import lag_of, rolling_of

KEY, DAY = "location", "date"


def forecast_days(forecast: DataFrame, reading: str = "rain_member0") -> DataFrame:
    """Daily sum, maximum and mean of a forecast with its own short lags; incomplete rows dropped."""
    aggs = {"rain_sum": ("sum", reading), "rain_max": ("max", reading), "rain_mean": ("mean", reading)}
    days = resample(forecast, [KEY], "datetime", aggs, n_obs=None)
    rows = {f"rain_sum_lag{k}": lag_of("rain_sum", k) for k in (1, 2, 3)}
    rows["rain_3d_avg"] = rolling_of("rain_sum", 3, "mean")
    return add_rows(days, [KEY], DAY, rows, chunk=DAILY).dropna()


def score_forecast(
    table: DataFrame,
    features: Sequence[str],
    scaler: DataFrame | None,
    make_model: Callable,
    n: int = 14,
    keys: Sequence[str] = (KEY,),
    ts: str = DAY,
    cuts=RISK_CUTS,
    on_missing: str = "error",
    chunk: int | None = DAILY,
    ahead: tuple[str, str] | None = None,
    category: str | None = None,
) -> DataFrame:
    """Prediction and risk class for each day that has ``n`` days before it.

    ``table`` should come from the same feature function as the training table; a feature it
    lacks is an error unless ``on_missing`` says otherwise. Sequences never cross keys. ``chunk=None`` is for a
    table of more than a row per key and day. Rows go to the model's workers once, which cut the sequences there. ``ahead``
    (column and value) scores the rows of that kind alone; of the others only those that their sequences need are sent. With ``category``, a column of
    places, the model gets them beside the sequences.
    """
    kind = ahead[0] if ahead else None
    kept = [*keys, ts, *([kind] if kind else []), *([category] if category else [])]
    aligned = align_columns(table, features, on_missing, keep=kept)
    wanted = F.col(kind) == ahead[1] if ahead else None
    if ahead:
        aligned = _near(aligned, keys, ts, wanted, n, chunk)
    scaled = apply_scaler(aligned, scaler, features) if scaler is not None else aligned
    scored = score_rows(scaled, keys, ts, features, n, make_model, "predicted_discharge", wanted, category, chunk=chunk)
    return scored.withColumn("flood_risk", risk_class("predicted_discharge", cuts))


def _near(df: DataFrame, keys: Sequence[str], ts: str, wanted: Column, n: int, chunk: int | None) -> DataFrame:
    """Rows that are wanted or among the ``n`` before a wanted one."""
    if chunk != DAILY:
        return df
    ahead = Window.partitionBy(*keys).orderBy(ts).rowsBetween(0, n)
    return df.withColumn("__near", F.max(wanted).over(ahead)).filter("__near").drop("__near")


def forecast_horizon(
    table: DataFrame,
    features: Sequence[str],
    scaler: DataFrame | None,
    make_model: Callable,
    until,
    n: int = 14,
    keys: Sequence[str] = (KEY,),
    ts: str = DAY,
    target: str | None = "river_discharge_m3s",
) -> tuple[DataFrame, DataFrame]:
    """Predictions for every key and day up to ``until``, and the keys with too little history."""
    needed = [*features, *([target] if target else [])]
    clean = table.dropna(subset=needed)
    _, rejected = eligible(table, keys, n, needed)
    scaled = apply_scaler(clean, scaler, features) if scaler is not None else clean
    windows = horizon_windows(scaled, keys, ts, features, n, until)
    scored = score(windows, make_model, (n, len(features)), out="predicted_discharge")
    return scored.withColumn("flood_risk", risk_class("predicted_discharge")).drop("sequence"), rejected


def risk_counts(scored: DataFrame, c: str = "flood_risk", by: Sequence[str] = ()) -> DataFrame:
    """Days per risk class, beside the number of days."""
    counts = [F.count_if(F.col(c) == name).alias(f"n_{name.lower()}") for name in ("HIGH", "MEDIUM", "LOW")]
    return (scored.groupBy(*by) if by else scored.groupBy()).agg(F.count("*").alias("n_days"), *counts)
