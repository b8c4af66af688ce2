"""Readings of the hour beside the discharge of their day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.functions.columns import to_local
from riverframe.operators.joins import spread_daily
from riverframe.operators.select import normalize_keys


def local_days(df: DataFrame, ts: str, tz: str | None, keys=("location",), out: str = "date") -> DataFrame:
    """Cleaned keys and the local calendar day of ``ts``.

    Both sides of a join must pass the same ``tz``: a stamp taken at local midnight falls on the
    day before in UTC, and truncating only one side shifts the join by a day.
    """
    clean = normalize_keys(df, ts, keys)
    stamp = to_local(ts, tz) if tz else F.col(ts)
    return clean.withColumn(out, F.to_date(stamp))


def combine_hourly_daily(
    hourly: DataFrame,
    daily: DataFrame,
    hourly_tz: str | None = None,
    daily_tz: str | None = None,
    value: str = "river_discharge_m3s",
    reading: str = "rain",
    how: str = "inner",
    fill: float | None = None,
) -> DataFrame:
    """Each reading with the daily value of its location and day.

    ``inner`` leaves out readings without a daily value; ``how="left", fill=0.0`` keeps them.
    The result is not sorted; sort at the sink.
    """
    left = local_days(hourly, "datetime", hourly_tz)
    right = local_days(daily, "date", daily_tz)
    joined = spread_daily(left, right, ["date", "location"], value, how, fill)
    return joined.select("datetime", "location", reading, value)
