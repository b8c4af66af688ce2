"""The queries behind a dashboard view: every filter composes with the others."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.operators.joins import spread_daily
from riverframe.operators.select import between_dates, in_year, last_period, where_eq
from riverframe.plans.scoring import risk_counts


@dataclass(frozen=True)
class View:
    """What the reader chose. ``months`` counts back from the newest day; ``floor`` bounds it."""

    location: str | None = None
    start: str | None = None
    end: str | None = None
    months: int | None = None
    floor: str | None = None
    year: int | None = None


def in_view(df: DataFrame, view: View, ts: str = "date", key: str = "location") -> DataFrame:
    if view.location is not None:
        df = where_eq(df, key, view.location)
    if view.year is not None:
        df = in_year(df, ts, view.year)
    if view.months is not None:
        df = last_period(df, ts, view.months, view.floor)
    if view.start is not None or view.end is not None:
        df = between_dates(df, ts, view.start or "0001-01-01", view.end or "9999-12-30")
    return df


def hourly_overlay(hourly: DataFrame, daily: DataFrame, view: View, value: str = "river_discharge_m3s") -> DataFrame:
    """Readings of the view with the discharge of their day, 0 where there is none."""
    readings = in_view(hourly, view, "datetime").withColumn("date", F.to_date("datetime"))
    return spread_daily(readings, in_view(daily, view), ["date", "location"], value, "left", 0.0)


def dashboard_slice(
    features: DataFrame, hourly: DataFrame, daily: DataFrame, forecast: DataFrame, view: View
) -> dict[str, DataFrame]:
    scored = in_view(forecast, view)
    return {
        "features": in_view(features, view),
        "overlay": hourly_overlay(hourly, daily, view),
        "forecast": scored,
        "risk": risk_counts(scored),
    }
