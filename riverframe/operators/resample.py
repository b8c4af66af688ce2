"""Roll-ups to a calendar unit. Partial aggregation runs before the shuffle, so a hot key
sends one row per unit and task, not its readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min, "mean": F.avg, "count": F.count}


def time_unit(ts: str, unit: str) -> Column:
    """Start of the calendar unit: a DATE, or for hours and minutes a zone-less stamp.

    It is put together from the parts of the wall clock, so the session zone plays no part.
    """
    day = F.to_date(ts)
    if unit == "day":
        return day
    if unit in ("hour", "minute"):
        minutes = F.minute(ts) if unit == "minute" else F.lit(0)
        return day.cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts), mins=minutes)
    if unit in ("week", "month", "quarter", "year"):
        return F.trunc(day, unit)
    raise ValueError(f"unknown unit {unit!r}")


def resample(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    aggs: Mapping[str, tuple[str, str]],
    unit: str = "day",
    out_ts: str = "date",
    null_sum: str = "zero",
    n_obs: str | None = "n_obs",
    digits: int | None = None,
) -> DataFrame:
    """Aggregate readings by key and calendar unit.

    ``aggs`` maps an output name to (function, column). ``null_sum="zero"`` gives an all-missing
    unit the sum 0, ``"null"`` leaves it missing. ``n_obs`` counts the readings in the unit.
    ``digits`` rounds sums and means: a floating-point sum depends on the order in which tasks
    finish, which matters where a value is later compared with a threshold taken from the same data.
    """
    cols = []
    for name, (fn, c) in aggs.items():
        value = AGGREGATES[fn](c)
        if fn == "sum" and null_sum == "zero":
            value = F.coalesce(value, F.lit(0.0))
        if digits is not None and fn in ("sum", "mean"):
            value = F.round(value, digits)
        cols.append(value.alias(name))
    if n_obs:
        cols.append(F.count("*").alias(n_obs))
    return df.groupBy(*keys, time_unit(ts, unit).alias(out_ts)).agg(*cols)


def mean_by(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in cols])


def month_means(df: DataFrame, ts: str, cols: Sequence[str], by: Sequence[str] = ("location",)) -> DataFrame:
    """Mean by calendar month, carrying the month number so that sorting follows the calendar."""
    month = F.month(ts).alias("month")
    means = df.groupBy(*by, month).agg(*[F.avg(c).alias(c) for c in cols])
    name = F.date_format(F.make_date(F.lit(2000), F.col("month"), F.lit(1)), "MMMM")
    return means.withColumn("month_name", name)


def pivot_first(
    df: DataFrame, index: Sequence[str], col: str, value: str, values: Sequence[str], order_by: str
) -> DataFrame:
    """Long to wide keeping the first non-missing value in ``order_by`` order.

    The names are given, so no extra job looks for them, and the order makes "first" repeatable.
    """
    first = [
        F.min_by(F.col(value), F.when((F.col(col) == v) & F.col(value).isNotNull(), F.col(order_by))).alias(v)
        for v in values
    ]
    return df.groupBy(*index).agg(*first)


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "variable", val: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), var, val)
