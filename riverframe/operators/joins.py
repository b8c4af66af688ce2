"""Joins and unions.

No side is broadcast by hint: a daily table grows with the number of locations, so Catalyst
and AQE decide from its measured size, and AQE splits a partition that one hot key fills.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverframe.operators.settle import settle


def spread_daily(
    hourly: DataFrame,
    daily: DataFrame,
    on: Sequence[str],
    value: str | Sequence[str],
    how: str = "left",
    fill: float | None = None,
) -> DataFrame:
    """Repeat each daily value on the finer rows of its day.

    ``inner`` also drops rows whose daily value is missing; ``fill`` replaces a missing value.
    """
    values = [value] if isinstance(value, str) else list(value)
    right = daily.select(*on, *values)
    if how == "inner":
        right = right.dropna(subset=values)
    out = hourly.join(right, list(on), how)
    return out if fill is None else out.withColumns({v: F.coalesce(F.col(v), F.lit(fill)) for v in values})


def attach_target(features: DataFrame, target: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    return features.join(target, list(on), how)


def attach_forecast_driver(predictions: DataFrame, driver: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of the driving forecast (such as rain) to each prediction."""
    return predictions.join(driver, list(on), "left")


def join_with_suffix(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which clashing non-key names get a suffix on each side."""
    clash = [c for c in left.columns if c in set(right.columns) and c not in on]
    l_side = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    r_side = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return l_side.join(r_side, list(on), how)


def join_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str], measured: bool = False) -> DataFrame:
    """Left join of per-group values to rows, keeping the column order of ``rows``.

    ``measured`` writes the groups first, so that Spark plans with their real size: a small
    table is broadcast, and the rows of a hot group stay spread instead of meeting in one task.
    A large one is joined by shuffle, where AQE splits the hot group.

    Plain equality keeps rows that are already partitioned by ``by`` where they are. Rows with a
    NULL key stay and get NULL values, as they belong to no group.
    """
    if measured:
        groups = settle(groups, "groups")
    added = [c for c in groups.columns if c not in by]
    return rows.join(groups, list(by), "left").select(*rows.columns, *added)


def with_global_stats(df: DataFrame, stats: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Put aggregate values on every row.

    Without ``by`` the one-row aggregate is a scalar subquery: no join and no
    single-partition window. With ``by`` it is an aggregate joined back.
    """
    named = [c.alias(n) for n, c in stats.items()]
    if by:
        return join_groups(df, df.groupBy(*by).agg(*named), by, measured=True)
    held = with_row(df, df.agg(*named), "__stats")
    return held.withColumns({n: F.col("__stats").getField(n) for n in stats}).drop("__stats")


def with_row(df: DataFrame, row: DataFrame, out: str) -> DataFrame:
    """Put a one-row table on every row as a struct column.

    It is one scalar subquery however many of its fields are used afterwards; a subquery per
    field would be optimized and planned once per field.
    """
    return df.withColumn(out, row.select(F.struct(*row.columns).alias("row")).scalar())


def union_all(*frames: DataFrame, allow_missing: bool = True) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
