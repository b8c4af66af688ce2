"""Projection, filtering and cleaning. Column lists are resolved from the schema, so no job runs."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverframe.functions.columns import clean_key, nan_to_null, parse_ts


# -- guards -----------------------------------------------------------------


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; have {df.columns}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


# -- projection -------------------------------------------------------------


def reorder(df: DataFrame, first: Sequence[str]) -> DataFrame:
    return df.select(*first, *[c for c in df.columns if c not in first])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def tag(df: DataFrame, col: str, value) -> DataFrame:
    return df.withColumn(col, F.lit(value))


def features_except(df: DataFrame, drop: Iterable[str]) -> list[str]:
    dropped = set(drop)
    return [c for c in df.columns if c not in dropped]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def select_existing(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The listed columns that exist, and the names that were dropped."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have]), [c for c in cols if c not in have]


def align_columns(df: DataFrame, cols: Sequence[str], on_missing: str = "error", keep: Sequence[str] = ()) -> DataFrame:
    """Project to ``cols`` in that order, after ``keep``.

    A missing column is an error unless the caller asks for ``zero`` or ``null``:
    a silently zero-filled feature makes every prediction the same.
    """
    if on_missing not in ("error", "zero", "null"):
        raise ValueError(f"on_missing must be error, zero or null, not {on_missing!r}")
    if on_missing == "error":
        require_columns(df, cols)
    filler = F.lit(0.0) if on_missing == "zero" else F.lit(None).cast("double")
    have = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in have else filler.alias(c) for c in cols])


# -- filters ----------------------------------------------------------------


def where_eq(df: DataFrame, c: str, value) -> DataFrame:
    return df.filter(F.col(c) == F.lit(value))


def between_dates(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Inclusive range on the stored column itself, so that it reaches the Parquet scan.

    On a timestamp column the end day counts whole.
    """
    if isinstance(df.schema[ts].dataType, T.DateType):
        return df.filter(F.col(ts).between(_date(start), _date(end)))
    kind = df.schema[ts].dataType.simpleString()
    return df.filter(
        (F.col(ts) >= _date(start).cast(kind)) & (F.col(ts) < F.date_add(_date(end), 1).cast(kind))
    )


def _date(v) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("date")


def as_of(df: DataFrame, ts: str, ref) -> DataFrame:
    """Rows up to and including the reference day."""
    kind = df.schema[ts].dataType
    if isinstance(kind, T.DateType):
        return df.filter(F.col(ts) <= _date(ref))
    return df.filter(F.col(ts) < F.date_add(_date(ref), 1).cast(kind.simpleString()))


def in_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """One calendar year, as a range so that files and row groups can be skipped."""
    return between_dates(df, ts, f"{year}-01-01", f"{year}-12-31")


def last_period(df: DataFrame, ts: str, months: int, floor=None) -> DataFrame:
    """The last ``months`` months before the newest stamp, not starting before ``floor``."""
    start = F.add_months(F.to_date(df.agg(F.max(ts).alias("newest")).scalar()), -months)
    if floor is not None:
        start = F.greatest(start, _date(floor))
    return df.filter(F.col(ts) >= start.cast(df.schema[ts].dataType.simpleString()))


def drop_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(cols) if cols else None)


def fill_null(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


# -- cleaning ---------------------------------------------------------------


def floats_nan_to_null(df: DataFrame) -> DataFrame:
    """NaN readings become NULL, so that aggregates skip them."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def normalize_keys(df: DataFrame, ts: str, keys: Sequence[str] = ("location",), on_bad: str = "drop") -> DataFrame:
    """Parse the time column, trim the keys, and drop rows that have no usable key or time."""
    kind = df.schema[ts].dataType
    stamp = parse_ts(ts, strict=on_bad == "error") if isinstance(kind, T.StringType) else F.col(ts)
    out = df.withColumns({ts: stamp, **{k: clean_key(k) for k in keys}})
    return out if on_bad == "keep" else out.dropna(subset=[ts, *keys])


def rejected_rows(df: DataFrame, ts: str, keys: Sequence[str] = ("location",)) -> DataFrame:
    """How many rows :func:`normalize_keys` drops, by reason. One job."""
    kept = normalize_keys(df, ts, keys, on_bad="keep")
    reasons = {f"bad_{c}": F.count_if(F.col(c).isNull()).alias(f"bad_{c}") for c in [ts, *keys]}
    return kept.agg(F.count("*").alias("n_rows"), *reasons.values())
