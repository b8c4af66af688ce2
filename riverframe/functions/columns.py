"""Scalar column functions: every one is a native expression, none is a Python UDF.

Names are column names or Columns; the result is always a Column.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = str | Column

# Months of the north-east and inter-monsoon season, weekend days
# (Monday = 0), and the discharge cuts in m3/s with their risk names.
MONSOON_MONTHS = (10, 11, 12, 1, 2, 3)
WEEKEND_DAYS = (5, 6)
RISK_CUTS = ((300.0, "HIGH"), (150.0, "MEDIUM"))
RISK_OTHER = "LOW"
HEAVY_RAIN_MM = 50.0
RATIO_EPS = 1e-6


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- time -------------------------------------------------------------------


def parse_ts(c: ColumnLike, strict: bool = False, fmt: str | None = None) -> Column:
    """Text to wall-clock stamp; unparseable text is NULL unless ``strict``.

    Without a pattern the session zone plays no part, so hours that its clock skips stay as written.
    """
    c = as_column(c)
    if fmt:
        return F.to_timestamp_ntz(c, F.lit(fmt)) if strict else F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
    return c.cast("timestamp_ntz") if strict else c.try_cast("timestamp_ntz")


def from_epoch(c: ColumnLike) -> Column:
    """Epoch seconds to a UTC wall-clock stamp, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=as_column(c).cast("decimal(18,6)"))


def wall_micros(c: ColumnLike) -> Column:
    """Microseconds since 1970 on the wall clock of a zone-less stamp, whatever the session zone is."""
    c = as_column(c)
    minutes = (F.unix_date(F.to_date(c)).cast("bigint") * 24 + F.hour(c)) * 60 + F.minute(c)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")


def to_local(c: ColumnLike, tz: str, source: str = "UTC") -> Column:
    """Wall-clock stamp in ``source`` to wall-clock stamp in ``tz``."""
    return F.convert_timezone(F.lit(source), F.lit(tz), as_column(c).cast("timestamp_ntz"))


def to_day(c: ColumnLike) -> Column:
    return F.to_date(as_column(c))


def calendar_parts(ts: ColumnLike) -> dict[str, Column]:
    """Year, month, day of year, weekday (Monday = 0) and weekend flag of a local date."""
    c = as_column(ts)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "dayofyear": F.dayofyear(c),
        "weekday": F.weekday(c),
        "is_weekend": F.weekday(c).isin(*WEEKEND_DAYS).cast("int"),
    }


def season_flag(ts: ColumnLike, months: Sequence[int] = MONSOON_MONTHS) -> Column:
    return F.month(as_column(ts)).isin(*months).cast("int")


def shift_date(c: ColumnLike, days: int | Column) -> Column:
    return F.date_add(as_column(c), days)


def horizon_end(max_date: ColumnLike, ref: ColumnLike, max_days: int = 7, ref_days: int = 14) -> Column:
    """Last day worth forecasting: ``max_date + 7`` but not past ``ref + 14``."""
    return F.least(F.date_add(as_column(max_date), max_days), F.date_add(as_column(ref), ref_days))


def format_date(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "yyyy-MM-dd")


# -- text and keys ----------------------------------------------------------


def clean_key(c: ColumnLike) -> Column:
    """Trimmed text key. A missing key stays NULL instead of turning into a word."""
    return F.trim(as_column(c).cast("string"))


def relabel(c: ColumnLike, mapping: Mapping[str, str]) -> Column:
    """Replace known labels; labels outside the mapping stay as they are."""
    c = as_column(c)
    chain = reduce(
        lambda acc, kv: F.when(c == kv[0], kv[1]) if acc is None else acc.when(c == kv[0], kv[1]),
        mapping.items(),
        None,
    )
    return c if chain is None else chain.otherwise(c)


def label_if(predicate: Column, yes: str, no: str) -> Column:
    return F.when(predicate, yes).otherwise(no)


def is_in(c: ColumnLike, values: Iterable) -> Column:
    return as_column(c).isin(list(values))


# -- numbers ----------------------------------------------------------------


def nan_to_null(c: ColumnLike) -> Column:
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def clamp(c: ColumnLike, lo, hi) -> Column:
    """Bound a value; a NULL value stays NULL."""
    c = as_column(c)
    bounded = F.greatest(F.least(c, _lit(hi)), _lit(lo))
    return F.when(c.isNotNull(), bounded)


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def flag(c: ColumnLike, op: str, threshold) -> Column:
    """0/1 flag of a comparison; a missing value counts as 0."""
    c, t = as_column(c), _lit(threshold)
    test = {">": c > t, ">=": c >= t, "<": c < t, "<=": c <= t, "==": c == t}[op]
    return F.coalesce(test, F.lit(False)).cast("int")


def all_flags(*flags: ColumnLike) -> Column:
    return reduce(lambda a, b: a & b, [as_column(f) == 1 for f in flags]).cast("int")


def any_flag(*flags: ColumnLike) -> Column:
    return reduce(lambda a, b: a | b, [as_column(f) == 1 for f in flags]).cast("int")


def safe_ratio(a: ColumnLike, b: ColumnLike, eps: float = RATIO_EPS) -> Column:
    """``a / (b + eps)``; a denominator that is still zero gives NULL, not an error."""
    return F.try_divide(as_column(a), as_column(b) + F.lit(eps))


def composite(weights: Mapping[str, float]) -> Column:
    """Weighted sum of columns, missing terms counting as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) * F.lit(w) for c, w in weights.items()])


def interaction(a: ColumnLike, b: ColumnLike) -> Column:
    return F.coalesce(as_column(a), F.lit(0.0)) * F.coalesce(as_column(b), F.lit(0.0))


def spread(hi: ColumnLike, lo: ColumnLike) -> Column:
    return as_column(hi) - as_column(lo)


def risk_class(c: ColumnLike, cuts: Sequence[tuple[float, str]] = RISK_CUTS, other: str = RISK_OTHER) -> Column:
    """Name of the first cut the value exceeds. Missing and NaN values fall in ``other``."""
    c = nan_to_null(as_column(c).cast("double"))
    ordered = sorted(cuts, reverse=True)
    chain = F.when(c > ordered[0][0], ordered[0][1])
    for cut, name in ordered[1:]:
        chain = chain.when(c > cut, name)
    return chain.otherwise(other)


def decide(probability: ColumnLike, cut: float, strict: bool = True) -> Column:
    """Class 1 where the probability passes the cut (``>`` if strict, else ``>=``)."""
    return flag(probability, ">" if strict else ">=", cut)


def round_to(c: ColumnLike, digits: int) -> Column:
    return F.round(as_column(c), digits)


def cast_to(c: ColumnLike, type_name: str) -> Column:
    return as_column(c).cast(type_name)
