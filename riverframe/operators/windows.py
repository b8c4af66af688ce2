"""Lag, rolling, change and fill operators over an ordered series.

Windows count rows, not days, unless ``calendar=True``. The ``*_of`` functions describe one
column for :func:`riverframe.operators.ordered.add_rows`, so that a feature job can compute
all of its columns over a single shuffle; the others are the one-operator forms.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverframe.functions.columns import as_column
from riverframe.operators.joins import join_groups, with_global_stats
from riverframe.operators.ordered import HOT_ROWS, KEY, RowExpr, add_rows, cells, is_date, use_chunks

FRAME_FUNCTIONS = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min}


# -- column descriptions ----------------------------------------------------


def lag_of(c: str, k: int) -> RowExpr:
    return RowExpr(k, lambda w: F.lag(c, k).over(w))


def rolling_of(c: str, n: int, fn: str = "sum", min_periods: int | None = None) -> RowExpr:
    """Aggregate over the current and the ``n - 1`` preceding rows.

    The result is NULL until the frame holds ``min_periods`` (default ``n``) non-missing values.
    """
    need = n if min_periods is None else min_periods

    def build(w):
        frame = w.rowsBetween(-(n - 1), 0)
        value = FRAME_FUNCTIONS[fn](c).over(frame)
        return F.when(F.count(c).over(frame) >= need, value)

    return RowExpr(n - 1, build)


def delta_of(c: str, fill: float | None = None) -> RowExpr:
    def build(w):
        change = F.col(c) - F.lag(c, 1).over(w)
        return change if fill is None else F.coalesce(change, F.lit(fill))

    return RowExpr(1, build)


def pct_change_of(c: str) -> RowExpr:
    """Relative change to the previous row; a zero base gives NULL."""
    return RowExpr(1, lambda w: F.try_divide(F.col(c), F.lag(c, 1).over(w)) - F.lit(1.0))


def anomaly_of(c: str, n: int = 3) -> RowExpr:
    mean = rolling_of(c, n, "mean")
    return RowExpr(n - 1, lambda w: F.col(c) - mean.build(w))


# -- one-operator forms -----------------------------------------------------


def lags(df: DataFrame, keys: Sequence[str], ts: str, c: str, ks: Iterable[int], prefix: str | None = None, **how) -> DataFrame:
    prefix = f"{c}_lag_" if prefix is None else prefix
    return add_rows(df, keys, ts, {f"{prefix}{k}": lag_of(c, k) for k in ks}, **how)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    c: str,
    n: int,
    fn: str = "sum",
    min_periods: int | None = None,
    calendar: bool = False,
    out: str | None = None,
    **how,
) -> DataFrame:
    """Rolling aggregate; ``calendar=True`` counts days instead of rows and needs a DATE column."""
    name = out or f"{c}_roll{n}_{fn}"
    if not calendar:
        return add_rows(df, keys, ts, {name: rolling_of(c, n, fn, min_periods)}, **how)
    if not is_date(df, ts):
        raise ValueError("a calendar window needs a DATE column; resample first")
    frame = Window.partitionBy(*keys).orderBy(F.unix_date(ts)).rangeBetween(-(n - 1), 0)
    need = n if min_periods is None else min_periods
    return df.withColumn(name, F.when(F.count(c).over(frame) >= need, FRAME_FUNCTIONS[fn](c).over(frame)))


def delta(df: DataFrame, keys: Sequence[str], ts: str, c: str, fill: float | None = None, out: str | None = None, **how) -> DataFrame:
    return add_rows(df, keys, ts, {out or f"{c}_delta": delta_of(c, fill)}, **how)


def pct_change(df: DataFrame, keys: Sequence[str], ts: str, c: str, pad: bool = False, out: str | None = None, **how) -> DataFrame:
    """Relative change; ``pad`` carries the last value over missing ones first."""
    name = out or f"{c}_pct_change"
    if not pad:
        return add_rows(df, keys, ts, {name: pct_change_of(c)}, **how)
    padded = fill_gaps(df.withColumn("__padded", F.col(c)), keys, ts, ["__padded"], "ffill", **how)
    return add_rows(padded, keys, ts, {name: pct_change_of("__padded")}, **how).drop("__padded")


def anomaly(df: DataFrame, keys: Sequence[str], ts: str, c: str, n: int = 3, out: str | None = None, **how) -> DataFrame:
    return add_rows(df, keys, ts, {out or f"{c}_anomaly": anomaly_of(c, n)}, **how)


# -- gaps -------------------------------------------------------------------


def fill_gaps(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    cols: Sequence[str],
    direction: str = "both",
    tiebreak: Sequence[str] = (),
    chunk: int | None = None,
    width: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Carry values forward, backward, or forward and then backward, per key.

    A fill may reach over any distance, so raw series are cut into time cells: each cell hands its
    last (first) known value to the later (earlier) cells of its key.
    """
    if direction not in ("ffill", "bfill", "both"):
        raise ValueError(f"direction must be ffill, bfill or both, not {direction!r}")
    order = [ts, *tiebreak]
    if not use_chunks(df, keys, ts, chunk, hot_rows):
        spec = Window.partitionBy(*keys)
        return df.withColumns({c: F.coalesce(*_fills(F.col(c), spec, order, direction)) for c in cols})
    cell = [KEY, "__bucket", "__piece"]
    tagged, _ = cells(df, keys, ts, width, hot_rows)
    stamp = F.struct(*order)
    edges = tagged.groupBy(*cell).agg(
        *[f(F.col(c), F.when(F.col(c).isNotNull(), stamp)).alias(f"__{n}_{c}")
          for c in cols for n, f in (("last", F.max_by), ("first", F.min_by))]
    )
    by_key = Window.partitionBy(KEY)
    earlier = by_key.orderBy(*cell[1:]).rowsBetween(Window.unboundedPreceding, -1)
    later = by_key.orderBy(*[F.desc(c) for c in cell[1:]]).rowsBetween(Window.unboundedPreceding, -1)
    def handed(c: str) -> Column:
        if direction == "bfill":
            return F.last(f"__first_{c}", True).over(later)
        before = F.last(f"__last_{c}", True).over(earlier)
        if direction == "ffill":
            return before
        return F.coalesce(before, _first_known(F.col(f"__first_{c}"), by_key, cell[1:]))

    carried = edges.select(*cell, *[handed(c).alias(f"__carry_{c}") for c in cols])
    inside = Window.partitionBy(*cell)
    local = "ffill" if direction == "both" else direction
    filled = {c: F.coalesce(*_fills(F.col(c), inside, order, local), F.col(f"__carry_{c}")) for c in cols}
    helpers = [f"__carry_{c}" for c in cols]
    return join_groups(tagged, carried, cell).withColumns(filled).drop(*cell, *helpers)


def _first_known(c: Column, spec, order: Sequence[str]) -> Column:
    return F.first(c, True).over(spec.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def _fills(c: Column, spec, order: Sequence[str], direction: str) -> list[Column]:
    """Growing frames only: a frame that ends at the partition's end is read anew for every row,
    so a backward fill is a forward fill in descending order, and after a forward fill the
    leading gap is closed by the first known value of the key."""
    forward = F.last(c, True).over(spec.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    if direction == "ffill":
        return [forward]
    if direction == "both":
        return [forward, _first_known(c, spec, order)]
    return [F.last(c, True).over(spec.orderBy(*[F.desc(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0))]


# -- ends of a series -------------------------------------------------------


def last_n(df: DataFrame, keys: Sequence[str], ts: str, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` rows of each key. Spark keeps only ``n`` rows per key and task before it shuffles."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (ts, *tiebreak)])
    return df.withColumn("__rank", F.row_number().over(newest)).filter(F.col("__rank") <= n).drop("__rank")


def skip_n(df: DataFrame, keys: Sequence[str], ts: str, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """All but the oldest ``n`` rows of each key; ``(ts, tiebreak)`` must be unique within a key.

    The stamp of the n-th row is found with the same map-side limit as :func:`last_n` and
    compared with, so that the key itself is never numbered.
    """
    oldest = Window.partitionBy(*keys).orderBy(ts, *tiebreak)
    head = df.select(*keys, ts, *tiebreak).withColumn("__rank", F.row_number().over(oldest))
    cut = (
        head.filter(F.col("__rank") <= n)
        .groupBy(*keys)
        .agg(F.max(F.struct(ts, *tiebreak)).alias("__cut"), F.count("*").alias("__n"))
    )
    kept = join_groups(df, cut, keys)
    return kept.filter((F.col("__n") == n) & (F.struct(ts, *tiebreak) > F.col("__cut"))).drop("__cut", "__n")


# -- standard score ---------------------------------------------------------


def zscore(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), ddof: int = 1, names: dict[str, str] | None = None) -> DataFrame:
    """(value - mean) / standard deviation over the table or each group; zero spread gives NULL."""
    names = names or {c: f"{c}_zscore" for c in cols}
    dev = F.stddev_samp if ddof == 1 else F.stddev_pop
    stats = {f"__m_{c}": F.avg(c) for c in cols} | {f"__s_{c}": dev(c) for c in cols}
    out = with_global_stats(df, stats, by)
    scores = {names[c]: F.try_divide(as_column(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}")) for c in cols}
    return out.withColumns(scores).drop(*stats)
