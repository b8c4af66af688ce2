"""Supervised sequences, chronological splits and horizon windows.

Sequences multiply the data by their length, so they carry one feature array per row and are
built last. At daily grain a key is bounded by the calendar; for raw stamps pass ``chunk``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverframe.functions.columns import flag
from riverframe.operators.joins import join_groups
from riverframe.operators.ordered import KEY, RowExpr, add_rows, keyed, positions, ranges_of
from riverframe.operators.quantiles import quantiles
from riverframe.operators.windows import last_n


def sequences(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    features: Sequence[str],
    n: int,
    label: str | None = None,
    carry: Sequence[str] = (),
    **how,
) -> DataFrame:
    """Rows ``i .. i+n-1`` as ``sequence`` on row ``i+n``, per key.

    Row ``i+n`` gives ``label``, the columns to ``carry`` and the date the prediction belongs to, so nothing has to be
    aligned by position afterwards. A key with m rows gives ``max(m - n, 0)`` sequences.
    """
    point = F.array(*[F.col(c).cast("double") for c in features])
    slim = df.select(*keys, ts, *([label] if label else []), *carry, point.alias("__x"))
    build = RowExpr(n, lambda w: F.collect_list("__x").over(w.rowsBetween(-n, -1)))
    out = add_rows(slim, keys, ts, {"sequence": build}, **how)
    return out.filter(F.size("sequence") == n).drop("__x")


def sequence_counts(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Sequences per key; keys that are too short keep their row with 0."""
    rows = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return rows.withColumn("n_sequences", F.greatest(F.col("n_rows") - n, F.lit(0)))


def flatten_sequences(df: DataFrame, c: str = "sequence", out: str = "features") -> DataFrame:
    """n x f arrays to one array of n*f values."""
    return df.withColumn(out, F.flatten(c))


def with_vector(df: DataFrame, c: str = "features", out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(out, array_to_vector(c))


# -- split ------------------------------------------------------------------


def _cuts(total: Column, ratios: Sequence[float], rounding: str) -> list[Column]:
    """Row numbers at which each part but the last one ends."""
    if rounding == "ceil_test":
        return [total - F.ceil(total * F.lit(round(1.0 - sum(ratios[: i + 1]), 12))) for i in range(len(ratios) - 1)]
    return [F.floor(total * F.lit(round(sum(ratios[: i + 1]), 12))) for i in range(len(ratios) - 1)]


def chrono_split(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    ratios: Sequence[float] = (0.8, 0.2),
    mode: str = "per_key",
    rounding: str = "floor",
    names: Sequence[str] | None = None,
    chunk: int | None = None,
) -> DataFrame:
    """Add ``split``: oldest part first, no shuffling of time.

    ``per_key`` cuts each key at its own share. ``concat`` cuts the keys laid end to end in key
    order, as if stacked into one array; the offset of each key comes from the per-key counts,
    one row per key.
    """
    names = list(names or {2: ("train", "test"), 3: ("train", "val", "test")}[len(ratios)])
    placed = positions(df, keys, ts, "__pos", total="__total", chunk=chunk)
    if mode == "concat":
        offsets, rows = _key_offsets(df, keys)
        placed = join_groups(keyed(placed.drop("__total"), keys), offsets, [KEY]).withColumns(
            {"__pos": F.col("__pos") + F.col("__before"), "__total": F.lit(rows)}
        )
    elif mode != "per_key":
        raise ValueError(f"mode must be per_key or concat, not {mode!r}")
    part = F.lit(names[-1])
    for name, cut in reversed(list(zip(names, _cuts(F.col("__total"), ratios, rounding)))):
        part = F.when(F.col("__pos") <= cut, name).otherwise(part)
    return placed.withColumn("split", part).drop(KEY, "__pos", "__total", "__before")


def validation_tail(
    df: DataFrame, keys: Sequence[str], ts: str, share: float = 0.2, mode: str = "concat", split_col: str = "split",
    train: str = "train", name: str = "val", chunk: int | None = None,
) -> DataFrame:
    """Mark the last ``share`` of the training rows as ``name``: what a trainer holds out for its own validation.

    ``concat`` takes the tail of all training rows laid end to end, in key order, as trainers do with one stacked array (so it
    may hold the newest rows of the last keys alone); ``per_key`` takes the newest rows of every key. Other rows stay as they are.
    """
    inside = chrono_split(df.filter(F.col(split_col) == train).drop(split_col), keys, ts, (1.0 - share, share), mode, "floor", (train, name), chunk)
    rest = df.filter(~F.col(split_col).eqNullSafe(train))
    return inside.withColumnRenamed("split", split_col).select(*df.columns).unionByName(rest)


def _key_offsets(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """Rows that lie before each key in key order (rows without a key first), and the number of all rows."""
    offsets, total = ranges_of(keyed(df, keys).groupBy(KEY).agg(F.count("*").alias("__n")), KEY, "__n")
    return offsets.select(KEY, "__before"), total


# -- labels -----------------------------------------------------------------


def label_at(df: DataFrame, c: str, threshold: float, out: str = "label") -> DataFrame:
    return df.withColumn(out, flag(c, ">=", threshold))


def label_quantile(
    df: DataFrame, c: str, p: float = 0.8, prefer: str | None = None, out: str = "label", method: str = "exact"
) -> DataFrame:
    """1 from the p-quantile upward, unless the preferred flag column exists."""
    if prefer and prefer in df.columns:
        return df.withColumn(out, F.col(prefer).cast("int"))
    threshold = quantiles(df, {c: p}, method=method).scalar()
    return df.withColumn(out, flag(c, ">=", threshold))


# -- horizon ----------------------------------------------------------------


def eligible(df: DataFrame, keys: Sequence[str], n: int, features: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of keys with at least ``n`` complete rows, and the rejected keys with their count."""
    complete = F.lit(True)
    for c in features:
        complete = complete & F.col(c).isNotNull()
    counts = df.groupBy(*keys).agg(F.count_if(complete).alias("n_clean"))
    enough = counts.filter(F.col("n_clean") >= n).drop("n_clean")
    return df.join(enough, list(keys), "left_semi"), counts.filter(F.col("n_clean") < n)


def horizon_windows(
    df: DataFrame, keys: Sequence[str], ts: str, features: Sequence[str], n: int, until
) -> DataFrame:
    """One model input per key and future day.

    Step 1 sees the last ``n`` complete rows; each later step drops the oldest row and repeats
    the newest one, since predictions are not fed back. ``until`` is a date, or a Column such
    as a per-key end. Keys with fewer than ``n`` complete rows give nothing.
    """
    point = F.array(*[F.col(c).cast("double") for c in features])
    end = until if isinstance(until, Column) else F.lit(str(until)).cast("date")
    clean = df.dropna(subset=list(features)).select(
        *keys, F.to_date(ts).alias("__day"), F.col(ts).alias("__ts"), point.alias("__x"), end.alias("__until")
    )
    tail = last_n(clean, keys, "__ts", n)
    base = (
        tail.groupBy(*keys)
        .agg(
            F.sort_array(F.collect_list(F.struct("__ts", "__x"))).alias("__rows"),
            F.max("__day").alias("__last_day"),
            F.max("__until").alias("__until"),
        )
        .filter((F.size("__rows") == n) & (F.col("__until") > F.col("__last_day")))
        .withColumn("__rows", F.transform("__rows", lambda r: r["__x"]))
    )
    steps = base.withColumn("date", F.explode(F.sequence(F.date_add("__last_day", 1), F.col("__until"))))
    shift = F.date_diff("date", "__last_day") - 1
    kept = F.slice(F.col("__rows"), F.least(shift, F.lit(n)) + 1, F.greatest(F.lit(n) - shift, F.lit(0)))
    repeated = F.array_repeat(F.element_at("__rows", -1), F.least(shift, F.lit(n)))
    return steps.select(*keys, "date", (shift + 1).alias("step"), F.concat(kept, repeated).alias("sequence"))


def actual_vs_forecast(
    actual: DataFrame, forecast: DataFrame, keys: Sequence[str], ts: str, actual_col: str, forecast_col: str
) -> DataFrame:
    """``(ts, keys, value, type)`` with both series stacked."""
    def part(df: DataFrame, c: str, kind: str) -> DataFrame:
        return df.select(ts, *keys, F.col(c).cast("double").alias("value"), F.lit(kind).alias("type"))

    return part(actual, actual_col, "actual").unionByName(part(forecast, forecast_col, "forecast"))
