"""Profiles, counts, correlation and distribution summaries.

Everything that can share a scan shares one ``agg``; whole-table values reach rows as scalar
subqueries; group values reach rows by an equi-join whose strategy Catalyst picks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverframe.operators.joins import join_groups, with_row
from riverframe.operators.quantiles import quantiles_long
from riverframe.operators.resample import to_long

QUARTILES = (0.25, 0.5, 0.75)


def _grouped(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by) if by else df.groupBy()


# -- counts -----------------------------------------------------------------


def overview(df: DataFrame, ts: str, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count, first and last stamp, and min, max and mean of each value."""
    per_value = [
        f(c).alias(f"{name}_{c}") for c in values for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg))
    ]
    return _grouped(df, by).agg(
        F.count("*").alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), *per_value
    )


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).dropna().distinct().orderBy(c)


def n_distinct(df: DataFrame, c: str, approx: bool = False) -> DataFrame:
    """Distinct count. ``distinct`` first, so that the count itself is spread over all tasks."""
    if approx:
        return df.agg(F.approx_count_distinct(c).alias("n_distinct"))
    return df.select(c).dropna().distinct().agg(F.count("*").alias("n_distinct"))


def null_report(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """``(column, n_null, pct)`` for every column, from one pass."""
    cols = list(cols or df.columns)
    counts = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = to_long(counts, ["__n"], cols, "column", "n_null")
    pct = F.round(F.coalesce(F.try_divide(F.col("n_null") * 100.0, F.col("__n")), F.lit(0.0)), digits)
    return long.select("column", "n_null", pct.alias("pct"))


def count_where(df: DataFrame, predicates: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    return _grouped(df, by).agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])


def flag_sums(df: DataFrame, flags: Sequence[str], by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.sum(F.col(f).cast("bigint")).alias(f) for f in flags])


def value_share(df: DataFrame, c: str, digits: int = 2) -> DataFrame:
    """Frequency of each value in percent of all non-missing rows."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, digits))


def cross_count(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def label_ratio(df: DataFrame, y: str, by: Sequence[str] = ()) -> DataFrame:
    return _grouped(df, by).agg(F.avg(F.col(y).cast("double")).alias("ratio"))


def class_weights(df: DataFrame, y: str) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = df.groupBy(F.col(y).alias("label")).agg(F.count("*").alias("n"))
    held = with_row(counts, counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes")), "__t")
    weight = F.col("__t.rows") / (F.col("__t.classes") * F.col("n"))
    return held.select("label", "n", weight.cast("double").alias("weight"))


def min_usable_length(df: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """Smallest number of known values any key has: the longest sequence every key can fill."""
    per_key = df.groupBy(*keys).agg(F.count(c).alias("__known"))
    return per_key.agg(F.min("__known").alias("usable_length"))


def summary_long(df: DataFrame, metrics: Mapping[str, Column], digits: int | None = None) -> DataFrame:
    """One aggregate row turned into ``(metric, value)`` rows."""
    def shaped(c: Column) -> Column:
        c = c.cast("double")
        return c if digits is None else F.round(c, digits)

    row = df.agg(*[shaped(c).alias(name) for name, c in metrics.items()])
    return to_long(row, [], list(metrics), "metric", "value")


# -- distribution -----------------------------------------------------------


def describe(df: DataFrame, values: Sequence[str], by: Sequence[str] = (), method: str = "exact") -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max, one row per group and column."""
    group = [*by, "metric"]
    parts = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = _grouped(df, by).agg(
        *[F.struct(*[f(F.col(c).cast("double")).alias(n) for n, f in parts.items()]).alias(f"__{i}")
          for i, c in enumerate(values)]
    )
    cells = [F.struct(F.lit(c).alias("metric"), *[f"__{i}.{n}" for n in parts]) for i, c in enumerate(values)]
    moments = row.select(*by, F.explode(F.array(*cells)).alias("__cell")).select(*by, "__cell.*")
    quartiles = quantiles_long(df, values, QUARTILES, by, method)
    joined = join_groups(moments, quartiles, group)
    return joined.select(
        *group, "n", "mean", "std", "min",
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max",
    )


def box_stats(df: DataFrame, c: str, by: Sequence[str], method: str = "exact") -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and the number of values beyond."""
    quartiles = quantiles_long(df, [c], QUARTILES, by, method).select(
        *by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(c).between(F.col("q1") - reach, F.col("q3") + reach)
    known = df.select(*by, c).filter(F.col(c).isNotNull())
    return (
        join_groups(known, quartiles, by, measured=True)
        .groupBy(*by)
        .agg(
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.min(F.when(inside, F.col(c))).alias("lo_whisker"),
            F.max(F.when(inside, F.col(c))).alias("hi_whisker"),
            F.count_if(~inside).alias("n_outlier"),
        )
    )


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins are kept."""
    value = F.col(c).cast("double")
    known = df.select(value.alias("__v")).filter(F.col("__v").isNotNull())
    lo, hi = F.min("__v"), F.max("__v")
    # A constant column gets a unit-wide range around its value.
    ends = known.agg(
        F.when(lo == hi, lo - 0.5).otherwise(lo).alias("low"), F.when(lo == hi, hi + 0.5).otherwise(hi).alias("high")
    )
    bucket = F.width_bucket(F.col("__v"), F.col("__ends.low"), F.col("__ends.high"), F.lit(bins))
    place = F.least(bucket, F.lit(bins)).cast("int")
    counts = with_row(known, ends, "__ends").groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    step = (F.col("high") - F.col("low")) / bins
    frame = ends.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "low", "high").select(
        "bin",
        (F.col("low") + (F.col("bin") - 1) * step).alias("lo"),
        (F.col("low") + F.col("bin") * step).alias("hi"),
    )
    return frame.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


# -- correlation ------------------------------------------------------------


def corr_of(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both are known; NULL for a constant column."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def corr_pair(df: DataFrame, a: str, b: str, digits: int = 3, by: Sequence[str] = ()) -> DataFrame:
    return _grouped(df, by).agg(F.round(corr_of(a, b), digits).alias("corr"))


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """Pairwise-complete correlations ``(a, b, r)``, both triangles, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[corr_of(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    r = [F.col(f"r{i}") if digits is None else F.round(f"r{i}", digits) for i in range(len(pairs))]
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), r[i].alias("r")))
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def top_k(df: DataFrame, by: Sequence[str], k: int, descending: bool = True) -> DataFrame:
    """The k first rows in the given order; Spark merges per-task heads instead of sorting all."""
    order = [F.desc(c) if descending else F.asc(c) for c in by]
    return df.orderBy(*order).limit(k)
