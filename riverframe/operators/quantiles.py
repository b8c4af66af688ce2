"""Exact quantiles with linear interpolation that survive one huge group.

Spark's ``percentile`` keeps every distinct value of a group in one reducer. Groups of more than ``SMALL_GROUP`` values are
narrowed by a mergeable sketch first: one pass makes a KLL sketch of every column and group, whose values a little below and above the
wanted ranks bracket each quantile. In a second pass the values outside the brackets collapse to one stand-in per gap, equal values are
counted in parallel, and ``percentile`` then sees only the counted values inside: ``SPREAD`` of the ranks at most for each
quantile. Collapsing keeps the order and the row count, so the answer is the exact one. Two passes do for tens of millions of values
a group; beyond that, what lies inside the brackets is counted and sketched again before it is gathered, and each such
pass narrows it by the same factor. The input is never copied.

A sketch may be wrong about its ranks, if with a probability that is not worth naming. The answer then lies outside its bracket, and
the groups are counted in bins instead (``method="binned"``): bins of equal ratio (``PER_OCTAVE`` to every doubling), which an outlier of
any size cannot widen, then, as long as a bin holds more than ``SMALL_GROUP`` values, ``BINS`` equal bins inside it. An answer
outside its bin raises.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverframe.functions.columns import nan_to_null
from riverframe.operators.joins import join_groups
from riverframe.operators.settle import settle

ACCURACY = 20_000
BINS = 65_536
PER_OCTAVE = 64
SMALL_GROUP = 50_000
PASSES = 6
#: Size of a sketch, and how far a bracket reaches from its rank to either side: three times the rank error of such a sketch at 99 %.
SKETCH = 4000
REACH = 3 * 2.296 / SKETCH**0.9723
SPREAD = 2 * REACH
#: Values that are gathered between the ends of one bracket.
GATHERED = 100_000
GRID = 512
GROUP = "__group"


def quantiles_long(
    df: DataFrame,
    cols: Sequence[str],
    ps: Sequence[float],
    by: Sequence[str] = (),
    method: str = "exact",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per group and column: ``(by..., metric, q ARRAY<DOUBLE>)`` in the order of ``ps``.

    ``method``: ``exact`` (by sketches), ``binned`` (exact, without sketches), ``plain`` (Spark's percentile; for groups known to be
    small, such as the days of one station) or ``approx`` (sketch only).
    """
    ps = [float(p) for p in ps]
    known = df.select(*by, *[nan_to_null(F.col(c).cast("double")).alias(f"__{i}") for i, c in enumerate(cols)])
    wanted = F.array(*[F.lit(p) for p in ps])
    if method == "plain":
        return _per_metric(known, cols, by, lambda c: F.percentile(c, wanted), "q")
    if method == "approx":
        return _per_metric(known, cols, by, lambda c: F.percentile_approx(c, wanted, accuracy), "q")
    if method == "exact":
        return _sketched(known, list(cols), list(by), ps)
    if method != "binned":
        raise ValueError(f"unknown quantile method {method!r}")
    return _binned(known, list(cols), list(by), ps)


def _per_metric(known: DataFrame, cols: Sequence[str], by: Sequence[str], fn, out: str) -> DataFrame:
    """One wide aggregate, then one row per column that has any value."""
    row = known.groupBy(*by).agg(*[fn(F.col(f"__{i}")).alias(f"__{i}") for i in range(len(cols))])
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"__{i}").alias(out)) for i, c in enumerate(cols)])
    return row.select(*by, F.explode(cells).alias("__cell")).select(*by, "__cell.*").filter(F.col(out).isNotNull())


# -- by sketches ------------------------------------------------------------------


def _sketched(known: DataFrame, cols: list[str], by: list[str], ps: list[float]) -> DataFrame:
    order, values = sorted(set(ps)), [f"__{i}" for i in range(len(cols))]
    sketch = lambda v: F.struct(F.count(v).alias("n"), F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias("sketch")).alias(v)
    wide = known.groupBy(*by).agg(*[sketch(v) for v in values])
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), f"{v}.*") for c, v in zip(cols, values, strict=True)])
    sketches = wide.select(*by, F.explode(cells).alias("__cell")).select(*by, "__cell.*")
    first = F.array(*[_bracket(i, *_first_ends(p)) for i, p in enumerate(order)])
    big = F.when(F.col("n") > SMALL_GROUP, first)
    # A small table; without groups it is a row per column, which stays at hand.
    keep = (lambda df, name: settle(df, name)) if by else (lambda df, name: df.sparkSession.createDataFrame(df.collect(), df.schema))
    sides = keep(sketches.select(_group(by), "n", big.alias("__sides"), (F.col("n") * F.lit(SPREAD)).alias("__inside")), "quantile-limits")
    largest = sides.agg(F.max("n"), F.max("__inside")).first()
    if (largest[0] or 0) <= SMALL_GROUP:
        return _per_metric(known, cols, by, lambda c: F.percentile(c, F.array(*[F.lit(p) for p in ps])), "q")
    long = _long(known, cols, by, [F.col(v) for v in values])
    inside = largest[1]
    for _ in range(PASSES):
        if inside <= GATHERED:
            break
        sides = keep(_narrowed(known, long, cols, by, sides, order), "quantile-limits")
        inside = sides.agg(F.max("__inside")).first()[0]
    sides = sides.filter(F.col("__sides").isNotNull()).select(GROUP, "__sides")
    found = _from_sides(long, sides, by, ps, _inside_or_null) if by else _from_row(known, cols, sides, ps)
    found = keep(found, "quantiles")
    missed = found.filter(F.exists("q", lambda q: q.isNull()))
    return found if missed.isEmpty() else _binned(known, cols, by, ps)


def _long(known: DataFrame, cols: Sequence[str], by: Sequence[str], values: Sequence[Column]) -> DataFrame:
    """One row per group, column and value."""
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), v.alias("value")) for c, v in zip(cols, values, strict=True)])
    return known.select(*by, F.explode(cells).alias("__cell")).select(*by, "__cell.*").filter(F.col("value").isNotNull()).select(_group(by), "value")


def _from_row(known: DataFrame, cols: Sequence[str], sides: DataFrame, ps: Sequence[float]) -> DataFrame:
    """Without groups the brackets are a row per column: their ends become literals, and values collapse before they are laid out in rows."""
    held = {r[GROUP]["metric"]: [F.lit(float(e)) for side in r["__sides"] for e in (side["lo"], side["hi"])] for r in sides.collect()}
    values = [_collapse(F.col(f"__{i}"), held[c]) if c in held else F.col(f"__{i}") for i, c in enumerate(cols)]
    values = [F.when(F.col(f"__{i}").isNotNull(), v) for i, v in enumerate(values)]
    counted = _long(known, cols, [], values).groupBy(GROUP, "value").agg(F.count("*").alias("__n"))
    picked = counted.groupBy(GROUP).agg(F.percentile("value", F.array(*[F.lit(p) for p in ps]), F.col("__n")).alias("q"))
    return join_groups(picked, sides, [GROUP]).select(f"{GROUP}.*", _checked(ps, _sides_edge, _inside_or_null)).select("metric", "q")


def _bracket(i: int, lo: Column, hi: Column) -> Column:
    return F.struct(F.lit(i).alias("i"), lo.cast("double").alias("lo"), hi.cast("double").alias("hi"))


def _first_ends(p: float) -> tuple[Column, Column]:
    """The sketch's values a little below and above a rank."""
    at = lambda share: F.kll_sketch_get_quantile_double(F.col("sketch"), F.lit(share))
    return at(p - REACH) if p > REACH else F.lit(float("-inf")), at(p + REACH) if p + REACH < 1 else F.lit(float("inf"))


def _narrowed(known: DataFrame, long: DataFrame, cols: Sequence[str], by: Sequence[str], sides: DataFrame, order: Sequence[float]) -> DataFrame:
    """The brackets, narrowed by exact counts below and on their ends and a sketch of what lies between.

    Rows are counted where they are read: a bracket is a group of columns, not a row that the values would have to meet in one task."""
    asked = sides.filter(F.col("__sides").isNotNull())
    if by:
        ends = [(F.col(f"__lo_{k}"), F.col(f"__hi_{k}")) for k in range(len(order))]
        flat = asked.select(GROUP, "n", *[F.col("__sides")[k][side].alias(f"__{side}_{k}") for k in range(len(order)) for side in ("lo", "hi")])
        row = long.join(flat, GROUP).groupBy(GROUP, "n").agg(*[_between(k, F.col("value"), *end) for k, end in enumerate(ends)])
        cells = F.array(*[F.struct(F.lit(k).alias("i"), f"__{k}.*") for k in range(len(order))])
        counted = row.select(GROUP, "n", F.explode(cells).alias("__cell")).select(GROUP, "n", "__cell.*")
    else:
        held = [(f"__{cols.index(r[GROUP]['metric'])}", r[GROUP]["metric"], r["n"], s) for r in asked.collect() for s in r["__sides"]]
        row = known.agg(*[_between(k, F.col(c), F.lit(s["lo"]), F.lit(s["hi"])) for k, (c, _, _, s) in enumerate(held)])
        cells = F.array(*[
            F.struct(F.struct(F.lit(metric).alias("metric")).alias(GROUP), F.lit(n).cast("bigint").alias("n"), F.lit(s["i"]).alias("i"), f"__{k}.*")
            for k, (_, metric, n, s) in enumerate(held)
        ])
        counted = row.select(F.explode(cells).alias("__cell")).select("__cell.*")
    lo, hi = F.col("lo"), F.col("hi")
    rank = F.element_at(F.array(*[F.lit(p) for p in order]), F.col("i") + 1) * (F.col("n") - 1)
    size = F.col("size")
    first, last = (r - F.col("below") - F.col("low") for r in (F.floor(rank), F.ceil(rank)))
    # Ranks must be constants: the values at a grid of them, of which the next one outside is taken.
    grid = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(k / GRID) for k in range(GRID + 1)]))
    at = lambda place: F.get(F.col("grid"), F.greatest(F.least(place, F.lit(GRID)), F.lit(0)).cast("int"))
    counted = counted.withColumn("grid", F.when(F.col("size") > 0, grid))
    down, up = F.try_divide(first, size) - REACH, F.try_divide(last + 1, size) + REACH
    new_lo = F.when(first >= size, hi).when((first < 0) | (down <= 0), lo).otherwise(at(F.floor(down * GRID)))
    new_hi = F.when(last < 0, lo).when((last >= size) | (up >= 1), hi).otherwise(at(F.ceil(up * GRID)))
    side = F.struct(F.col("i"), new_lo.cast("double").alias("lo"), new_hi.cast("double").alias("hi"))
    left = F.when(new_lo < new_hi, size * F.lit(SPREAD)).otherwise(F.lit(0.0))
    return counted.select(GROUP, "n", side.alias("side"), left.alias("left")).groupBy(GROUP, "n").agg(F.array_sort(F.collect_list("side")).alias("__sides"), F.max("left").alias("__inside"))


def _between(k: int, x: Column, lo: Column, hi: Column) -> Column:
    """The ends of a bracket, how many values lie below and on its lower end, and a sketch of those between."""
    between = F.when((x > lo) & (x < hi), x)
    return F.struct(
        F.max(lo).alias("lo"), F.max(hi).alias("hi"), F.count_if(x < lo).alias("below"), F.count_if(x == lo).alias("low"),
        F.count(between).alias("size"), F.kll_sketch_agg_double(between, F.lit(SKETCH)).alias("sketch"),
    ).alias(f"__{k}")


def _inside_or_null(answer: Column, low: Column, high: Column) -> Column:
    return F.when((answer >= low) & (answer <= high), answer)


# -- by bins -----------------------------------------------------------------------


def _binned(known: DataFrame, cols: list[str], by: list[str], ps: list[float]) -> DataFrame:
    """The sizes are counted in one pass. Where all groups are small that is all; otherwise the columns are
    written once, and every further pass reads them from there."""
    counted = known.groupBy(*by).agg(*[F.count(f"__{i}").alias(f"__{i}") for i in range(len(cols))])
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"__{i}").alias("n")) for i, c in enumerate(cols)])
    sizes = counted.select(*by, F.explode(cells).alias("__cell")).select(*by, "__cell.*")
    big = settle(sizes.filter(F.col("n") > SMALL_GROUP).select(_group(by), "n"), "quantile-sizes")
    if big.isEmpty():
        return _per_metric(known, cols, by, lambda c: F.percentile(c, F.array(*[F.lit(p) for p in ps])), "q")
    stored = settle(known, "quantile-values")
    return _counted_inside(_long(stored, cols, by, [F.col(f"__{i}") for i in range(len(cols))]), big, by, ps)


def _group(by: Sequence[str]) -> Column:
    """All group columns as one, which is never NULL: rows without a key are a group like any other."""
    return F.struct(*by, "metric").alias(GROUP)


def _counted_inside(long: DataFrame, big: DataFrame, by: list[str], ps: list[float]) -> DataFrame:
    sides = brackets(long, big, sorted(ps)).groupBy(GROUP).agg(F.array_sort(F.collect_list(F.struct("i", "lo", "hi"))).alias("__sides"))
    return _from_sides(long, settle(sides, "groups"), by, ps, _check)


def _sides_edge(k: int, side: str) -> Column:
    """An end of the k-th bracket; a group without brackets is small, and its ends are open."""
    return F.coalesce(F.col("__sides")[k][side], F.lit(float("-inf" if side == "lo" else "inf")))


def _checked(ps: Sequence[float], edge, checked) -> Column:
    place = {p: i for i, p in enumerate(sorted(set(ps)))}
    return F.array(*[checked(F.col("q")[i], edge(place[p], "lo"), edge(place[p], "hi")) for i, p in enumerate(ps)]).alias("q")


def _from_sides(long: DataFrame, sides: DataFrame, by: Sequence[str], ps: Sequence[float], checked) -> DataFrame:
    """Quantiles from the values inside the brackets of each group; a group without brackets is counted whole."""
    spots = [(k, side) for k in range(len(set(ps))) for side in ("lo", "hi")]
    # The ends travel as plain columns: reading them out of an array for every row would cost more than all the rest.
    flat = sides.select(GROUP, *[F.col("__sides")[k][side].alias(f"__{side}_{k}") for k, side in spots])
    edge = lambda k, side: F.coalesce(F.col(f"__{side}_{k}"), F.lit(float("-inf" if side == "lo" else "inf")))
    edges = [edge(k, side) for k, side in spots]
    ends = [F.first(f"__{side}_{k}").alias(f"__{side}_{k}") for k, side in spots]
    counted = join_groups(long, flat, [GROUP]).groupBy(GROUP, _collapse(F.col("value"), edges).alias("value")).agg(F.count("*").alias("__n"), *ends)
    picked = counted.groupBy(GROUP).agg(F.percentile("value", F.array(*[F.lit(p) for p in ps]), F.col("__n")).alias("q"), *ends)
    return picked.select(f"{GROUP}.*", _checked(ps, edge, checked)).select(*by, "metric", "q")


def brackets(long: DataFrame, big: DataFrame, ps: Sequence[float]) -> DataFrame:
    """``(group, i, p, n, lo, hi, below, inside)``: the values between which the ranks around the i-th quantile lie.

    ``below`` counts the values under ``lo``, ``inside`` those from ``lo`` to ``hi``.
    """
    v = F.col("value")
    ratio = F.floor(F.log2(F.least(F.abs(v), F.lit(sys.float_info.max))) * PER_OCTAVE) + 1100 * PER_OCTAVE  # positive for every double; rises with its size
    octave = F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("bigint") * ratio)
    asked = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(ps)]))
    bins = join_groups(long, big, [GROUP], measured=True).filter(F.col("n").isNotNull()).groupBy(GROUP, "n", octave.alias("__bin"))
    counts = bins.agg(F.count("*").alias("__rows"), F.min(v).alias("__min"), F.max(v).alias("__max"))
    ranked = counts.withColumn("__upto", F.sum("__rows").over(Window.partitionBy(GROUP).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)))
    found = settle(_holding(ranked.select("*", asked.alias("__ask")).select("*", "__ask.*")), "quantile-brackets")
    for _ in range(PASSES):
        wide = found.filter((F.col("inside") > SMALL_GROUP) & (F.col("lo") < F.col("hi")))
        if wide.isEmpty():
            break
        inside = long.join(wide, GROUP).filter(v.between(F.col("lo"), F.col("hi")))
        place = F.width_bucket(v, F.col("lo"), F.col("hi"), F.lit(BINS))
        counts = inside.groupBy(GROUP, "i", "p", "n", "below", place.alias("__bin")).agg(F.count("*").alias("__rows"), F.min(v).alias("__min"), F.max(v).alias("__max"))
        upto = F.col("below") + F.sum("__rows").over(Window.partitionBy(GROUP, "i").orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0))
        finer = _holding(counts.withColumn("__upto", upto).drop("below"))
        done = found.filter((F.col("inside") <= SMALL_GROUP) | (F.col("lo") >= F.col("hi")))
        found = settle(done.unionByName(finer), "quantile-brackets")
    return found


def _holding(ranked: DataFrame) -> DataFrame:
    """The bins that hold the rank below and the rank above each quantile, as one bracket."""
    rank = F.col("p") * (F.col("n") - 1)
    holds = lambda r: (r < F.col("__upto")) & (r >= F.col("__upto") - F.col("__rows"))
    held = ranked.filter(holds(F.floor(rank)) | holds(F.ceil(rank)))
    return held.groupBy(GROUP, "i", "p", "n").agg(
        F.min("__min").alias("lo"), F.max("__max").alias("hi"), F.min(F.col("__upto") - F.col("__rows")).alias("below"), F.sum("__rows").alias("inside")
    )


def _collapse(value: Column, edges: Sequence[Column]) -> Column:
    """Keep values inside a bracket; values in a gap share one stand-in inside that gap."""
    out = F.when(value < edges[0], F.lit(float("-inf")))
    for i in range(0, len(edges), 2):
        out = out.when(value <= edges[i + 1], value)
        if i + 2 < len(edges):
            out = out.when(value < edges[i + 2], (edges[i + 1] + edges[i + 2]) / 2)
    return out.otherwise(F.lit(float("inf")))


def _check(answer: Column, low: Column, high: Column) -> Column:
    inside = (answer >= low) & (answer <= high)
    broken = F.raise_error(F.lit("quantile fell outside its bins"))
    return F.when(inside, answer).otherwise(broken.cast("double"))


def quantiles(
    df: DataFrame,
    ps: dict[str, float],
    by: Sequence[str] = (),
    method: str = "exact",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One column per entry of ``{column: p}``, one row per group (a single row without ``by``)."""
    wanted = sorted(set(ps.values()))
    long = quantiles_long(df, list(ps), wanted, by, method, accuracy)
    cells = [
        F.max(F.when(F.col("metric") == c, F.col("q")[wanted.index(p)])).alias(c) for c, p in ps.items()
    ]
    return long.groupBy(*by).agg(*cells) if by else long.agg(*cells)
