"""Row positions and windows that do not put a whole key in one task.

A series that a roll-up has brought to daily grain is bounded by the calendar (about 366 rows a
year and key), so an ordinary ``partitionBy(key)`` window is safe there; callers say so with
``chunk=DAILY``. A raw series has no such bound, whatever the type of its time column: one sensor may
hold a third of all readings. There the rows of the largest key are counted first; if one task can sort
them, an ordinary window is used, and otherwise the functions here

1. count rows per (key, time bucket), which partial aggregation makes small, and cut buckets
   that are still too large,
2. turn the counts into a running offset per key: one row per bucket, not per reading,
3. number the rows inside each bucket and add the offset: exact global positions per key,
4. cut each key into chunks of equal length by position and copy the last ``back`` rows of a
   chunk to the next one, so that a window over a chunk sees what a window over the key sees.

The bucket is a function of the row alone, so a retried task repeats the same cut. Rows without a key are
one series of their own on both ways.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverframe.functions.columns import wall_micros
from riverframe.operators.joins import join_groups
from riverframe.operators.settle import settle

CHUNK_ROWS = 50_000
DAY = 86_400
DATE_BUCKET = 64 * DAY
STAMP_BUCKET = 3_600
HOT_ROWS = 2_000_000
FINER = 256


#: Chunk length for tables that a roll-up has brought to one row per key (and variant) and day: an ordinary window.
DAILY = 0
#: One column for all keys of a row. Unlike its fields it is never NULL, and two of them with NULL fields are equal, so
#: that rows without a key are one series for windows, groups and joins alike.
KEY = "__key"


def is_date(df: DataFrame, ts: str) -> bool:
    return isinstance(df.schema[ts].dataType, T.DateType)


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(KEY, F.struct(*keys))


def use_chunks(df: DataFrame, keys: Sequence[str], ts: str, chunk: int | None, hot_rows: int = HOT_ROWS) -> int:
    """Chunk length to use, 0 for an ordinary window. Without ``chunk`` the rows of the largest key are counted.

    Either way gives the same rows and values; only the cost differs.
    """
    if chunk is not None:
        return chunk
    largest = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    return CHUNK_ROWS if (largest or 0) > hot_rows else 0


def micros_of(df: DataFrame, ts: str) -> Column:
    """Microseconds that rise with the time column. A zone-less stamp is read off its own wall
    clock: through the session zone, hours that its clock skips would change places."""
    if is_date(df, ts):
        return F.unix_date(F.col(ts)).cast("bigint") * (DAY * 1_000_000)
    return wall_micros(ts) if isinstance(df.schema[ts].dataType, T.TimestampNTZType) else F.unix_micros(ts)


def time_bucket(df: DataFrame, ts: str, width: int | None = None) -> Column:
    width = width or (DATE_BUCKET if is_date(df, ts) else STAMP_BUCKET)
    return F.floor(micros_of(df, ts) / (width * 1_000_000))


def cells(
    df: DataFrame, keys: Sequence[str], ts: str, width: int | None = None, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Cut every key into time cells that one task can sort.

    Returns the rows with ``__key``, ``__bucket`` and ``__piece``, and the row count of each cell. The
    counts per bucket are written once and looked at: only if some bucket holds more than
    ``hot_rows`` rows of a key (a burst, or one bucket with a third of all data) are such
    buckets cut further, each into equal spans of its own first to last stamp. The spans are
    ``FINER`` times shorter than evenly spread rows would need, so that a burst inside the
    bucket is cut too.
    """
    tagged = keyed(df, keys).withColumns({"__bucket": time_bucket(df, ts, width), "__piece": F.lit(0).cast("bigint")})
    at = micros_of(df, ts)
    sizes = settle(
        tagged.groupBy(KEY, "__bucket").agg(
            F.count("*").alias("__rows"), F.min(at).alias("__first"), F.max(at).alias("__final")
        ),
        "cells",
    )
    hot = sizes.filter(F.col("__rows") > hot_rows)
    if hot.isEmpty():
        return tagged, sizes.select(KEY, "__bucket", F.lit(0).cast("bigint").alias("__piece"), "__rows")
    span = (F.col("__final") - F.col("__first") + 1) * (F.lit(hot_rows / FINER) / F.col("__rows"))
    cuts = hot.select(KEY, "__bucket", "__first", F.greatest(F.ceil(span), F.lit(1)).alias("__span"))
    piece = F.coalesce(F.floor((at - F.col("__first")) / F.col("__span")), F.lit(0))
    cut = join_groups(tagged, cuts, [KEY, "__bucket"], measured=True).withColumn("__piece", piece).drop("__first", "__span")
    counted = cut.groupBy(KEY, "__bucket", "__piece").agg(F.count("*").alias("__rows"))
    return cut, counted


def positions(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    out: str = "position",
    total: str | None = None,
    tiebreak: Sequence[str] = (),
    width: int | None = None,
    hot_rows: int = HOT_ROWS,
    chunk: int | None = None,
) -> DataFrame:
    """1-based position of each row within its key in ``(ts, tiebreak)`` order; rows without a key are one series.

    ``width`` is the bucket length in seconds. ``total`` adds the row count of the key.
    ``chunk`` as in :func:`add_rows`; any number but 0 numbers by cells.
    """
    if not use_chunks(df, keys, ts, chunk, hot_rows):
        by_key = Window.partitionBy(*keys)
        plain = {out: F.row_number().over(by_key.orderBy(ts, *tiebreak))}
        return df.withColumns(plain | ({total: F.count("*").over(by_key)} if total else {}))
    cell = [KEY, "__bucket", "__piece"]
    tagged, counts = cells(df, keys, ts, width, hot_rows)
    by_key = Window.partitionBy(KEY)
    before = F.sum("__rows").over(by_key.orderBy(*cell[1:]).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(
        *cell,
        F.coalesce(before, F.lit(0)).alias("__before"),
        *([F.sum("__rows").over(by_key).alias(total)] if total else []),
    )
    numbered = tagged.withColumn("__inside", F.row_number().over(Window.partitionBy(*cell).orderBy(ts, *tiebreak)))
    return (
        join_groups(numbered, offsets, cell)
        .withColumn(out, F.col("__before") + F.col("__inside"))
        .drop(*cell, "__before", "__inside")
    )


@dataclass(frozen=True)
class RowExpr:
    """A window expression and how many rows before the current one it reads."""

    back: int
    build: Callable[[WindowSpec], Column]


def add_rows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    exprs: Mapping[str, RowExpr],
    tiebreak: Sequence[str] = (),
    chunk: int | None = None,
    width: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add window columns over one shared window: one shuffle and one sort for all of them.

    ``chunk=None`` picks an ordinary window where the largest key has at most ``hot_rows`` rows, and
    chunks otherwise; 0 (``DAILY``) forces the window, a number chunks of that many rows.
    """
    back = max(e.back for e in exprs.values())
    rows, by, order = chunked(df, keys, ts, back, chunk, tiebreak, width, hot_rows)
    spec = Window.partitionBy(*by).orderBy(*order)
    out = rows.withColumns({name: e.build(spec) for name, e in exprs.items()})
    return out if by == list(keys) else out.filter(~F.coalesce("__copy", F.lit(False))).drop("__pos", "__chunk", "__copy")


def chunked(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    back: int,
    chunk: int | None = None,
    tiebreak: Sequence[str] = (),
    width: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, list[str], list[str]]:
    """Rows to be windowed, with the columns to partition and to order by.

    Of keys that one task can sort that is the table itself. Otherwise every key is cut into chunks; the last ``back`` rows of a
    chunk are in the next one as well, marked by ``__copy``.
    """
    size = use_chunks(df, keys, ts, chunk, hot_rows)
    if not size:
        return df, list(keys), [ts, *tiebreak]
    size = max(size, back, 1)
    placed = positions(df, keys, ts, "__pos", None, tiebreak, width, hot_rows, size)
    home = F.floor((F.col("__pos") - 1) / size)
    in_chunk = (F.col("__pos") - 1) % size
    cells = F.when(in_chunk >= size - back, F.array(home, home + 1)).otherwise(F.array(home))
    copied = placed.withColumn("__chunk", F.explode(cells)).withColumn("__copy", F.col("__chunk") != home)
    return copied, [*keys, "__chunk"], ["__pos"]


def ranges_of(counts: DataFrame, key: str, n: str) -> tuple[DataFrame, int]:
    """The rows of a table with one row per ``key``, with ``__before`` (the sum of ``n`` over all smaller keys), and the sum of all.

    The table is cut into ranges of keys by Spark's own range partitioning and written with the number of the range, so that
    every reader sees the same cut; a range is ordered on its own and only one row per range is ordered across all.
    """
    ranged = settle(counts.repartitionByRange(key).withColumn("__range", F.spark_partition_id()), "key-ranges")
    earlier = Window.unboundedPreceding, -1
    ranges = ranged.groupBy("__range").agg(F.sum(n).alias("__n"))
    between = F.sum("__n").over(Window.orderBy("__range").rowsBetween(*earlier))
    bases = ranges.select("__range", F.coalesce(between, F.lit(0)).alias("__base"))
    inside = F.sum(n).over(Window.partitionBy("__range").orderBy(key).rowsBetween(*earlier))
    placed = join_groups(ranged.withColumn("__inside", F.coalesce(inside, F.lit(0))), bases, ["__range"])
    before = placed.withColumn("__before", F.col("__inside") + F.col("__base"))
    return before.drop("__range", "__inside", "__base"), ranges.agg(F.sum("__n")).first()[0] or 0
