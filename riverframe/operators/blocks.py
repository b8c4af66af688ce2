"""Sequences without copies: rows travel once, windows are cut where they are used.

A table of sequences (:func:`riverframe.operators.sequences.sequences`) repeats every row in ``n`` sequences. Here the rows of a key stay
in order, and

* :func:`score_rows` streams them to an injected model: the worker keeps the last ``n`` rows it has seen, and the ``(rows, n, f)``
  input of the model is a view of the rows themselves. A window never reaches over the start of a key, as every row knows its
  place. Each row is sent once, however long the sequences are; a key too long for one task is cut into chunks, which repeat
  ``n`` rows each;
* :func:`sequence_blocks` stores them: one row per ``size`` rows of a key with the ``n`` rows before them, from which
  ``size`` windows can be cut (:func:`windows_of`). The table is ``1 + n / size`` times its rows, instead of ``n`` times.

Row ``i + n`` of a key has the window ``i .. i + n - 1``, as in the table of sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverframe.operators.ordered import chunked, positions

BLOCK_ROWS = 256


def _point(features: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in features])


def score_rows(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    features: Sequence[str],
    n: int,
    make_model: Callable[[], Callable],
    out: str = "prediction",
    wanted: Column | None = None,
    category: str | None = None,
    batch: int = 1024,
    chunk: int | None = None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """``keys, ts, tiebreak, out`` for every row with ``n`` rows before it (of which only the ``wanted`` are scored).

    ``make_model`` and the model are those of :func:`riverframe.operators.models.score`; missing features are NaN to the model.
    """
    asked = F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False))
    place = F.col(category).cast("long") if category else F.lit(None).cast("long")
    kept = [*keys, ts, *tiebreak]
    slim = df.select(*kept, _point(features).alias("__x"), asked.alias("__asked"), place.alias("__place"))
    rows, by, order = chunked(slim, keys, ts, n, chunk, tiebreak)
    numbered = rows.withColumn("__at", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    # The window leaves the rows in this order; saying so costs nothing and holds whatever the planner does.
    numbered = numbered.sortWithinPartitions(*by, *order)
    scored = (F.col("__at") > n) & F.col("__asked")
    if "__copy" in rows.columns:
        scored &= ~F.col("__copy")
    sent = numbered.select(*kept, "__x", "__place", scored.alias("__score"))
    schema = T.StructType([*[slim.schema[c] for c in kept], T.StructField(out, T.DoubleType())])
    return sent.mapInArrow(_scorer(make_model, n, len(features), kept, out, bool(category), batch), schema)


def _scorer(make_model: Callable, n: int, f: int, kept: list[str], out: str, placed: bool, batch: int) -> Callable:
    """The function for the workers. An inner function travels by value, so they need not have this package."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        model, tail = make_model(), np.empty((0, f))
        for rows in batches:
            x = rows.column("__x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows.num_rows, f)
            seen = np.concatenate([tail, x])
            wanted = np.flatnonzero(rows.column("__score").to_numpy(zero_copy_only=False))
            values = np.empty(len(wanted))
            if len(wanted):
                place = rows.column("__place").fill_null(-1).to_numpy()
                windows = np.lib.stride_tricks.sliding_window_view(seen, n, axis=0).transpose(0, 2, 1)
                for a in range(0, len(wanted), batch):
                    part = wanted[a : a + batch]
                    # The row's place in what was seen, n rows back.
                    inputs = windows[part + len(tail) - n]
                    found = model(inputs, place[part]) if placed else model(inputs)
                    values[a : a + batch] = np.asarray(found, dtype=np.float64).reshape(len(part))
            tail = seen[-n:].copy()
            picked = rows.take(pa.array(wanted))
            yield pa.RecordBatch.from_arrays([*[picked.column(c) for c in kept], pa.array(values)], [*kept, out])

    return run


def sequence_blocks(
    df: DataFrame, keys: Sequence[str], ts: str, features: Sequence[str], n: int, label: str | None = None, size: int = BLOCK_ROWS, chunk: int | None = None
) -> DataFrame:
    """One row per block of a key: ``keys, block, n_before, n_windows, stamps, labels, x``.

    ``x`` holds the block's rows one after the other, led by the ``n_before`` rows (at most ``n``) before them; ``stamps`` and
    ``labels`` are those of the rows that have a window, which are the last ``n_windows``. Keys of at most ``n`` rows have no block.
    """
    target = F.col(label) if label else F.lit(None).cast("double")
    slim = df.select(*keys, F.col(ts).alias("__ts"), _point(features).alias("__x"), target.alias("__y"))
    placed = positions(slim, keys, "__ts", "__pos", chunk=chunk)
    home = F.floor((F.col("__pos") - 1) / size)
    last = F.floor((F.col("__pos") - 1 + n) / size)
    copies = placed.withColumn("__home", home).withColumn("block", F.explode(F.sequence(home, last)))
    row = F.struct("__pos", (F.col("block") > F.col("__home")).alias("before"), "__ts", "__y", "__x")
    held = copies.groupBy(*keys, "block").agg(F.array_sort(F.collect_list(row)).alias("__rows"))
    inside = F.filter("__rows", lambda r: ~r["before"] & (r["__pos"] > n))
    return held.withColumn("__in", inside).filter(F.size("__in") > 0).select(
        *keys, "block", F.size(F.filter("__rows", lambda r: r["before"])).alias("n_before"), F.size("__in").alias("n_windows"),
        F.transform("__in", lambda r: r["__ts"]).alias("stamps"), F.transform("__in", lambda r: r["__y"]).alias("labels"),
        F.flatten(F.transform("__rows", lambda r: r["__x"])).alias("x"),
    )


def windows_of(x: np.ndarray, n: int, f: int, n_windows: int) -> np.ndarray:
    """The windows of a stored block as a ``(n_windows, n, f)`` view: each ends right before its row."""
    rows = np.asarray(x, dtype=np.float64).reshape(-1, f)
    views = np.lib.stride_tricks.sliding_window_view(rows, n, axis=0).transpose(0, 2, 1)
    return views[len(rows) - n_windows - n : len(rows) - n]
