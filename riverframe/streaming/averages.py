"""Exponential averages on a stream of landed readings, with keyed state.

The averages need the readings of a key in order, and a stream brings them out of order. So a key's state holds the readings
of its open units of time (a day by default) besides its last averages. A unit is released once the watermark has passed its
end: its readings are put in order, averaged on from the stored averages and emitted. A timer at the end of the
first open unit releases it also where the key gets no further readings. What arrives after the release of its unit is dropped,
as the daily roll-up drops it.

The state of a key is bounded by the readings of ``lateness`` and one unit; shorter units bound it closer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "averages array<double>, gap long, released long, stamps array<long>, ties array<long>, readings array<double>"


def averages_on(x: np.ndarray, before: np.ndarray, gap: int, alphas: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Averages of ordered values that go on from ``before`` (NaN: none yet), whose last value is ``gap`` rows ago.

    Returns one row of averages per value, the last of them, and the rows since the last value that was there.
    """
    out, last, q = np.empty((len(x), len(alphas))), before, 1.0 - alphas
    for i, value in enumerate(x):
        gap += 1
        if value == value:
            old = q**gap
            last = np.where(np.isnan(last), value, (old * last + alphas * value) / (old + alphas))
            gap = 0
        out[i] = last
    return out, last, gap


def _release(keys: list[str], alphas: Mapping[str, float], unit: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """The function of a key: its new readings join the open ones, closed units leave."""
    factors = np.array(list(alphas.values()), float)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            last, gap, released, *stored = state.get
            last = np.array(last, float)
        else:
            last, gap, released, stored = np.full(len(factors), np.nan), 0, None, ([], [], [])
        parts = [[np.array(c, t)] for c, t in zip(stored, (np.int64, np.int64, float), strict=True)]
        for batch in () if state.hasTimedOut else batches:
            fresh = batch if released is None else batch[batch["__us"] >= released]
            for part, c in zip(parts, ("__us", "__tie", "__x"), strict=True):
                part.append(fresh[c].to_numpy())
        us, tie, x = (np.concatenate(p) for p in parts)
        order = np.lexsort((tie, us))
        us, tie, x = us[order], tie[order], x[order].astype(float)
        closed = state.getCurrentWatermarkMs() * 1000 // unit * unit
        n = int(np.searchsorted(us, closed))
        found, last, gap = averages_on(x[:n], last, gap, factors)
        released = closed if released is None else max(released, closed)
        state.update((last.tolist(), int(gap), int(released), us[n:].tolist(), tie[n:].tolist(), x[n:].tolist()))
        if n < len(us):
            state.setTimeoutTimestamp(int(us[n] // unit + 1) * unit // 1000)
        if n:
            columns = {k: pd.Series([v] * n, dtype=object) for k, v in zip(keys, key, strict=True)}
            columns |= {"__us": us[:n], "__tie": tie[:n], "__x": x[:n]} | {f"__y{i}": found[:, i] for i in range(len(factors))}
            yield pd.DataFrame(columns)

    return run


def ema_stream(
    readings: DataFrame,
    keys: Sequence[str],
    ts: str,
    c: str,
    alphas: Mapping[str, float],
    tiebreak: str | None = None,
    lateness: str = "2 days",
    unit_seconds: int = 86_400,
) -> DataFrame:
    """Several averages of one column, row by row, as ``emas`` gives them on a table without the late rows.

    ``tiebreak`` is a whole-number column that orders equal stamps (0 where missing). Missing values repeat the last average and older
    weights decay over them. Rows without a stamp are dropped; rows without a key are one series. Other columns do not
    pass through: the state would hold them.
    """
    if not alphas or not all(0.0 < a <= 1.0 for a in alphas.values()):
        raise ValueError("averages need factors in (0, 1]")
    if unit_seconds < 1:
        raise ValueError("a unit has one second at least")
    keys, kinds = list(keys), readings.schema
    tie = F.coalesce(F.col(tiebreak).cast("long"), F.lit(0)) if tiebreak else F.lit(0).cast("long")
    stamped = readings.filter(F.col(ts).isNotNull()).withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", lateness)
    rows = stamped.select(*keys, "__ts", F.unix_micros("__ts").alias("__us"), tie.alias("__tie"), F.col(c).cast("double").alias("__x"))
    fields = [T.StructField(k, kinds[k].dataType) for k in keys] + [T.StructField("__us", T.LongType()), T.StructField("__tie", T.LongType())]
    fields += [T.StructField(n, T.DoubleType()) for n in ["__x", *(f"__y{i}" for i in range(len(alphas)))]]
    made = rows.groupBy(*keys).applyInPandasWithState(
        _release(keys, alphas, unit_seconds * 1_000_000), T.StructType(fields), STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    tied = [F.col("__tie").alias(tiebreak)] if tiebreak else []
    values = [F.nanvl("__x", F.lit(None)).alias(c), *(F.nanvl(f"__y{i}", F.lit(None)).alias(n) for i, n in enumerate(alphas))]
    return made.select(*keys, F.timestamp_micros("__us").cast(kinds[ts].dataType).alias(ts), *tied, *values)
