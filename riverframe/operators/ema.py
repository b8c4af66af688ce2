"""Exponential moving average (recursive form, first value as seed) on built-in windows.

Without missing values, ``y_0 = x_0`` and ``y_t = (1 - a) y_{t-1} + a x_t``. With the rows of a key numbered, cut into
blocks of B rows and ``q = 1 - a``, the value at offset p of a block is

    q^p * sum_{i <= p} a x_i q^{-i}   +   q^{p+1} * carry

where the carry is the value at the end of the block before, and x_0 before the first block.
B is chosen so that ``q^-B`` stays far from overflow, which makes the sum an ordinary window
sum. A full block damps the carry it received by ``q^B``, so a carry folds the ends of the blocks before it,
as far back as a double could still hold what is left of them.

A missing value has no weight of its own, but the older weights decay over it: a value that is seen d rows after
the one before makes

    y = (q^d y_before + a x) / (q^d + a)

and a row without a value repeats the last average (none before the first value). That is a recurrence
``y = A y_before + B`` with a factor of its own at every value. Two running sums per block carry it: of the logarithms of A,
whose exponential is the weight left to the block's first average, and of ``B`` over that weight. As ``A >= q^d``, a block of
the same length bounds both. A block then says how its first value turns into its last average; these maps are folded over
the blocks before, each with its distance to the last value seen, however long the gap.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverframe.functions.columns import nan_to_null
from riverframe.operators.joins import join_groups
from riverframe.operators.ordered import HOT_ROWS, KEY, keyed, positions, use_chunks

MAX_BLOCK = 50_000
SAFE_EXPONENT = 600.0
VANISHED = 1500.0  # exp(-VANISHED) times the largest double is below the smallest one
FARTHEST = 1 << 31  # rows of a key; a series is not followed farther back


def alpha_of(span: float | None = None, alpha: float | None = None) -> float:
    if (span is None) == (alpha is None):
        raise ValueError("give either span or alpha")
    a = 2.0 / (span + 1.0) if alpha is None else alpha
    if not 0.0 < a <= 1.0:
        raise ValueError(f"alpha must be in (0, 1], not {a}")
    return a


def _block_length(alphas: Sequence[float]) -> int:
    decay = max(-math.log1p(-a) for a in alphas if a < 1.0)
    return max(1, min(MAX_BLOCK, int(SAFE_EXPONENT / decay)))


def ema(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    c: str,
    span: float | None = None,
    alpha: float | None = None,
    out: str | None = None,
    **how,
) -> DataFrame:
    return emas(df, keys, ts, c, {out or f"{c}_ema": alpha_of(span, alpha)}, **how)


def emas(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    c: str,
    alphas: Mapping[str, float],
    tiebreak: Sequence[str] = (),
    chunk: int | None = None,
    width: int | None = None,
    block: int | None = None,
    hot_rows: int = HOT_ROWS,
    missing: str = "skip",
) -> DataFrame:
    """Several averages of one column in a single pass.

    ``missing="skip"`` averages over the values that are there (NULL and NaN are missing). ``"error"`` is for a column
    known to be complete: it needs fewer windows, and a missing value fails the job.
    """
    if missing == "skip":
        return _over_gaps(df, list(keys), ts, c, dict(alphas), tiebreak, chunk, width, block, hot_rows)
    if missing != "error":
        raise ValueError(f"missing must be skip or error, not {missing!r}")
    plain = {n: a for n, a in alphas.items() if a < 1.0}
    out = df.withColumns({n: F.col(c) for n, a in alphas.items() if a >= 1.0})
    if not plain:
        return out
    length = block or _block_length(list(plain.values()))
    size = use_chunks(df, keys, ts, chunk, hot_rows)
    numbered = positions(out, keys, ts, "__pos", None, tiebreak, width, hot_rows, size)
    broken = F.raise_error(F.lit(f"column {c} has missing values; fill them before averaging"))
    placed = numbered.withColumns(
        {
            "__block": F.floor((F.col("__pos") - 1) / length),
            "__p": (F.col("__pos") - 1) % length,
            "__x": F.coalesce(F.col(c).cast("double"), broken.cast("double")),
        }
    )
    # Without chunks no join is needed, and the rows stay partitioned by the keys themselves.
    by = [KEY] if size else list(keys)
    in_block = Window.partitionBy(*by, "__block").orderBy("__p").rowsBetween(Window.unboundedPreceding, 0)
    rows = keyed(placed, keys) if size else placed
    local = rows.withColumns({f"__local_{i}": _local(a, in_block) for i, a in enumerate(plain.values())})
    carried = _carry_by_join if size else _carry_by_window
    helpers = [f"__{k}_{i}" for k in ("local", "carry") for i in range(len(plain))]
    return (
        carried(local, by, list(plain.values()), length)
        .withColumns(
            {
                n: F.col(f"__local_{i}") + F.pow(F.lit(1.0 - a), F.col("__p") + 1) * F.col(f"__carry_{i}")
                for i, (n, a) in enumerate(plain.items())
            }
        )
        .drop(KEY, "__pos", "__block", "__p", "__x", *helpers)
    )


def _local(alpha: float, in_block) -> Column:
    q = F.lit(1.0 - alpha)
    weighted = F.sum(F.lit(alpha) * F.col("__x") * F.pow(q, -F.col("__p"))).over(in_block)
    return weighted * F.pow(q, F.col("__p"))


def _depth(alpha: float, length: int) -> int:
    """Blocks after which nothing of a value is left in a double."""
    return max(1, math.ceil(VANISHED / (-math.log1p(-alpha) * length)))


def _ends_before(heads: DataFrame, by: Sequence[str], slot: Column, ends: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """Ordinary windows: at the first row of every block the ends of the blocks before, oldest first, without a join.

    ``ends`` gives for a name what the row before the head, the last of its block, holds, and how far back ``slot`` is followed. The heads are
    windowed apart from the other rows, which lie too far from each other to see one, so that no list is made for them.
    """
    deepest = max(depth for _, depth in ends.values()) + 1
    # (block, place in block) is the order the rows are in already.
    before = Window.partitionBy(*by).orderBy("__block", "__p")
    head = F.col("__p") == 0
    found = heads.withColumns({f"{n}_end": F.when(head, F.lag(end).over(before)) for n, (end, _) in ends.items()})
    found = found.withColumns({"__head": head, "__slot": F.when(head, slot).otherwise(F.col("__pos")).cast("bigint") * F.when(head, F.lit(1)).otherwise(F.lit(deepest)).cast("bigint")})
    by_head = Window.partitionBy(*by, "__head").orderBy("__slot")
    lists = {n: F.collect_list(f"{n}_end").over(by_head.rangeBetween(-depth, 0)) for n, (_, depth) in ends.items()}
    return found.withColumns(lists).drop("__head", "__slot", *[f"{n}_end" for n in ends])


def _spread(heads: DataFrame, by: Sequence[str], starts: Mapping[str, Column]) -> DataFrame:
    """What is worked out at the first row of a block, on all its rows."""
    in_block = Window.partitionBy(*by, "__block").orderBy("__p")
    held = heads.withColumns({n: F.when(F.col("__p") == 0, start) for n, start in starts.items()})
    return held.withColumns({n: F.first(n).over(in_block) for n in starts})


def _carry_by_window(local: DataFrame, by: Sequence[str], alphas: Sequence[float], length: int) -> DataFrame:
    """Ordinary windows: the ends of the blocks before are folded once per block, as far back as a double goes."""
    # The first row of a key is its own seed.
    seed = F.first("__x").over(Window.partitionBy(*by).orderBy("__block", "__p").rowsBetween(Window.unboundedPreceding, 0))
    # The list at a block holds the end of the block before it too: one slot less to follow.
    ends = {f"__carry_{i}": (F.col(f"__local_{i}"), min(_depth(a, length), FARTHEST) - 1) for i, a in enumerate(alphas)}
    heads = _ends_before(local.withColumn("__seed", seed), by, F.col("__block"), ends)
    return _spread(heads, by, {f"__carry_{i}": _folded(F.col(f"__carry_{i}"), F.col("__seed"), a, length) for i, a in enumerate(alphas)}).drop("__seed")


def _carry_by_join(local: DataFrame, by: Sequence[str], alphas: Sequence[float], length: int) -> DataFrame:
    """Chunked series: fold the block ends, one row per block, and join the carries back."""
    ends = local.groupBy(*by, "__block").agg(
        F.min_by("__x", "__p").alias("__first"),
        *[F.max_by(f"__local_{i}", "__p").alias(f"__end_{i}") for i in range(len(alphas))],
    )
    by_block = Window.partitionBy(*by).orderBy("__block")
    carries = {}
    for i, a in enumerate(alphas):
        ends_before = F.collect_list(f"__end_{i}").over(by_block.rowsBetween(-_depth(a, length), -1))
        carries[f"__carry_{i}"] = _folded(ends_before, F.first("__first").over(by_block), a, length)
    folded = ends.withColumns(carries).select(*by, "__block", *carries)
    return join_groups(local, folded, [*by, "__block"])


def _folded(ends: Column, seed: Column, alpha: float, length: int) -> Column:
    """Carry into a block from the ends of the blocks before it, oldest first.

    The seed, the first value of the key, reaches a block only if the fold starts at the first one.
    """
    q = math.exp(math.log1p(-alpha) * length)
    depth = _depth(alpha, length)
    start = F.when(F.col("__block") <= depth, seed).otherwise(F.lit(0.0))
    return F.aggregate(ends, start, lambda carry, end: carry * F.lit(q) + end)


# -- over missing values ------------------------------------------------------


def _over_gaps(
    df: DataFrame, keys: list[str], ts: str, c: str, alphas: dict[str, float], tiebreak, chunk, width, block, hot_rows: int
) -> DataFrame:
    """Blocks of rows; ``__weight`` and ``__local`` turn the average at the block's first value into that of the row."""
    length = block or _block_length([a for a in alphas.values() if a < 1.0] or [0.5])
    size = use_chunks(df, keys, ts, chunk, hot_rows)
    numbered = positions(df, keys, ts, "__pos", None, tiebreak, width, hot_rows, size)
    x = nan_to_null(F.col(c).cast("double"))
    placed = numbered.withColumns({"__block": F.floor((F.col("__pos") - 1) / length), "__p": (F.col("__pos") - 1) % length, "__x": x})
    by = [KEY] if size else keys
    ordered = Window.partitionBy(*by, "__block").orderBy("__p")
    so_far, before = ordered.rowsBetween(Window.unboundedPreceding, 0), ordered.rowsBetween(Window.unboundedPreceding, -1)
    seen = F.when(F.col("__x").isNotNull(), F.col("__pos"))
    rows = (keyed(placed, keys) if size else placed).withColumns(
        {
            "__gap": F.col("__pos") - F.last(seen, ignorenulls=True).over(before),
            "__first": F.first("__x", ignorenulls=True).over(so_far),
            "__first_pos": F.first(seen, ignorenulls=True).over(so_far),
            "__last_pos": F.last(seen, ignorenulls=True).over(so_far),
        }
    )
    rates = list(alphas.values())
    inner = F.col("__x").isNotNull() & F.col("__gap").isNotNull()
    logs = {f"__log_{i}": F.sum(F.when(inner, _log_factor(a)).otherwise(F.lit(0.0))).over(so_far) for i, a in enumerate(rates) if a < 1.0}
    rows = rows.withColumns(logs)
    local = {}
    for i, a in enumerate(rates):
        if a < 1.0:
            log = F.col(f"__log_{i}")
            term = F.when(inner, _share(a) * F.col("__x") * F.exp(-log)).otherwise(F.lit(0.0))
            local |= {f"__weight_{i}": F.exp(log), f"__local_{i}": F.exp(log) * F.sum(term).over(so_far)}
        else:  # nothing of the older values is left
            local |= {f"__weight_{i}": F.lit(0.0), f"__local_{i}": F.last("__x", ignorenulls=True).over(so_far)}
    rows = rows.withColumns(local)
    carried = (_state_by_join if size else _state_by_window)(rows, by, rates, length)
    out = {}
    for i, (n, a) in enumerate(alphas.items()):
        state = F.col(f"__state_{i}")
        out[n] = F.when(F.col("__first").isNull(), state["value"]).otherwise(
            F.col(f"__weight_{i}") * _entered(state, F.col("__first"), F.col("__first_pos"), a) + F.col(f"__local_{i}")
        )
    helpers = [f"__{k}_{i}" for k in ("log", "weight", "local", "state") for i in range(len(rates))]
    return carried.withColumns(out).drop(KEY, "__pos", "__block", "__p", "__x", "__gap", "__first", "__first_pos", "__last_pos", *helpers)


def _kept(alpha: float, gap: Column) -> Column:
    """What a gap leaves of the older weights."""
    return F.exp(F.lit(math.log1p(-alpha)) * gap) if alpha < 1.0 else F.lit(0.0)


def _log_factor(alpha: float) -> Column:
    return F.lit(math.log1p(-alpha)) * F.col("__gap") - F.log(_kept(alpha, F.col("__gap")) + F.lit(alpha))


def _share(alpha: float) -> Column:
    return F.lit(alpha) / (_kept(alpha, F.col("__gap")) + F.lit(alpha))


def _entered(state: Column, first: Column, at: Column, alpha: float) -> Column:
    """The average at a block's first value, after the state (last average and where its value was)."""
    kept = _kept(alpha, at - state["at"])
    return F.when(state["value"].isNull(), first).otherwise((kept * state["value"] + F.lit(alpha) * first) / (kept + F.lit(alpha)))


def _end(i: int) -> Column:
    names = {"first": "__first", "first_pos": "__first_pos", "last_pos": "__last_pos", "weight": f"__weight_{i}", "local": f"__local_{i}"}
    return F.struct(*[F.col(c).alias(n) for n, c in names.items()])


def _state_after(ends: Column, alpha: float) -> Column:
    """(average, position of the last value) after blocks, oldest first; blocks without a value change nothing."""
    start = F.struct(F.lit(None).cast("double").alias("value"), F.lit(None).cast("bigint").alias("at"))

    def step(state: Column, end: Column) -> Column:
        value = end["weight"] * _entered(state, end["first"], end["first_pos"], alpha) + end["local"]
        return F.struct(value.alias("value"), end["last_pos"].cast("bigint").alias("at"))

    return F.aggregate(ends, start, step)


def _values_back(alpha: float) -> int:
    """Values after which nothing of what came before them is left in a double: each damps it by ``q`` at least."""
    return min(math.ceil(VANISHED / -math.log1p(-alpha)), FARTHEST) if alpha < 1.0 else 1


def _state_by_window(rows: DataFrame, by: Sequence[str], rates: Sequence[float], length: int) -> DataFrame:
    """Ordinary windows: the ends of the blocks before are folded once per block, as many as hold the values that still count."""
    before = Window.partitionBy(*by).orderBy("__block", "__p").rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumn("__values", F.count("__x").over(before))
    # A block without a value says nothing; of blocks with the same number of values before them, one has an end before it.
    ends = {f"__state_{i}": (F.when(F.col("__first").isNotNull(), _end(i)), _values_back(a)) for i, a in enumerate(rates)}
    heads = _ends_before(counted, by, F.col("__values"), ends)
    return _spread(heads, by, {f"__state_{i}": _state_after(F.col(f"__state_{i}"), a) for i, a in enumerate(rates)}).drop("__values")


def _state_by_join(rows: DataFrame, by: Sequence[str], rates: Sequence[float], length: int) -> DataFrame:
    """Chunked series: fold the block ends, one row per block, and join the states back.

    Every value damps what came before it by ``q`` at least, so ``VANISHED`` bounds how many blocks are folded.
    """
    blocks = rows.groupBy(*by, "__block").agg(F.count("__x").alias("__inside"), *[F.max_by(_end(i), "__p").alias(f"__end_{i}") for i in range(len(rates))])
    earlier = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__values", F.coalesce(F.sum("__inside").over(earlier), F.lit(0)))
    # The values before each block: blocks without one damp nothing, so they do not count. A block is followed to its first value.
    by_values = Window.partitionBy(*by).orderBy("__values")
    states = {}
    for i, a in enumerate(rates):
        known = F.when(F.col(f"__end_{i}")["first"].isNotNull(), F.col(f"__end_{i}"))
        states[f"__state_{i}"] = _state_after(F.collect_list(known).over(by_values.rangeBetween(-_values_back(a) - length, -1)), a)
    return join_groups(rows, blocks.withColumns(states).select(*by, "__block", *states), [*by, "__block"])
