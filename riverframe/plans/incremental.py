"""Late pulls: what a new landing changes is recomputed, and nothing else.

Three tables live under one folder, each with a directory per month: ``readings`` (the newest pull of every reading), ``days``
(roll-up) and ``features`` (lags, rolling sums, averages and change of daily rain). A landing is merged into the months it reaches; the
readings that really changed give the touched days, and these give

* the days to roll up again, from the readings of their months;
* per location the first touched day. Every window looks back at most ``REACH`` rows, which are read from the months before it. An
  average remembers all that was, but the last stored average says it in one number: it enters the recurrence as the value of the row
  before the first touched day. From that day on the location's rows are computed anew, as every later average changes.

Rows of other locations, and earlier rows, are kept as they are; months before the first touched one are neither written nor,
beyond the reach, read. The result equals a rebuild from all readings. Months are replaced as whole directories (dynamic
overwrite), each from a table written first, so a lost executor or a failed write leaves the last state.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverframe.operators.ema import alpha_of, emas
from riverframe.operators.joins import join_groups
from riverframe.operators.ordered import DAILY, add_rows
from riverframe.operators.resample import resample
from riverframe.operators.settle import settle
from riverframe.operators.windows import delta_of, lag_of, rolling_of
from riverframe.plans.features import API_ALPHA, DAY, KEY, LAGS, ROLLS, SPANS
from riverframe.sources.tables import write_table

AVERAGES = {f"rain_ema_{s}": alpha_of(span=s) for s in SPANS} | {"rain_api_7d": API_ALPHA}
#: Rows that any window looks back.
REACH = max(*LAGS, *ROLLS)
MONTH = "month"


@dataclass(frozen=True)
class Store:
    """``identity`` are the columns that make a reading the same one in a later pull; ``digits`` rounds daily sums."""

    spark: SparkSession
    base: str
    identity: Sequence[str] = (KEY, "datetime")
    pulled_at: str = "pulled_at"
    digits: int | None = None

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def has(self, table: str) -> bool:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(conf).exists(path)

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def months(self, table: str) -> list[int]:
        return sorted(r[0] for r in self.read(table).select(MONTH).distinct().collect()) if self.has(table) else []

    def replace(self, table: str, rows: DataFrame, sort_by: Sequence[str]) -> None:
        """The months of ``rows`` are replaced by them. They are written elsewhere first, as they were made from the old ones."""
        write_table(settle(rows, table), self.path(table), partition_by=[MONTH], sort_by=sort_by, dynamic=True)


@dataclass(frozen=True)
class Changes:
    """What a landing changed: touched (location, date), and the months written per table."""

    days: DataFrame
    months: dict[str, list[int]] = field(default_factory=dict)


def month_of(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def _in(months: Sequence[int]) -> Column:
    """A filter on the directories themselves."""
    return F.col(MONTH).isin([int(m) for m in months])


def _distinct_months(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select(MONTH).distinct().collect())


def land(store: Store, new: DataFrame) -> Changes:
    """Merge a landing (identity columns, rain, pulled_at) into the readings; a later pull of a reading supersedes an earlier one.

    A reading without a location or stamp belongs to no day and is left out.
    """
    keys = list(store.identity)
    columns = [*keys, "rain", store.pulled_at]
    landed = new.select(*columns).dropna(subset=[KEY, "datetime"]).withColumn(MONTH, month_of(F.to_date("datetime")))
    landed = settle(landed.withColumn("__new", F.lit(True)), "landing")
    months = _distinct_months(landed)
    both = landed
    if store.has("readings"):
        both = landed.unionByName(store.read("readings").where(_in(months)).withColumn("__new", F.lit(False)))
    # On a tie in time the landing wins, then the larger value. Aggregated before the shuffle: no key is sorted.
    newest = F.struct(store.pulled_at, "__new", "rain")
    merged = both.groupBy(*keys, MONTH).agg(
        F.max_by("rain", newest).alias("rain"), F.max(store.pulled_at).alias(store.pulled_at),
        F.max_by("rain", F.when(~F.col("__new"), newest)).alias("__old"), F.bool_or(~F.col("__new")).alias("__had"),
    )
    merged = settle(merged, "merged")
    same = F.col("__had") & F.col("__old").eqNullSafe(F.col("rain"))
    touched = settle(merged.where(~same).select(KEY, F.to_date("datetime").alias(DAY), MONTH).distinct(), "touched")
    store.replace("readings", merged.select(*columns, MONTH), [KEY, "datetime"])
    return Changes(touched, {"readings": months})


def refresh_days(store: Store, changes: Changes) -> Changes:
    """Roll the touched days up again, from the readings of their months."""
    months = _distinct_months(changes.days)
    if not months:
        return Changes(changes.days, changes.months | {"days": []})
    readings = store.read("readings").where(_in(months)).withColumn(DAY, F.to_date("datetime"))
    again = readings.join(changes.days, [KEY, DAY, MONTH], "left_semi")
    aggs = {"rain_sum_mm": ("sum", "rain"), "rain_max_1h": ("max", "rain")}
    days = resample(again, [KEY], "datetime", aggs, n_obs=None, digits=store.digits).withColumn(MONTH, month_of(F.col(DAY)))
    if store.has("days"):
        days = days.unionByName(store.read("days").where(_in(months)).join(changes.days, [KEY, DAY, MONTH], "left_anti"))
    store.replace("days", days, [KEY, DAY])
    return Changes(changes.days, changes.months | {"days": months})


def refresh_features(store: Store, changes: Changes) -> Changes:
    """Compute the features of every touched location from its first touched day on."""
    if changes.days.isEmpty():
        return Changes(changes.days, changes.months | {"features": []})
    first = settle(changes.days.groupBy(KEY).agg(F.min(DAY).alias("__since")), "first-touched")
    start = first.agg(F.min(month_of(F.col("__since")))).first()[0]
    stored = store.months("features")
    back = _reach_back(store, first, start, stored)
    days = store.read("days").where(F.col(MONTH) >= (back[0] if back else start))
    rows = join_groups(days.select(KEY, DAY, MONTH, "rain_sum_mm", "rain_max_1h"), first, [KEY]).where(F.col("__since").isNotNull())
    after = rows.where(F.col(DAY) >= F.col("__since"))
    frame = after.withColumns({"__place": F.lit(None).cast("bigint")} | {f"__x_{n}": F.col("rain_sum_mm") for n in AVERAGES})
    if back:
        known = store.read("features").where(_in(back)).select(KEY, DAY, F.col("position").alias("__place"), *[F.col(n).alias(f"__x_{n}") for n in AVERAGES])
        newest = Window.partitionBy(KEY).orderBy(F.desc(DAY))
        earlier = rows.where(F.col(DAY) < F.col("__since")).withColumn("__back", F.row_number().over(newest)).where(F.col("__back") <= REACH)
        earlier = earlier.join(known, [KEY, DAY])
        # The last stored average stands for all that was; older rows are there for the windows alone.
        earlier = earlier.withColumns({f"__x_{n}": F.when(F.col("__back") == 1, F.col(f"__x_{n}")) for n in AVERAGES}).drop("__back")
        frame = frame.unionByName(earlier)
    new = _windows(settle(frame, "to-compute")).where(F.col(DAY) >= F.col("__since")).drop("__since")
    later = [m for m in stored if m >= start]
    if later:
        held = join_groups(store.read("features").where(_in(later)), first, [KEY])
        kept = held.where(F.col("__since").isNull() | (F.col(DAY) < F.col("__since"))).drop("__since")
        new = new.unionByName(kept.select(*new.columns))
    new = settle(new, "features")
    written = _distinct_months(new)
    write_table(new, store.path("features"), partition_by=[MONTH], sort_by=[KEY, DAY], dynamic=True)
    return Changes(changes.days, changes.months | {"features": written})


def _reach_back(store: Store, first: DataFrame, start: int, stored: Sequence[int]) -> list[int]:
    """The stored months that hold the ``REACH`` rows before every first touched day, or all there are of a shorter series.

    Looked for in one month before the first touched one, then in twice as many; a row that is the first of its series ends the
    search for its location. Usually the first look is enough.
    """
    before, span = [m for m in stored if m < start], 1
    while True:
        months = before[-span:] + [m for m in stored if m >= start]
        if not months or span >= len(before):
            return months
        found = join_groups(store.read("features").where(_in(months)).select(KEY, DAY, "position"), first, [KEY])
        held = found.where(F.col(DAY) < F.col("__since")).groupBy(KEY).agg(F.count("*").alias("__n"), F.min("position").alias("__lowest"))
        enough = first.join(held, KEY, "left").where((F.coalesce("__n", F.lit(0)) < REACH) & (F.coalesce("__lowest", F.lit(0)) != 1))
        if enough.isEmpty():
            return months
        span *= 2


def _windows(frame: DataFrame) -> DataFrame:
    rows = {f"rain_sum_lag_{k}": lag_of("rain_sum_mm", k) for k in LAGS}
    rows |= {f"rain_sum_roll{n}": rolling_of("rain_sum_mm", n, "sum", min_periods=1) for n in ROLLS}
    rows["rain_delta_1d"] = delta_of("rain_sum_mm", fill=0.0)
    table = add_rows(frame, [KEY], DAY, rows, chunk=DAILY)
    for name, alpha in AVERAGES.items():
        table = emas(table, [KEY], DAY, f"__x_{name}", {name: alpha}, chunk=DAILY)
    # Places go on from the last stored one.
    by_key = Window.partitionBy(KEY)
    base = F.coalesce(F.max("__place").over(by_key), F.lit(0))
    fresh = F.sum(F.when(F.col("__place").isNull(), 1).otherwise(0)).over(by_key.orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0))
    placed = table.withColumn("position", base + fresh)
    return placed.drop("__place", *[f"__x_{n}" for n in AVERAGES])


def late_pull(store: Store, new: DataFrame) -> Changes:
    """Everything a landing changes, from readings to features."""
    return refresh_features(store, refresh_days(store, land(store, new)))
