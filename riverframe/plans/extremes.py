"""Days on which rain and discharge are both extreme."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.functions.columns import all_flags, flag, relabel
from riverframe.operators.joins import with_row
from riverframe.operators.quantiles import quantiles
from riverframe.operators.resample import to_long
from riverframe.operators.settle import settle
from riverframe.operators.stats import corr_of, flag_sums, summary_long

FLAGS = ("extreme_rain", "extreme_discharge", "extreme_both")
# Display names of the flags.
FLAG_NAMES = {
    "extreme_rain": "Extreme Rain",
    "extreme_discharge": "Extreme Discharge",
    "extreme_both": "Concurrent Both",
}


def concurrent_extremes(
    rain: DataFrame,
    discharge: DataFrame,
    p: float = 0.95,
    on: Sequence[str] = ("date", "location"),
    rain_col: str = "rain_sum_mm",
    discharge_col: str = "river_discharge_m3s",
    thresholds: str = "separate",
    method: str = "exact",
    settled: bool = False,
) -> DataFrame:
    """Joined days with three flags.

    ``separate`` takes each threshold from its own table before the join; ``joined`` takes both
    from the days the tables share. ``settled`` says that both tables are stored already;
    otherwise they are written once, as thresholds and join both read them.
    """
    rain, discharge = rain.select(*on, rain_col), discharge.select(*on, discharge_col)
    if not settled and thresholds == "separate":
        rain, discharge = settle(rain, "rain"), settle(discharge, "discharge")
    both = rain.join(discharge, list(on), "inner")
    if thresholds == "separate":
        rain_limit = quantiles(rain, {rain_col: p}, method=method).scalar()
        discharge_limit = quantiles(discharge, {discharge_col: p}, method=method).scalar()
    elif thresholds == "joined":
        both = both.dropna(subset=[rain_col, discharge_col])
        both = both if settled else settle(both, "days")
        both = with_row(both, quantiles(both, {rain_col: p, discharge_col: p}, method=method), "__limits")
        rain_limit, discharge_limit = F.col(f"__limits.{rain_col}"), F.col(f"__limits.{discharge_col}")
    else:
        raise ValueError(f"thresholds must be separate or joined, not {thresholds!r}")
    flagged = both.withColumns(
        {
            "extreme_rain": flag(rain_col, ">=", rain_limit),
            "extreme_discharge": flag(discharge_col, ">=", discharge_limit),
        }
    ).drop("__limits")
    return flagged.withColumn("extreme_both", all_flags("extreme_rain", "extreme_discharge"))


def concurrent_events(extremes: DataFrame) -> DataFrame:
    """The days extreme on both counts. Sort by date at the sink."""
    return extremes.filter(F.col("extreme_both") == 1)


def extreme_summary(
    extremes: DataFrame, rain_col: str = "rain_sum_mm", discharge_col: str = "river_discharge_m3s", digits: int = 3
) -> DataFrame:
    """``(metric, value)``: record and event counts and the rain-discharge correlation."""
    return summary_long(
        extremes,
        {
            "Total Records": F.count("*"),
            "Extreme Rainfall Days": F.sum("extreme_rain"),
            "Extreme Discharge Days": F.sum("extreme_discharge"),
            "Concurrent Extreme Days": F.sum("extreme_both"),
            "Rain-Discharge Correlation": corr_of(rain_col, discharge_col),
        },
        digits,
    )


def extremes_by_key(extremes: DataFrame, by: Sequence[str] = ("location",), named: bool = False) -> DataFrame:
    """Event counts per key in long form."""
    long = to_long(flag_sums(extremes, FLAGS, by), by, FLAGS)
    return long.withColumn("variable", relabel("variable", FLAG_NAMES)) if named else long
