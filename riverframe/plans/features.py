"""Daily feature tables.

Order of work in each: roll up (partial aggregation before the shuffle), join the target while
both sides are still partitioned by (location, date), then one shuffle on location for every
lag, rolling and average column. After the roll-up a key has one row a day, so a window over a
key is bounded by the calendar however many readings the key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.functions.columns import (
    HEAVY_RAIN_MM, any_flag, calendar_parts, composite, flag, interaction, safe_ratio, season_flag, spread,
)
from riverframe.operators.categories import INDEX, Categories, with_index
from riverframe.operators.ema import alpha_of, emas
from riverframe.operators.joins import join_with_suffix, union_all, with_row
from riverframe.operators.ordered import DAILY, add_rows
from riverframe.operators.quantiles import quantiles
from riverframe.operators.resample import resample
from riverframe.operators.scaling import one_hot, standardize
from riverframe.operators.select import require_columns
from riverframe.operators.settle import settle
from riverframe.operators.windows import anomaly_of, delta_of, fill_gaps, lag_of, pct_change_of, rolling_of, zscore

KEY, DAY, TARGET, KIND = "location", "date", "river_discharge_m3s", "data_type"
HISTORICAL, FORECAST = "historical", "forecast"

# Window lengths of the feature set.
LAGS = (1, 2, 3, 7)
ROLLS = (3, 7, 14)
SPANS = (3, 7)
API_ALPHA = 0.2


def daily_target(daily: DataFrame, value: str = TARGET) -> DataFrame:
    """One target per location and day; repeated readings of a day are averaged."""
    return daily.groupBy(KEY, DAY).agg(F.avg(value).alias(value))


def daily_rain(hourly: DataFrame, forecast: DataFrame | None, overlap: str = HISTORICAL) -> DataFrame:
    """Daily rain sum and hourly maximum of history and forecast.

    On a day both cover, ``overlap="historical"`` keeps the measured row and ``"both"`` keeps two
    rows. Both forms are a single aggregation.
    """
    readings = hourly.select(KEY, "datetime", "rain").withColumn(KIND, F.lit(HISTORICAL))
    if forecast is not None:
        ahead = forecast.select(KEY, "datetime", "rain").withColumn(KIND, F.lit(FORECAST))
        readings = union_all(readings, ahead)
    if overlap == "both":
        aggs = {"rain_sum_mm": ("sum", "rain"), "rain_max_1h": ("max", "rain")}
        return resample(readings, [KEY, KIND], "datetime", aggs, n_obs=None)
    if overlap != HISTORICAL:
        raise ValueError(f"overlap must be historical or both, not {overlap!r}")
    measured = F.col(KIND) == HISTORICAL
    past, ahead = F.when(measured, F.col("rain")), F.when(~measured, F.col("rain"))
    days = readings.groupBy(KEY, F.to_date("datetime").alias(DAY)).agg(
        F.max(measured).alias("__measured"),
        F.sum(past).alias("__past_sum"), F.max(past).alias("__past_max"),
        F.sum(ahead).alias("__ahead_sum"), F.max(ahead).alias("__ahead_max"),
    )

    def chosen(name: str):
        return F.when(F.col("__measured"), F.col(f"__past_{name}")).otherwise(F.col(f"__ahead_{name}"))

    return days.select(
        KEY, DAY,
        F.when(F.col("__measured"), HISTORICAL).otherwise(FORECAST).alias(KIND),
        F.coalesce(chosen("sum"), F.lit(0.0)).alias("rain_sum_mm"),
        chosen("max").alias("rain_max_1h"),
    )


def rain_memory(days: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Lags, rolling sums, averages and change of daily rain: what the ground still remembers."""
    rows = {f"rain_sum_lag_{k}": lag_of("rain_sum_mm", k) for k in LAGS}
    rows |= {f"rain_sum_roll{n}": rolling_of("rain_sum_mm", n, "sum", min_periods=1) for n in ROLLS}
    rows["rain_delta_1d"] = delta_of("rain_sum_mm", fill=0.0)
    averages = {f"rain_ema_{s}": alpha_of(span=s) for s in SPANS} | {"rain_api_7d": API_ALPHA}
    lagged = add_rows(days, [KEY], DAY, rows, tiebreak=tiebreak, chunk=DAILY)
    # The roll-up has a sum for every row.
    return emas(lagged, [KEY], DAY, "rain_sum_mm", averages, tiebreak=tiebreak, chunk=DAILY, missing="error")


def feature_names(categories: Sequence[str] | Categories, leaky: bool = False) -> list[str]:
    """Feature order of the table. ``runoff_ratio_7d`` divides the target by rain, so it tells the
    answer; it is listed only on request. A sparse block of locations has no columns of its own."""
    categories = [] if isinstance(categories, Categories) else categories
    rain = ["rain_sum_mm", "rain_max_1h"]
    rain += [f"rain_sum_lag_{k}" for k in LAGS] + [f"rain_sum_roll{n}" for n in ROLLS]
    rain += [f"rain_ema_{s}" for s in SPANS] + ["rain_delta_1d", "rain_api_7d"]
    names = rain + [f"loc_{v}" for v in categories] + ["month", "is_monsoon", "heavy_rain"]
    return names + ["runoff_ratio_7d"] if leaky else names


def build_features(
    hourly: DataFrame,
    forecast: DataFrame | None,
    daily: DataFrame,
    categories: Sequence[str] | Categories,
    overlap: str = HISTORICAL,
    scale: str | None = "all",
) -> DataFrame:
    """Feature table of history and forecast, one row per location and day.

    ``categories`` are the locations to one-hot encode: their names, for a column each, or fitted :class:`Categories` for one
    column ``loc_index``, however many there are. ``scale`` is ``"all"`` (statistics over
    all rows), ``"historical"`` (measured rows only) or None.
    """
    require_columns(hourly, [KEY, "datetime", "rain"])
    require_columns(daily, [KEY, DAY, TARGET])
    days = daily_rain(hourly, forecast, overlap).join(daily_target(daily), [KEY, DAY], "left")
    # With two rows on a day the forecast one sorts first.
    table = rain_memory(days, tiebreak=[KIND] if overlap == "both" else [])
    sparse = isinstance(categories, Categories)
    table = (with_index(table, KEY, categories) if sparse else one_hot(table, KEY, categories)).withColumns(
        {
            "month": F.month(DAY),
            "is_monsoon": season_flag(DAY),
            "heavy_rain": flag("rain_sum_mm", ">", HEAVY_RAIN_MM),
            "runoff_ratio_7d": safe_ratio(TARGET, "rain_sum_roll7"),
        }
    )
    features = feature_names(categories, leaky=True)
    table = table.select(KEY, DAY, KIND, *features, *([INDEX] if sparse else []), TARGET)
    if scale is None:
        return table
    # The statistics and the rows read one stored table, so that its windows run once.
    table = settle(table, "features")
    fit_on = table.filter(F.col(KIND) == HISTORICAL) if scale == HISTORICAL else None
    return standardize(table, features, fit_on)


def build_features_wide(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """The eight-aggregate variant: complete days with a target only, no scaling."""
    aggs = {
        "rain_sum_mm": ("sum", "rain"), "precip_sum_mm": ("sum", "precipitation"),
        "temp_mean": ("mean", "temperature_2m"), "temp_max": ("max", "temperature_2m"),
        "temp_min": ("min", "temperature_2m"), "wind_max": ("max", "wind_speed_10m"),
        "gust_max": ("max", "wind_gusts_10m"), "rain_max_1h": ("max", "rain"),
    }
    days = resample(hourly, [KEY], "datetime", aggs, n_obs=None)
    days = days.withColumn("temp_diurnal_range", spread("temp_max", "temp_min"))
    rows = {}
    for k in LAGS:
        rows[f"rain_sum_lag_{k}"] = lag_of("rain_sum_mm", k)
        rows[f"rain_max1h_lag_{k}"] = lag_of("rain_max_1h", k)
    rows |= {f"rain_sum_roll{n}": rolling_of("rain_sum_mm", n, "sum", min_periods=1) for n in ROLLS}
    rows["rain_change_1d"] = delta_of("rain_sum_mm", fill=0.0)
    # The windows must see days without a target, so the join keeps them until afterwards.
    days = days.join(daily_target(daily), [KEY, DAY], "left")
    table = emas(
        add_rows(days, [KEY], DAY, rows, chunk=DAILY), [KEY], DAY, "rain_sum_mm", {f"rain_ema_{s}": alpha_of(span=s) for s in SPANS}, chunk=DAILY, missing="error"
    )
    return table.dropna()


def discharge_features(
    discharge: DataFrame, p: float = 0.95, method: str = "exact", fill: bool = True, settled: bool = False
) -> DataFrame:
    """Lag, rolling, change, anomaly, extreme, z-score and calendar features of daily discharge.

    ``fill`` closes gaps forward and then backward. That also fills the first lags of a key from
    later days, which a strictly causal model must not see; turn it off for one. ``settled`` says
    that ``discharge`` is a stored table already; otherwise it is written once, as it is read by
    the threshold, the z-score and the windows.
    """
    c = TARGET
    discharge = discharge.select(KEY, DAY, c)
    discharge = discharge if settled else settle(discharge, "discharge")
    rows = {f"discharge_lag_{k}d": lag_of(c, k) for k in (1, 3, 7)}
    rows |= {
        "discharge_rolling_3d": rolling_of(c, 3, "mean"),
        "discharge_cum_7d": rolling_of(c, 7, "sum"),
        "discharge_delta_1d": delta_of(c),
        "discharge_change_pct": pct_change_of(c),
        "discharge_anomaly": anomaly_of(c, 3),
    }
    table = add_rows(discharge, [KEY], DAY, rows, chunk=DAILY)
    threshold = quantiles(discharge, {c: p}, method=method).scalar()
    table = zscore(table.withColumn("is_extreme_river_discharge", flag(c, ">=", threshold)), [c], names={c: "discharge_zscore"})
    table = _with_calendar(table)
    if fill:
        table = fill_gaps(table, [KEY], DAY, [c, *rows, "discharge_zscore"], chunk=DAILY)
    return table.dropna(subset=[c])


def weather_features(
    weather: DataFrame, p: float = 0.95, method: str = "exact", fill: bool = True, settled: bool = False
) -> DataFrame:
    """Lag, rolling, composite, extreme, z-score and calendar features of daily weather.

    ``fill`` and ``settled`` as in :func:`discharge_features`.
    """
    rain, temp, wind = "rain_sum_mm", "temperature_mean_c", "wind_speed_max_mps"
    measured = [rain, "precipitation_sum_mm", temp, wind, "wind_gust_max_mps"]
    rows = {}
    for k in (1, 3, 7):
        rows[f"rain_lag_{k}d"] = lag_of(rain, k)
        rows[f"temp_lag_{k}d"] = lag_of(temp, k)
    rows["rain_rolling_3d"] = rolling_of(rain, 3, "mean")
    rows["rain_cum_7d"] = rolling_of(rain, 7, "sum")
    weather = weather.select(KEY, DAY, *measured)
    weather = weather if settled else settle(weather, "weather")
    table = _with_calendar(add_rows(weather, [KEY], DAY, rows, chunk=DAILY))
    table = with_row(table, quantiles(weather, {rain: p, temp: p, wind: p}, method=method), "__limits")
    table = table.withColumns(
        {
            "atmo_index": composite({rain: 1.0, "precipitation_sum_mm": 1.0, wind: 0.5}),
            "temp_wind_interaction": interaction(temp, wind),
            "extreme_rain": flag(rain, ">=", F.col(f"__limits.{rain}")),
            "extreme_temp": flag(temp, ">=", F.col(f"__limits.{temp}")),
            "extreme_wind": flag(wind, ">=", F.col(f"__limits.{wind}")),
        }
    ).drop("__limits")
    table = table.withColumn("is_extreme_weather", any_flag("extreme_rain", "extreme_temp", "extreme_wind"))
    scores = {rain: "rain_sum_zscore", temp: "temperature_mean_zscore", wind: "wind_speed_max_zscore"}
    table = zscore(table, list(scores), names=scores)
    if fill:
        table = fill_gaps(table, [KEY], DAY, [*measured, *rows, *scores.values()], chunk=DAILY)
    return table.dropna(subset=[rain, temp])


def _with_calendar(df: DataFrame) -> DataFrame:
    parts = calendar_parts(DAY)
    return df.withColumns({n: parts[n] for n in ("dayofyear", "month", "weekday", "is_weekend")})


def joined_features(weather: DataFrame, discharge: DataFrame) -> DataFrame:
    """Weather and discharge features of the same day, clashing names suffixed."""
    return join_with_suffix(weather, discharge, [DAY, KEY], ("_weather", "_flood")).dropna(subset=[TARGET])
