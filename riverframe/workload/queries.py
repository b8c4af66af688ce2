"""One query per operator of the inventory, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverframe.functions import columns as C
from riverframe.operators import metrics, scaling, select, sequences as S, stats, windows as W
from riverframe.operators.ema import emas
from riverframe.operators.joins import (
    attach_forecast_driver, attach_target, join_with_suffix, spread_daily, union_all, with_global_stats,
)
from riverframe.operators.ordered import DAILY, add_rows, positions
from riverframe.operators.quantiles import quantiles, quantiles_long
from riverframe.operators.resample import mean_by, month_means, pivot_first, resample, to_long
from riverframe.operators.settle import settle
from riverframe.plans import dashboard, evaluate, extremes, features, profile, scoring, training
from riverframe.plans.combine import combine_hourly_daily
from riverframe.sources import payloads as P
from riverframe.workload import tables as T

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
KEYS = ["location"]
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
HORIZON_END = "2001-12-31"


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, cols=None) -> DataFrame:
    """Doubles rounded, because the last digits depend on the order of addition."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in cols})


# -- roll-ups ---------------------------------------------------------------


@query
def daily_rollup(spark, sf):
    aggs = {"rain_sum_mm": ("sum", "rain"), "rain_max_1h": ("max", "rain")}
    return rounded(resample(T.readings(spark, sf), KEYS, "datetime", aggs))


@query
def daily_rollup_wide(spark, sf):
    aggs = {
        "rain_sum_mm": ("sum", "rain"), "precip_sum_mm": ("sum", "precipitation"),
        "temp_mean": ("mean", "temperature_2m"), "temp_max": ("max", "temperature_2m"),
        "temp_min": ("min", "temperature_2m"), "wind_max": ("max", "wind_speed_10m"),
        "gust_max": ("max", "wind_gusts_10m"), "rain_max_1h": ("max", "rain"),
    }
    return rounded(resample(T.readings_wide(spark, sf), KEYS, "datetime", aggs))


@query
def forecast_rollup(spark, sf):
    return rounded(scoring.forecast_days(T.rain_forecast(spark, sf), "rain"))


@query
def month_mean(spark, sf):
    return rounded(month_means(T.rain_daily(spark, sf), "date", ["rain_sum_mm", "rain_max_1h"]))


@query
def mean_by_key(spark, sf):
    return rounded(mean_by(T.weather_daily(spark, sf), KEYS, ["rain_sum_mm", "temperature_mean_c", "wind_speed_max_mps"]))


# -- joins and unions -------------------------------------------------------


@query
def hourly_daily_combine(spark, sf):
    return rounded(combine_hourly_daily(T.order_readings(spark, sf), T.flow_daily(spark, sf)))


@query
def hourly_daily_fill0(spark, sf):
    return rounded(combine_hourly_daily(T.order_readings(spark, sf), T.flow_daily(spark, sf), how="left", fill=0.0))


@query
def target_left(spark, sf):
    return rounded(attach_target(T.rain_daily(spark, sf), T.flow_daily(spark, sf), ["location", "date"]))


@query
def target_inner(spark, sf):
    return rounded(attach_target(T.rain_daily(spark, sf), T.flow_daily(spark, sf), ["location", "date"], "inner"))


@query
def join_suffix(spark, sf):
    rain = T.rain_daily(spark, sf).withColumn("month", F.month("date"))
    flow = T.flow_daily(spark, sf).withColumn("month", F.month("date"))
    return rounded(join_with_suffix(rain, flow, ["location", "date"], ("_weather", "_flood")))


@query
def union_tagged(spark, sf):
    rain = select.tag(T.rain_daily(spark, sf), "data_type", "historical")
    flow = select.tag(T.flow_daily(spark, sf), "data_type", "forecast")
    return rounded(select.reorder(union_all(rain, flow), ["location", "date", "data_type"]))


# -- windows ----------------------------------------------------------------


@query
def lag_features(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm")
    return rounded(W.lags(days, KEYS, "date", "rain_sum_mm", (1, 2, 3, 7), chunk=DAILY))


@query
def rolling_min1(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm")
    return rounded(add_rows(days, KEYS, "date", {f"roll{n}": W.rolling_of("rain_sum_mm", n, "sum", 1) for n in (3, 7, 14)}, chunk=DAILY))


@query
def rolling_strict(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm")
    rows = {"mean3": W.rolling_of("rain_sum_mm", 3, "mean"), "mean30": W.rolling_of("rain_sum_mm", 30, "mean"),
            "sum7": W.rolling_of("rain_sum_mm", 7, "sum")}
    return rounded(add_rows(days, KEYS, "date", rows, chunk=DAILY))


@query
def rolling_calendar(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm")
    return rounded(W.rolling(days, KEYS, "date", "rain_sum_mm", 7, "sum", 1, calendar=True, out="sum7d"))


@query
def delta(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm")
    return rounded(add_rows(days, KEYS, "date", {"change": W.delta_of("rain_sum_mm"), "change0": W.delta_of("rain_sum_mm", 0.0)}, chunk=DAILY))


@query
def pct_change(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm")
    return rounded(W.pct_change(days, KEYS, "date", "rain_sum_mm", out="pct", chunk=DAILY))


@query
def pct_change_padded(spark, sf):
    days = T.rain_and_flow(spark, sf).select("location", "date", "river_discharge_m3s")
    return rounded(W.pct_change(days, KEYS, "date", "river_discharge_m3s", pad=True, out="pct", chunk=DAILY))


@query
def anomaly(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm")
    return rounded(W.anomaly(days, KEYS, "date", "rain_sum_mm", 3, out="anomaly", chunk=DAILY))


@query
def reading_windows(spark, sf):
    """Row windows over raw stamps, where a key may hold any share of the data."""
    rows = {"lag2": W.lag_of("rain", 2), "mean7": W.rolling_of("rain", 7, "mean"), "sum3": W.rolling_of("rain", 3, "sum", 1),
            "change": W.delta_of("rain")}
    return rounded(add_rows(T.readings(spark, sf), KEYS, "datetime", rows, tiebreak=["event_id"]))


@query
def reading_windows_chunked(spark, sf):
    """The same in chunks of 512 rows, the way a key too large for one task is worked on."""
    rows = {"lag2": W.lag_of("rain", 2), "mean7": W.rolling_of("rain", 7, "mean"), "sum3": W.rolling_of("rain", 3, "sum", 1),
            "change": W.delta_of("rain")}
    return rounded(add_rows(T.readings(spark, sf), KEYS, "datetime", rows, ["event_id"], chunk=512))


@query
def reading_positions(spark, sf):
    return positions(T.readings(spark, sf), KEYS, "datetime", "position", total="n_key", tiebreak=["event_id"], chunk=512)


@query
def ema_span(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm")
    return rounded(emas(days, KEYS, "date", "rain_sum_mm", {"ema3": 0.5, "ema7": 0.25}, chunk=DAILY, missing="error"))


@query
def api_index(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm")
    return rounded(emas(days, KEYS, "date", "rain_sum_mm", {"rain_api_7d": 0.2}, chunk=DAILY, missing="error"))


@query
def ema_readings(spark, sf):
    return rounded(emas(T.readings(spark, sf), KEYS, "datetime", "rain", {"ema4": 0.4, "api": 0.2}, tiebreak=["event_id"], missing="error"))


def hourly_grid(spark, sf):
    """Hourly rain of each location on a gapless grid of hours; hours without a reading are NULL."""
    hours = resample(T.readings(spark, sf), KEYS, "datetime", {"rain": ("sum", "rain")}, unit="hour", out_ts="hour", n_obs=None)
    span = hours.groupBy("location").agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    hour = F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour")))
    return span.select("location", hour.alias("hour")).join(hours, ["location", "hour"], "left")


@query
def ema_readings_chunked(spark, sf):
    averages = {"ema4": 0.4, "api": 0.2}
    return rounded(emas(T.readings(spark, sf), KEYS, "datetime", "rain", averages, ["event_id"], chunk=512, missing="error"))


@query
def fill_both_by_cells(spark, sf):
    grid = hourly_grid(spark, sf).withColumn("filled", F.col("rain"))
    return rounded(W.fill_gaps(grid, KEYS, "hour", ["filled"], "both", chunk=512, width=86_400))


@query
def fill_both(spark, sf):
    grid = hourly_grid(spark, sf).withColumn("filled", F.col("rain"))
    return rounded(W.fill_gaps(grid, KEYS, "hour", ["filled"], "both"))


@query
def fill_forward_daily(spark, sf):
    days = T.rain_and_flow(spark, sf).select("location", "date", "river_discharge_m3s")
    return rounded(W.fill_gaps(days, KEYS, "date", ["river_discharge_m3s"], "ffill", chunk=DAILY))


@query
def last_n_per_key(spark, sf):
    return W.last_n(T.readings(spark, sf), KEYS, "datetime", 14, tiebreak=["event_id"])


@query
def skip_n_per_key(spark, sf):
    return W.skip_n(T.readings(spark, sf), KEYS, "datetime", 14, tiebreak=["event_id"])


@query
def zscore_global(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm", "rain_max_1h")
    return rounded(W.zscore(days, ["rain_sum_mm", "rain_max_1h"]))


@query
def zscore_by_key(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date", "rain_sum_mm")
    return rounded(W.zscore(days, ["rain_sum_mm"], by=KEYS))


@query
def global_stats(spark, sf):
    days = T.flow_daily(spark, sf)
    c = "river_discharge_m3s"
    return rounded(with_global_stats(days, {"mean_flow": F.avg(c), "max_flow": F.max(c), "n_flow": F.count(c)}))


# -- scaling ----------------------------------------------------------------


@query
def scaler_fit(spark, sf):
    return rounded(scaling.fit_scaler(T.rain_and_flow(spark, sf), ["rain_sum_mm", "rain_max_1h", "river_discharge_m3s"]), 5)


@query
def scaler_apply(spark, sf):
    days = settle(T.rain_and_flow(spark, sf))
    cols = ["rain_sum_mm", "rain_max_1h", "river_discharge_m3s"]
    return rounded(scaling.apply_scaler(days, scaling.fit_scaler(days, cols), cols))


@query
def one_hot(spark, sf):
    return scaling.one_hot(T.rain_daily(spark, sf).select("location", "date"), "location")


# -- quantiles and extremes -------------------------------------------------


@query
def quantile_thresholds(spark, sf):
    q = quantiles_long(T.load(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], [0.05, 0.5, 0.8, 0.95, 0.99])
    ps = F.array(*[F.lit(p) for p in (0.05, 0.5, 0.8, 0.95, 0.99)])
    flat = q.select("metric", F.explode(F.arrays_zip(ps.alias("p"), F.col("q"))).alias("z"))
    return rounded(flat.select("metric", F.col("z.p").alias("p"), F.col("z.q").alias("q")))


@query
def quantile_by_key(spark, sf):
    return rounded(quantiles(T.readings(spark, sf), {"rain": 0.95}, by=KEYS))


def _extremes(spark, sf, thresholds="separate"):
    return extremes.concurrent_extremes(T.rain_daily(spark, sf), T.flow_daily(spark, sf), 0.8, thresholds=thresholds)


@query
def extreme_days(spark, sf):
    return rounded(_extremes(spark, sf))


@query
def extreme_days_joined(spark, sf):
    return rounded(_extremes(spark, sf, "joined"))


@query
def concurrent_events(spark, sf):
    return rounded(extremes.concurrent_events(_extremes(spark, sf)))


@query
def extreme_summary(spark, sf):
    return extremes.extreme_summary(_extremes(spark, sf))


@query
def extreme_by_key_long(spark, sf):
    return extremes.extremes_by_key(_extremes(spark, sf), named=True)


# -- profile ----------------------------------------------------------------


@query
def overview(spark, sf):
    return rounded(stats.overview(T.rain_and_flow(spark, sf), "date", ["rain_sum_mm", "river_discharge_m3s"]))


@query
def distinct_keys(spark, sf):
    return stats.distinct_values(T.rain_daily(spark, sf), "location")


@query
def distinct_count(spark, sf):
    return stats.n_distinct(T.load(spark, sf, "lineitem"), "l_orderkey")


@query
def profile_nulls(spark, sf):
    return stats.null_report(T.rain_and_flow(spark, sf))


@query
def describe_global(spark, sf):
    return rounded(stats.describe(T.load(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity", "l_discount"]), 4)


@query
def describe_by_key(spark, sf):
    return rounded(stats.describe(settle(T.rain_and_flow(spark, sf)), ["rain_sum_mm", "river_discharge_m3s"], KEYS), 5)


@query
def value_share(spark, sf):
    labelled = profile.with_rain_label(T.load(spark, sf, "lineitem").withColumn("dry", F.col("l_discount")), "dry")
    return stats.value_share(labelled, "rain_label")


@query
def rain_days_by_key(spark, sf):
    labelled = profile.with_rain_label(T.weather_daily(spark, sf), "wind_gust_max_mps")
    return stats.cross_count(labelled, "rain_label", "location")


@query
def corr_pair(spark, sf):
    return stats.corr_pair(T.rain_and_flow(spark, sf), "rain_sum_mm", "river_discharge_m3s", 6)


@query
def corr_matrix(spark, sf):
    weather = T.weather_daily(spark, sf)
    return stats.corr_matrix(weather, select.numeric_columns(weather), 6)


@query
def histogram(spark, sf):
    return rounded(stats.histogram(T.load(spark, sf, "orders"), "o_totalprice", 40))


@query
def box_stats(spark, sf):
    return rounded(stats.box_stats(T.readings(spark, sf), "rain", KEYS))


@query
def class_weights(spark, sf):
    return rounded(stats.class_weights(T.predictions(spark, sf), "label"))


@query
def label_ratio(spark, sf):
    return rounded(stats.label_ratio(S.label_at(T.flow_daily(spark, sf), "river_discharge_m3s", 100.0), "label", KEYS))


@query
def usable_length(spark, sf):
    return stats.min_usable_length(T.rain_and_flow(spark, sf), KEYS, "river_discharge_m3s")


@query
def count_flags(spark, sf):
    days = T.rain_and_flow(spark, sf)
    return stats.count_where(
        days,
        {"rainy": F.col("rain_sum_mm") > 0, "heavy": F.col("rain_sum_mm") > C.HEAVY_RAIN_MM,
         "flood": F.col("river_discharge_m3s") >= 100},
        KEYS,
    )


@query
def topk_days(spark, sf):
    return rounded(stats.top_k(T.rain_daily(spark, sf), ["rain_sum_mm", "date", "location"], 10))


# -- reshaping --------------------------------------------------------------


@query
def pivot_first_reading(spark, sf):
    days = T.load(spark, sf, "events").withColumn("date", F.to_date("ts"))
    return pivot_first(days, ["user_id"], "event_type", "value", ["click", "error", "purchase", "signup", "view"], "event_id")


@query
def unpivot(spark, sf):
    return rounded(to_long(T.rain_and_flow(spark, sf), ["location", "date"], ["rain_sum_mm", "rain_max_1h", "river_discharge_m3s"]))


# -- scalars and filters ----------------------------------------------------


@query
def calendar_features(spark, sf):
    days = T.rain_daily(spark, sf).select("location", "date")
    return days.withColumns(C.calendar_parts("date") | {"is_monsoon": C.season_flag("date"), "text": C.format_date("date"),
                                                        "tomorrow": C.shift_date("date", 1)})


@query
def local_days(spark, sf):
    local = C.to_local("datetime", "Asia/Kuala_Lumpur")
    return T.readings(spark, sf).select("event_id", local.alias("local_ts"), F.to_date(local).alias("local_date"))


@query
def composites(spark, sf):
    days = T.weather_daily(spark, sf)
    return rounded(days.select(
        "location", "date",
        C.composite({"rain_sum_mm": 1.0, "precipitation_sum_mm": 1.0, "wind_speed_max_mps": 0.5}).alias("atmo_index"),
        C.interaction("temperature_mean_c", "wind_speed_max_mps").alias("temp_wind"),
        C.spread("wind_gust_max_mps", "wind_speed_max_mps").alias("gust_spread"),
        C.safe_ratio("rain_sum_mm", "precipitation_sum_mm").alias("ratio"),
        C.clamp("rain_sum_mm", 5.0, 50.0).alias("clamped"),
        C.flag("rain_sum_mm", ">", C.HEAVY_RAIN_MM).alias("heavy_rain"),
    ))


@query
def risk_class(spark, sf):
    days = T.flow_daily(spark, sf)
    return days.select("location", "date", C.risk_class("river_discharge_m3s").alias("flood_risk"))


@query
def risk_counts(spark, sf):
    days = T.flow_daily(spark, sf).withColumn("flood_risk", C.risk_class("river_discharge_m3s"))
    return scoring.risk_counts(days, by=KEYS)


@query
def relabelled(spark, sf):
    names = {"P": "pending", "F": "filled"}
    orders = T.load(spark, sf, "orders").select(C.relabel("o_orderstatus", names).alias("status"))
    return orders.groupBy("status").agg(F.count("*").alias("n"))


@query
def relative_period(spark, sf):
    return rounded(select.last_period(T.rain_daily(spark, sf), "date", 6, floor="1995-01-01"))


@query
def year_slice(spark, sf):
    return select.in_year(T.order_readings(spark, sf), "datetime", 1998)


@query
def as_of_slice(spark, sf):
    return select.as_of(T.order_readings(spark, sf), "datetime", "1996-06-30")


@query
def date_range(spark, sf):
    return select.between_dates(T.readings(spark, sf), "datetime", "2024-01-05", "2024-01-10")


# -- sequences and splits ---------------------------------------------------


def _paired_days(spark, sf):
    return T.rain_daily(spark, sf).join(T.flow_daily(spark, sf), ["location", "date"], "inner")


def _sequence_facts(df):
    return rounded(df).withColumns({
        "n_values": F.size(F.flatten("sequence")),
        "first_value": F.round(F.col("sequence")[0][0], 6),
        "last_value": F.round(F.element_at(F.element_at("sequence", -1), 1), 6),
        "sum_values": F.round(F.aggregate(F.flatten("sequence"), F.lit(0.0), lambda a, x: a + x), 5),
    }).drop("sequence")


@query
def sequences(spark, sf):
    days = _paired_days(spark, sf)
    return _sequence_facts(S.sequences(days, KEYS, "date", ["rain_sum_mm", "river_discharge_m3s"], 14, "river_discharge_m3s"))


@query
def sequence_counts(spark, sf):
    return S.sequence_counts(_paired_days(spark, sf), KEYS, 14)


@query
def split_per_key(spark, sf):
    return S.chrono_split(_paired_days(spark, sf).select("location", "date"), KEYS, "date", chunk=DAILY)


@query
def split_concat(spark, sf):
    days = settle(_paired_days(spark, sf).select("location", "date"))
    return S.chrono_split(days, KEYS, "date", mode="concat", chunk=DAILY)


@query
def split_three_way(spark, sf):
    return S.chrono_split(_paired_days(spark, sf).select("location", "date"), KEYS, "date", (0.7, 0.15, 0.15), chunk=DAILY)


@query
def split_ceil_test(spark, sf):
    days = settle(_paired_days(spark, sf).select("location", "date"))
    return S.chrono_split(days, KEYS, "date", rounding="ceil_test", mode="concat", chunk=DAILY)


@query
def label_by_quantile(spark, sf):
    days = settle(T.flow_daily(spark, sf))
    return rounded(S.label_quantile(days, "river_discharge_m3s", 0.8, prefer="is_extreme_flood"))


@query
def training_set(spark, sf):
    made = training.make_training_set(_paired_days(spark, sf), ["rain_sum_mm", "rain_max_1h"], n=14, history=None, mode="concat")
    return _sequence_facts(made.sequences)


@query
def training_metadata(spark, sf):
    made = training.make_training_set(_paired_days(spark, sf), ["rain_sum_mm", "rain_max_1h"], n=14, history=None, mode="concat")
    return training.training_metadata(made, ["rain_sum_mm", "rain_max_1h"], "river_discharge_m3s", 14)


# -- evaluation -------------------------------------------------------------


@query
def binary_metrics(spark, sf):
    return rounded(metrics.binary_metrics(T.predictions(spark, sf), "label", "predicted"))


@query
def confusion(spark, sf):
    return metrics.confusion(T.predictions(spark, sf), "label", "predicted")


@query
def classification_report(spark, sf):
    return rounded(metrics.class_report(T.predictions(spark, sf), "label", "predicted"))


def _naive_models(spark, sf):
    """Two naive forecasts of the discharge: yesterday, and the mean of the last three days before."""
    c = "river_discharge_m3s"
    days = add_rows(T.flow_daily(spark, sf), KEYS, "date", {"yesterday": W.lag_of(c, 1), "mean3": W.rolling_of(c, 3, "mean")}, chunk=DAILY)
    return add_rows(days, KEYS, "date", {"last_mean3": W.lag_of("mean3", 1)}, chunk=DAILY)


NAIVE = {"Yesterday": "yesterday", "Mean of three": "last_mean3"}


@query
def rmse_mae(spark, sf):
    return rounded(evaluate.compare_errors(_naive_models(spark, sf), "river_discharge_m3s", NAIVE))


@query
def model_comparison(spark, sf):
    return rounded(evaluate.compare_at_threshold(_naive_models(spark, sf), "river_discharge_m3s", NAIVE, 200.0))


# -- payloads ---------------------------------------------------------------


@query
def json_props(spark, sf):
    parsed = T.load(spark, sf, "events").select("event_id", F.from_json("props", "k int").alias("props"))
    return P.flatten_struct(parsed)


@query
def payload_expand(spark, sf):
    return rounded(P.expand_payload(T.payloads(spark, sf), "Asia/Kuala_Lumpur", ["vec_id"]))


@query
def ensemble_expand(spark, sf):
    long = P.expand_ensemble(T.payloads(spark, sf), None, ["vec_id"])
    return rounded(P.route_variables(long, T.variable_names(spark)))


@query
def ensemble_wide(spark, sf):
    long = P.route_variables(P.expand_ensemble(T.payloads(spark, sf), None, ["vec_id"]), T.variable_names(spark))
    return rounded(P.members_to_wide(long.filter(F.col("variable") == "rain"), ["rain"], [0, 1], ["vec_id"]))


@query
def ensemble_mean(spark, sf):
    long = P.route_variables(P.expand_ensemble(T.payloads(spark, sf), None, ["vec_id"]), T.variable_names(spark))
    return rounded(P.pick_member(long, "rain", "mean", ["vec_id"]))


@query
def tag_location(spark, sf):
    return P.tag_location(T.payloads(spark, sf).select("vec_id", "latitude", "longitude"), T.places(spark, sf).select(
        "location", "latitude", "longitude")).select("vec_id", "location")


@query
def newest_payload(spark, sf):
    orders = T.load(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return P.newest_payload(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


# -- composed tables --------------------------------------------------------


@query
def feature_table(spark, sf):
    table = features.build_features(
        T.order_readings(spark, sf), T.rain_forecast(spark, sf), T.order_target(spark, sf), PRIORITIES
    )
    return rounded(table, 5)


@query
def feature_table_unscaled(spark, sf):
    table = features.build_features(
        T.order_readings(spark, sf), T.rain_forecast(spark, sf), T.order_target(spark, sf), PRIORITIES, scale=None
    )
    return rounded(table, 5)


@query
def feature_table_overlapping(spark, sf):
    """History and forecast both kept on the days they share."""
    table = features.build_features(
        T.order_readings(spark, sf), T.rain_forecast(spark, sf), T.order_target(spark, sf), PRIORITIES, "both", None
    )
    return rounded(table, 5)


@query
def feature_table_wide(spark, sf):
    readings = T.readings_wide(spark, sf)
    target = resample(readings, KEYS, "datetime", {"river_discharge_m3s": ("mean", "wind_speed_10m")}, n_obs=None, digits=T.DIGITS)
    return rounded(features.build_features_wide(readings, target))


@query
def discharge_features(spark, sf):
    return rounded(features.discharge_features(T.flow_daily(spark, sf)), 5)


@query
def weather_features(spark, sf):
    return rounded(features.weather_features(T.weather_daily(spark, sf)), 5)


@query
def joined_features(spark, sf):
    weather = features.weather_features(T.weather_daily(spark, sf))
    flow = features.discharge_features(T.flag_flow_daily(spark, sf))
    kept, _ = select.select_existing(features.joined_features(weather, flow), JOINED_COLUMNS)
    return rounded(kept, 5)


# One name does not exist: the selection has to leave it out.
JOINED_COLUMNS = [
    "location", "date", "rain_sum_mm", "atmo_index", "rain_lag_1d", "rain_cum_7d", "rain_sum_zscore",
    "wind_speed_zscore", "is_extreme_weather", "discharge_lag_1d", "discharge_cum_7d", "discharge_zscore",
    "dayofyear_flood", "month_weather", "weekday_flood", "river_discharge_m3s",
]


# -- forecasts --------------------------------------------------------------


def mean_model():
    """A stand-in model: the mean of the first feature over the sequence.

    An inner function travels to the workers by value, so they need not have this package.
    """

    def make():
        return lambda x: np.mean(x[:, :, 0], axis=1)

    return make


@query
def score_forecast(spark, sf):
    scored = scoring.score_forecast(T.flow_daily(spark, sf), ["river_discharge_m3s"], None, mean_model(), 14)
    return rounded(scored)


@query
def eligible_keys(spark, sf):
    ok, _ = S.eligible(T.load(spark, sf, "orders"), ["o_custkey"], 7)
    return ok.select("o_custkey", "o_orderkey")


@query
def rejected_keys(spark, sf):
    _, rejected = S.eligible(T.load(spark, sf, "orders"), ["o_custkey"], 7)
    return rejected


@query
def horizon_windows(spark, sf):
    return _sequence_facts(S.horizon_windows(T.rain_daily(spark, sf), KEYS, "date", ["rain_sum_mm"], 14, HORIZON_END))


@query
def horizon_per_key(spark, sf):
    """Each key's forecast ends a week after its own last day."""
    days = T.rain_daily(spark, sf)
    until = F.least(F.date_add(F.col("last_day"), 7), F.lit(HORIZON_END).cast("date"))
    days = with_global_stats(days, {"last_day": F.max("date")}, KEYS)
    return _sequence_facts(S.horizon_windows(days, KEYS, "date", ["rain_sum_mm"], 5, until))


@query
def horizon_forecast(spark, sf):
    scored, _ = scoring.forecast_horizon(
        T.rain_daily(spark, sf), ["rain_sum_mm"], None, mean_model(), HORIZON_END, 14, target=None
    )
    return rounded(scored)


@query
def actual_and_forecast(spark, sf):
    days = T.flow_daily(spark, sf)
    scored = scoring.score_forecast(days, ["river_discharge_m3s"], None, mean_model(), 7)
    return rounded(S.actual_vs_forecast(days, scored, KEYS, "date", "river_discharge_m3s", "predicted_discharge"))


@query
def forecast_driver(spark, sf):
    """The rain behind each prediction; days without rain keep their prediction."""
    days = T.flow_daily(spark, sf)
    scored = scoring.score_forecast(days, ["river_discharge_m3s"], None, mean_model(), 7)
    return rounded(attach_forecast_driver(scored, T.rain_daily(spark, sf), ["location", "date"]))


@query
def aligned_features(spark, sf):
    """Columns in model order; a feature the table lacks is zero because the caller says so."""
    days = T.rain_daily(spark, sf)
    return rounded(select.align_columns(days, ["rain_max_1h", "rain_mean", "rain_sum_mm"], "zero", keep=["location", "date"]))


@query
def filled_and_dropped(spark, sf):
    """Days with rain known, missing discharge as zero, and only the days above zero."""
    days = select.drop_null(T.rain_and_flow(spark, sf), ["rain_sum_mm"])
    known = select.fill_null(days, {"river_discharge_m3s": 0.0})
    return rounded(known.filter(C.is_in("location", PRIORITIES) & (F.col("river_discharge_m3s") > 0)))


# -- dashboard --------------------------------------------------------------


@query
def dashboard_overlay(spark, sf):
    view = dashboard.View(location="2-HIGH", start="1997-01-01", end="1998-12-31")
    overlay = dashboard.hourly_overlay(T.order_readings(spark, sf), T.flow_daily(spark, sf), view)
    return rounded(overlay)


@query
def overlay_all(spark, sf):
    readings = T.readings(spark, sf).withColumn("date", F.to_date("datetime"))
    days = resample(T.readings(spark, sf), KEYS, "datetime", {"day_max": ("max", "rain")}, n_obs=None)
    return spread_daily(readings, days, ["location", "date"], "day_max")


# -- trees ------------------------------------------------------------------


def _tree_rows(spark, sf):
    from riverframe.operators import models as M

    days = S.label_quantile(settle(_paired_days(spark, sf)), "river_discharge_m3s", 0.8)
    cut = S.sequences(days, KEYS, "date", ["rain_sum_mm", "river_discharge_m3s"], 7, "label", chunk=DAILY)
    split = S.chrono_split(cut, KEYS, "date", chunk=DAILY)
    rows = S.with_vector(S.flatten_sequences(split)).select("location", "date", "label", "split", "features")
    train = M.with_class_weights(rows.filter(F.col("split") == "train"))
    return train, rows.filter(F.col("split") == "test")


def _tree_scores(model, test, cut):
    from riverframe.operators import models as M

    scored = M.positive_probability(model.transform(test.drop("split")))
    decided = scored.withColumn("predicted", C.decide("p1", cut))
    return decided.select("location", "date", "label", F.round("p1", 6).alias("p1"), "predicted")


@query
def tree_scores(spark, sf):
    from riverframe.operators import models as M

    train, test = _tree_rows(spark, sf)
    return _tree_scores(M.fit_tree(train), test, 0.3)


@query
def forest_scores(spark, sf):
    from riverframe.operators import models as M

    train, test = _tree_rows(spark, sf)
    return _tree_scores(M.fit_forest(train), test, 0.4)


TREE_GRID = [{"maxDepth": d, "minInstancesPerNode": m} for d in (2, 3, 5, 8, 10) for m in (1, 10)]


@query
def tuned_tree(spark, sf):
    """F1 on the newer part of each key for ten parameter sets, fitted on the older part."""
    from pyspark.ml.classification import DecisionTreeClassifier

    from riverframe.operators import models as M

    train, test = _tree_rows(spark, sf)
    rows = train.unionByName(test.withColumn("weight", F.lit(1.0)))
    _, table = M.tune(rows, DecisionTreeClassifier(weightCol="weight", seed=42), TREE_GRID)
    return spark.createDataFrame([(t["maxDepth"], t["minInstancesPerNode"], t["f1"]) for t in table], "max_depth int, min_rows int, f1 double")
