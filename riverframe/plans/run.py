"""The whole job in one Spark application: stages hand DataFrames to each other, not files."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverframe.functions.columns import to_local
from riverframe.operators.categories import INDEX, Categories, feature_order, fit_categories
from riverframe.operators.scaling import MAX_ONE_HOT
from riverframe.operators.select import normalize_keys
from riverframe.plans.combine import combine_hourly_daily, local_days
from riverframe.plans.features import DAY, FORECAST, KEY, KIND, TARGET, build_features, feature_names
from riverframe.plans.scoring import score_forecast
from riverframe.plans.training import TrainingSet, make_training_set, training_metadata
from riverframe.sources import schemas, tables
from riverframe.sources.payloads import pick_member


@dataclass(frozen=True)
class RunConfig:
    """All paths and parameters of a run. Zones are those the files are stamped in."""

    weather_hourly: str
    flood_daily: str
    out: str
    weather_forecast: str | None = None
    locations: Sequence[str] | None = None  # None: those in the data
    variable: str = "rain"  # of an ensemble forecast
    member: int | str = 0  # of an ensemble forecast; "mean" and "median" go across members
    hourly_tz: str | None = None
    daily_tz: str | None = None
    sequence_length: int = 14
    fmt: str = "csv"


def load_inputs(spark: SparkSession, cfg: RunConfig) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    def readings(path: str) -> DataFrame:
        raw = normalize_keys(tables.read_table(spark, path, schemas.WEATHER_HOURLY, cfg.fmt), "datetime")
        return raw.withColumn("datetime", to_local("datetime", cfg.hourly_tz)) if cfg.hourly_tz else raw

    hourly = readings(cfg.weather_hourly)
    daily = tables.read_table(spark, cfg.flood_daily, schemas.FLOOD_DAILY, cfg.fmt)
    forecast = _forecast(spark, cfg, readings) if cfg.weather_forecast else None
    return hourly, forecast, daily


def _forecast(spark: SparkSession, cfg: RunConfig, readings: Callable[[str], DataFrame]) -> DataFrame:
    """A forecast as one of three files: hourly rain, rain with one column per ensemble member, or days."""
    header = spark.read.format(cfg.fmt).option("header", True).load(cfg.weather_forecast).columns
    members = [c for c in header if re.fullmatch(rf"{cfg.variable}_member\d+", c)]
    stamp = "datetime" if "datetime" in header else "date"
    if not members and stamp == "datetime":
        return readings(cfg.weather_forecast)
    values = members or [cfg.variable]
    types = {KEY: "string", stamp: "string"}
    raw = tables.read_table(spark, cfg.weather_forecast, ", ".join(f"`{c}` {types.get(c, 'double' if c in values else 'string')}" for c in header), cfg.fmt)
    raw = normalize_keys(raw.withColumnRenamed(stamp, "datetime"), "datetime")
    if cfg.hourly_tz and stamp == "datetime":
        raw = raw.withColumn("datetime", to_local("datetime", cfg.hourly_tz))
    if not members:
        return raw.select(KEY, "datetime", F.col(cfg.variable).alias("rain"))
    if isinstance(cfg.member, int):
        return raw.select(KEY, "datetime", F.col(f"{cfg.variable}_member{cfg.member}").alias("rain"))
    cells = F.explode(F.array(*[F.struct(F.lit(int(c.rsplit("member", 1)[1])).alias("member"), F.col(c).alias("value")) for c in members]))
    long = raw.select(KEY, "datetime", cells.alias("m")).select(KEY, "datetime", F.lit(cfg.variable).alias("variable"), "m.*")
    return pick_member(long, cfg.variable, cfg.member, [KEY], "rain")


def found_locations(hourly: DataFrame, forecast: DataFrame | None) -> list[str] | Categories:
    """The locations in the data: names, for a column each, or a table of categories if there are more than MAX_ONE_HOT."""
    keys = hourly.select(KEY) if forecast is None else hourly.select(KEY).unionAll(forecast.select(KEY))
    names = [r[0] for r in keys.dropna().distinct().orderBy(KEY).limit(MAX_ONE_HOT + 1).collect()]
    return names if len(names) <= MAX_ONE_HOT else fit_categories(keys.distinct(), KEY)


def _write_by_year(df: DataFrame, path: str, ts: str, sort_by: Sequence[str]) -> None:
    """Directories by year, however many locations there are; sorted by location inside."""
    tables.write_table(df.withColumn("year", F.year(ts)), path, partition_by=["year"], sort_by=sort_by)


def run(spark: SparkSession, cfg: RunConfig, make_model: Callable | None = None) -> TrainingSet:
    """Combine, build features, cut the training set and, given a model, score the forecast.

    With more than MAX_ONE_HOT locations the table has their places (``loc_index``), ``categories`` is written beside it, and
    the model gets the places as a second argument.
    """
    hourly, forecast, daily = load_inputs(spark, cfg)
    combined = combine_hourly_daily(hourly, daily, daily_tz=cfg.daily_tz)
    _write_by_year(combined, f"{cfg.out}/combined", "datetime", [KEY, "datetime"])

    locations = list(cfg.locations) if cfg.locations is not None else found_locations(hourly, forecast)
    place = INDEX if isinstance(locations, Categories) else None
    table = build_features(hourly, forecast, local_days(daily, "date", cfg.daily_tz), locations, scale=None)
    # Written once and read back: the stages after it share one result instead of recomputing it.
    _write_by_year(table, f"{cfg.out}/features_daily", DAY, [KEY, DAY])
    table = spark.read.schema(table.schema).parquet(f"{cfg.out}/features_daily")

    if place:  # the same places, with the shares of the table's rows
        fit_categories(table, KEY).save(f"{cfg.out}/categories")

    features = feature_names(locations)
    training = make_training_set(table, features, TARGET, n=cfg.sequence_length, settled=True, carry=[place] if place else [])
    tables.save_stats(training.scaler, f"{cfg.out}/scaler_stats")
    tables.write_feature_list(spark, feature_order(features) if place else features, f"{cfg.out}/feature_columns")
    tables.write_metadata(
        training_metadata(training, features, TARGET, cfg.sequence_length), f"{cfg.out}/training_metadata"
    )
    tables.write_table(training.counts, f"{cfg.out}/sequence_counts")

    if make_model is not None:
        scaler = tables.load_stats(spark, f"{cfg.out}/scaler_stats", expect=features)
        scored = score_forecast(
            table.dropna(subset=list(features)), features, scaler, make_model, cfg.sequence_length, ahead=(KIND, FORECAST), category=place
        )
        _write_by_year(scored, f"{cfg.out}/flood_forecast", DAY, [KEY, DAY])
    return training
