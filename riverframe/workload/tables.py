"""The driver tables seen as readings, daily rain, daily discharge and payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverframe.operators.resample import resample

DIGITS = 11


SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table by its known schema, which saves a job that reads footers."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Irregular readings: one event, its type as location."""
    return load(spark, sf, "events").select(
        F.col("event_type").alias("location"), F.col("ts").alias("datetime"), F.col("value").alias("rain"), "event_id"
    )


def readings_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with five variables."""
    k = F.get_json_object("props", "$.k").cast("double")
    return load(spark, sf, "events").select(
        F.col("event_type").alias("location"),
        F.col("ts").alias("datetime"),
        F.col("value").alias("rain"),
        (F.col("value") * 0.5).alias("precipitation"),
        F.col("user_id").cast("double").alias("temperature_2m"),
        k.alias("wind_speed_10m"),
        (k * 1.5).alias("wind_gusts_10m"),
    )


def order_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Rain readings: one order, its priority as location."""
    return load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("location"),
        F.col("o_orderdate").alias("datetime"),
        (F.col("o_totalprice") / 9973.0).alias("rain"),
    )


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with the priority of their order as location."""
    priority = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("location"))
    items = load(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", F.col("l_shipdate").alias("datetime"))
    return items.join(priority, items.l_orderkey == priority.o_orderkey).select(
        "location", "datetime", "l_extendedprice"
    )


def rain_daily(spark: SparkSession, sf: str) -> DataFrame:
    aggs = {"rain_sum_mm": ("sum", "rain"), "rain_max_1h": ("max", "rain")}
    return resample(order_readings(spark, sf), ["location"], "datetime", aggs, n_obs=None, digits=DIGITS)


def flow_daily(spark: SparkSession, sf: str) -> DataFrame:
    flow = shipments(spark, sf).withColumn("flow", F.col("l_extendedprice") / 997.0)
    return resample(flow, ["location"], "datetime", {"river_discharge_m3s": ("sum", "flow")}, n_obs=None, digits=DIGITS)


def rain_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments as forecast readings: they reach past the last order and overlap history."""
    return shipments(spark, sf).select("location", "datetime", (F.col("l_extendedprice") / 9973.0).alias("rain"))


def order_target(spark: SparkSession, sf: str) -> DataFrame:
    """Daily target known on order days only."""
    orders = order_readings(spark, sf).withColumn("level", F.col("rain") * 10.0)
    return resample(orders, ["location"], "datetime", {"river_discharge_m3s": ("mean", "level")}, n_obs=None, digits=DIGITS)


def rain_and_flow(spark: SparkSession, sf: str) -> DataFrame:
    """All rain days with the discharge of the day where there is one."""
    return rain_daily(spark, sf).join(flow_daily(spark, sf), ["location", "date"], "left")


def weather_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily weather: line items by return flag and ship day."""
    items = load(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("location"),
        F.col("l_shipdate").alias("datetime"),
        (F.col("l_extendedprice") / 9973.0).alias("price"),
        "l_quantity",
        (F.col("l_tax") * 100.0).alias("tax"),
        (F.col("l_discount") * 100.0).alias("discount"),
    )
    aggs = {
        "rain_sum_mm": ("sum", "price"),
        "precipitation_sum_mm": ("sum", "l_quantity"),
        "temperature_mean_c": ("mean", "l_quantity"),
        "wind_speed_max_mps": ("max", "tax"),
        "wind_gust_max_mps": ("max", "discount"),
    }
    return resample(items, ["location"], "datetime", aggs, n_obs=None, digits=DIGITS)


def flag_flow_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily discharge with the same key as :func:`weather_daily`."""
    items = load(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("location"),
        F.col("l_shipdate").alias("datetime"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) / 997.0).alias("flow"),
    )
    return resample(items, ["location"], "datetime", {"river_discharge_m3s": ("sum", "flow")}, n_obs=None, digits=DIGITS)


def payloads(spark: SparkSession, sf: str) -> DataFrame:
    """One response per embedding: four variable arrays of 16 hourly values."""
    def part(code: str, altitude: int, member: int, first: int):
        return F.struct(
            F.lit(code).alias("code"), F.lit(altitude).alias("altitude"), F.lit(member).alias("member"),
            F.slice("embedding", first, 16).alias("values"),
        )

    start = F.lit(1704067200) + F.col("vec_id") * 57600
    return load(spark, sf, "embeddings").select(
        "vec_id",
        F.col("label").cast("double").alias("latitude"),
        (F.col("label") / 2.0).alias("longitude"),
        start.alias("start"),
        (start + 57600).alias("end"),
        F.lit(3600).alias("interval"),
        F.array(
            part("rain", 0, 0, 1), part("rain", 0, 1, 17), part("temperature", 2, 0, 33), part("wind", 10, 0, 49)
        ).alias("vars"),
    )


def variable_names(spark: SparkSession) -> DataFrame:
    # Which (code, altitude) is which column.
    return spark.sql(
        "SELECT * FROM VALUES ('rain', 0, 'rain'), ('temperature', 2, 'temperature_2m'), ('wind', 10, 'wind_speed_10m')"
        " AS names(code, altitude, variable)"
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as the location dimension."""
    return load(spark, sf, "nation").select(
        F.col("n_name").alias("location"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        (F.col("n_nationkey") / 2.0).alias("longitude"),
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Quality as truth and toxicity as prediction."""
    return load(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"), F.col("toxic").alias("predicted"))
