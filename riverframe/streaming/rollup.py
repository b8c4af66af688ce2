"""The daily roll-up and risk classes on a stream of landed readings.

An addition to the batch job, for folders that keep growing: the same operators, with a
watermark that bounds the state to the open days of each key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riverframe.functions.columns import RISK_CUTS, risk_class


def stream_readings(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


def daily_rollup_stream(
    readings: DataFrame,
    keys: Sequence[str] = ("location",),
    ts: str = "datetime",
    value: str = "rain",
    lateness: str = "2 days",
) -> DataFrame:
    """Sum, maximum and count per key and day. A day is emitted once, when the watermark has
    passed it; a reading later than ``lateness`` is dropped."""
    stamped = readings.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", lateness)
    days = stamped.groupBy(*keys, F.window("__ts", "1 day").alias("__day")).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("rain_sum_mm"),
        F.max(value).alias("rain_max_1h"),
        F.count("*").alias("n_obs"),
    )
    return days.select(*keys, F.to_date("__day.start").alias("date"), "rain_sum_mm", "rain_max_1h", "n_obs")


def with_risk(stream: DataFrame, c: str = "predicted_discharge", cuts=RISK_CUTS) -> DataFrame:
    return stream.withColumn("flood_risk", risk_class(c, cuts))


def write_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append to Parquet. ``checkpoint`` must be on shared storage: it is what a restart resumes from."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)
