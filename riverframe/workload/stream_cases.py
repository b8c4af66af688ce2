"""Streams replayed over the given readings: what landed in three parts, each drained by a restarted query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.streaming.averages import ema_stream
from riverframe.streaming.rollup import daily_rollup_stream, stream_readings, write_stream
from riverframe.workload import oracles as Q
from riverframe.workload import tables as T
from riverframe.workload.cases import case, scratch
from riverframe.workload.queries import KEYS, rounded

PARTS = 3
LATENESS = "2 days"
SCHEMA = "location string, datetime timestamp_ntz, rain double, event_id bigint"
AVERAGES = {"ema4": 0.4, "api": 0.2}
CLOSED = "(SELECT date_trunc('day', max(datetime) - INTERVAL 2 DAY) FROM readings)"


def replay(spark, sf: str, name: str, job: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Lands the readings in ``PARTS`` spans of time, in random order within each, and drains the stream after every one."""
    landing, out, check = (scratch(spark, f"{name}-{part}") for part in ("landing", "out", "check"))
    readings = T.readings(spark, sf)
    lo, hi = readings.agg(F.min("datetime"), F.max("datetime")).first()
    edges = [lo + (hi - lo) * k / PARTS for k in range(1, PARTS)]
    part = sum(((F.col("datetime") >= F.lit(e)).cast("int") for e in edges), F.lit(0))
    for k in range(PARTS):
        readings.where(part == k).repartition("event_id").write.mode("append").parquet(landing)
        query = write_stream(job(stream_readings(spark, landing, SCHEMA, files_per_trigger=100_000)), out, check, available_now=True)
        query.awaitTermination()
    return spark.read.parquet(out)


@case(f"""WITH RECURSIVE {Q.READINGS}, {Q.ema_cte('readings', 'rain', AVERAGES, 'datetime, event_id')}
SELECT n.location, datetime, event_id, {Q.r('rain', 'ema4', 'api')} FROM numbered n JOIN ema USING (location, pos) WHERE datetime < {CLOSED}""")
def ema_replayed(spark, sf):
    """The averages of all closed days from keyed state, as on the whole table."""
    return rounded(replay(spark, sf, "ema-replay", lambda r: ema_stream(r, KEYS, "datetime", "rain", AVERAGES, "event_id", LATENESS)))


@case(f"""WITH {Q.READINGS} SELECT location, CAST(datetime AS DATE) AS date, round(sum(rain), 6) AS rain_sum_mm, round(max(rain), 6) AS rain_max_1h, count(*) AS n_obs
FROM readings WHERE datetime < {CLOSED} GROUP BY 1, 2""")
def rollup_replayed(spark, sf):
    """The daily roll-up of all closed days from window state."""
    return rounded(replay(spark, sf, "rollup-replay", lambda r: daily_rollup_stream(r, KEYS, "datetime", "rain", LATENESS)))
