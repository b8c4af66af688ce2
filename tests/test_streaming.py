"""The streamed roll-up and averages are those of the batch for every day the watermark has closed."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riverframe.operators.ema import emas
from riverframe.operators.resample import resample
from riverframe.streaming.averages import ema_stream
from riverframe.streaming.rollup import daily_rollup_stream, stream_readings, with_risk, write_stream

AVERAGES = {"fast": 0.4, "slow": 0.1, "same": 1.0}


def land(spark, path, data, i):
    df = spark.createDataFrame(data, "location string, datetime timestamp_ntz, rain double")
    df.coalesce(1).write.mode("append").parquet(path)


def test_rollup_stream(spark, rows, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    t0 = dt.datetime(2024, 1, 1)
    first = [("a", t0 + dt.timedelta(hours=h), float(h)) for h in range(0, 120, 3)]
    land(spark, src, first, 0)

    def drain():
        readings = stream_readings(spark, src, "location string, datetime timestamp_ntz, rain double")
        query = write_stream(daily_rollup_stream(readings, lateness="1 day"), out, check, available_now=True)
        query.awaitTermination(120)
        assert query.exception() is None

    drain()
    # A reading for a closed day is too late; one far ahead closes the rest.
    land(spark, src, [("a", t0, 1000.0), ("a", t0 + dt.timedelta(days=30), 1.0)], 1)
    drain()
    want = resample(spark.createDataFrame(first, "location string, datetime timestamp_ntz, rain double"), ["location"],
                    "datetime", {"rain_sum_mm": ("sum", "rain"), "rain_max_1h": ("max", "rain")})
    got = spark.read.parquet(out)
    assert rows(got, *want.columns[:4]) == rows(want, *want.columns[:4])
    assert with_risk(got, "rain_sum_mm").filter("flood_risk = 'HIGH'").count() == want.filter("rain_sum_mm > 300").count()


SCHEMA = "location string, id long, datetime timestamp_ntz, rain double"


def drain(spark, src, out, check, **how):
    readings = stream_readings(spark, src, SCHEMA)
    query = write_stream(ema_stream(readings, ["location"], "datetime", "rain", AVERAGES, "id", "1 day", **how), out, check, available_now=True)
    query.awaitTermination(120)
    assert query.exception() is None


def test_averages_from_keyed_state(spark, rows, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    t0, rng = dt.datetime(2024, 1, 1), random.Random(3)
    # Three keys (one missing) with gaps and equal stamps; "b" falls silent after its first days.
    def reading(k, i):
        return (k, i, t0 + dt.timedelta(hours=3 * (i // 2)), None if i % 5 == 2 else float("nan") if i % 11 == 4 else rng.uniform(0, 9))

    first = [reading(k, i) for k in ("a", "b", None) for i in range(0, 40)]
    second = [reading(k, i) for k in ("a", None) for i in range(40, 90)]
    late = [("a", 1000, t0, 1e6), ("b", 1001, t0 + dt.timedelta(hours=5), 1e6)]
    last = [("c", 2000, t0 + dt.timedelta(days=60), 1.0), ("a", 2001, None, 5.0)]
    for part in (first, second, late + last):
        rng.shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        drain(spark, src, out, check)
    table = spark.createDataFrame(first + second, SCHEMA)
    want = emas(table, ["location"], "datetime", "rain", AVERAGES, ["id"])
    order = ("location", "id", "datetime")
    digits = [F.round(F.nanvl(c, F.lit(None)), 9).alias(c) for c in ("rain", *AVERAGES)]
    got = spark.read.parquet(out)
    assert got.schema["datetime"].dataType == table.schema["datetime"].dataType
    assert rows(got.select(*order, *digits)) == rows(want.select(*order, *digits))


def test_averages_of_an_empty_stream_and_bad_factors(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([], SCHEMA).write.parquet(src)
    drain(spark, src, out, check, unit_seconds=3600)
    assert spark.read.schema(SCHEMA).parquet(out).count() == 0
    for alphas in ({}, {"x": 0.0}, {"x": 1.5}):
        with pytest.raises(ValueError):
            ema_stream(spark.createDataFrame([], SCHEMA), ["location"], "datetime", "rain", alphas)
