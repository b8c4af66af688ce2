"""Scalar functions, with the edge values of the input data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riverframe.functions import columns as C


def one(spark, sql, **cols):
    row = spark.sql(f"SELECT {sql}").select(*[c.alias(n) for n, c in cols.items()]).first()
    return row.asDict()


def test_timestamps(spark):
    got = one(
        spark,
        "'2024-02-30' AS bad, '2024-02-29 16:00:00' AS good, 1704067200 AS epoch",
        bad=C.parse_ts("bad"),
        good=C.parse_ts("good"),
        epoch=C.from_epoch("epoch"),
        local=C.to_local(C.parse_ts("good"), "Asia/Kuala_Lumpur"),
        day=C.to_day(C.to_local(C.parse_ts("good"), "Asia/Kuala_Lumpur")),
    )
    assert got["bad"] is None
    assert got["good"] == dt.datetime(2024, 2, 29, 16)
    assert got["epoch"] == dt.datetime(2024, 1, 1)
    # Local midnight is 16:00 of the day before in UTC.
    assert got["local"] == dt.datetime(2024, 3, 1)
    assert got["day"] == dt.date(2024, 3, 1)
    with pytest.raises(Exception):
        one(spark, "'nonsense' AS s", t=C.parse_ts("s", strict=True))


def test_epoch_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, "0 AS e", t=C.from_epoch("e"))["t"] == dt.datetime(1970, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_skipped_hours_stay_in_order(spark):
    """In the night New York skips 02:00-03:00, zone-less stamps keep their text and their order."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = ["2024-03-10 01:59:59.5", "2024-03-10 02:45:00", "2024-03-10 03:15:00.000001"]
        df = spark.createDataFrame([(t,) for t in texts], "s string").select("s", C.parse_ts("s").alias("t"))
        got = df.select(F.col("t").cast("string"), C.wall_micros("t")).collect()
        assert [r[0] for r in got] == texts
        start = dt.datetime(2024, 3, 10)
        epoch = int((start - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
        assert [r[1] - epoch for r in got] == [7_199_500_000, 9_900_000_000, 11_700_000_001]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar(spark):
    got = one(spark, "date'2024-12-29' AS d", monsoon=C.season_flag("d"), text=C.format_date("d"),
              next=C.shift_date("d", 3), **C.calendar_parts("d"))
    assert got == {"monsoon": 1, "text": "2024-12-29", "next": dt.date(2025, 1, 1), "year": 2024, "month": 12,
                   "dayofyear": 364, "weekday": 6, "is_weekend": 1}


def test_horizon_end(spark):
    got = one(spark, "date'2024-01-10' AS m, date'2024-01-01' AS r", a=C.horizon_end("m", "r"), b=C.horizon_end("r", "r"))
    assert got == {"a": dt.date(2024, 1, 15), "b": dt.date(2024, 1, 8)}


def test_keys_and_labels(spark):
    got = one(spark, "' Klang ' AS k, CAST(NULL AS STRING) AS n", k=C.clean_key("k"), n=C.clean_key("n"),
              mapped=C.relabel(C.clean_key("k"), {"Klang": "K"}), kept=C.relabel("k", {"x": "y"}),
              label=C.label_if(F.lit(0.0) > 0, "Rain", "No Rain"))
    assert got == {"k": "Klang", "n": None, "mapped": "K", "kept": " Klang ", "label": "No Rain"}


def test_flags_and_bounds(spark):
    got = one(
        spark, "50.0D AS x, CAST(NULL AS DOUBLE) AS n, 1 AS a, 0 AS b, double('NaN') AS nan",
        equal_not_above=C.flag("x", ">", 50), at_threshold=C.flag("x", ">=", 50), missing=C.flag("n", ">", 0),
        both=C.all_flags("a", "b"), either=C.any_flag("a", "b"),
        low=C.clamp("x", 60, 70), high=C.clamp("x", 1, 2), none=C.clamp("n", 1, 2),
        cut=C.decide("x", 50.0), cut_closed=C.decide("x", 50.0, strict=False), nan=C.nan_to_null("nan"),
    )
    assert got == {"equal_not_above": 0, "at_threshold": 1, "missing": 0, "both": 0, "either": 1, "low": 60.0,
                   "high": 2.0, "none": None, "cut": 0, "cut_closed": 1, "nan": None}


@pytest.mark.parametrize(
    "value, name",
    [("300.0D", "MEDIUM"), ("300.1D", "HIGH"), ("150.0D", "LOW"), ("CAST(NULL AS DOUBLE)", "LOW"), ("double('NaN')", "LOW")],
)
def test_risk_class(spark, value, name):
    assert one(spark, f"{value} AS x", r=C.risk_class("x"))["r"] == name


def test_arithmetic(spark):
    got = one(spark, "2.0D AS a, CAST(NULL AS DOUBLE) AS n, 0.0D AS z", c=C.composite({"a": 1.0, "n": 3.0, "z": 0.5}),
              i=C.interaction("a", "n"), s=C.spread("a", "z"), r=C.safe_ratio("a", "z", 0.5), x=C.safe_ratio("a", "z", 0.0))
    assert got == {"c": 2.0, "i": 0.0, "s": 2.0, "r": 4.0, "x": None}
