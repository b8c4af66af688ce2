"""Late pulls: tables after many landings against one rebuild, and what stays untouched."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from riverframe.plans import incremental as L
from riverframe.sources import tables

SCHEMA = "location string, datetime timestamp_ntz, id int, rain double, pulled_at timestamp_ntz"
START = dt.datetime(2023, 1, 1)


def landing(rng, k, first, days, locations, gap=1):
    """Readings of some days; a tenth is missing in this pull, some are new values, some are NULL."""
    rows = []
    for key in locations:
        for d in range(first, first + days, gap):
            for i in range(3):
                if rng.random() < 0.9:
                    value = None if rng.random() < 0.05 else round(rng.uniform(0, 30), 2)
                    rows.append((key, START + dt.timedelta(days=d, hours=7 * i), i, value, START + dt.timedelta(days=1000 + k)))
    return rows


def content(store, table, *cols):
    rows = store.read(table).select(*cols).collect()
    return {tuple(r[c] for c in cols[:2]): [None if r[c] is None else round(r[c], 6) for c in cols[2:]] for r in rows}


FEATURES = ["rain_sum_mm", "rain_max_1h", "rain_sum_lag_1", "rain_sum_lag_3", "rain_sum_lag_7", "rain_sum_roll3", "rain_sum_roll7", "rain_sum_roll14", "rain_delta_1d", "rain_ema_3", "rain_ema_7", "rain_api_7d", "position"]


@pytest.mark.parametrize("seed", [1, 2])
def test_tables_after_many_landings_equal_one_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    step = L.Store(spark, str(tmp_path / "step"), ("location", "datetime", "id"))
    # "sparse" has a reading every 40 days, so that 14 rows reach back over a year.
    landings = [
        landing(rng, 0, 0, 150, ["a", "b"]) + landing(rng, 0, 0, 700, ["sparse"], 40),
        landing(rng, 1, 120, 60, ["a", "b", "c"]),
        landing(rng, 2, 40, 3, ["b"]),  # long after
        landing(rng, 3, 690, 20, ["sparse"], 5) + landing(rng, 3, 170, 20, ["a"]),
        landing(rng, 4, 300, 2, ["sparse"]) + [(None, START, 0, 1.0, START), ("a", None, 0, 1.0, START)],
    ]
    everything = []
    for rows in landings:
        L.late_pull(step, spark.createDataFrame(rows, SCHEMA).repartition(3))
        everything += rows
    # An older pull that arrives last changes only what no later pull has.
    old = [(k, t, i, 99.0, START) for k, t, i, _, _ in landings[0][:40]] + [("a", START + dt.timedelta(days=77, hours=1), 9, 5.0, START)]
    L.late_pull(step, spark.createDataFrame(old, SCHEMA))
    whole = L.Store(spark, str(tmp_path / "whole"), ("location", "datetime", "id"))
    L.late_pull(whole, spark.createDataFrame(everything + old, SCHEMA))
    for table, cols in (("days", ["rain_sum_mm", "rain_max_1h"]), ("features", FEATURES)):
        got, want = (content(s, table, "location", "date", *cols) for s in (step, whole))
        assert got.keys() == want.keys() and len(got) > 300
        for k, v in want.items():
            assert got[k] == pytest.approx(v, abs=1e-6, nan_ok=True), (table, k)
    assert step.read("readings").count() == whole.read("readings").count() == step.read("readings").select("location", "datetime", "id").distinct().count()


def files(store, table):
    return {p.split("month=")[1][:6]: p for p in glob.glob(f"{store.path(table)}/month=*/*.parquet")}


def test_untouched_months_and_locations_stay(spark, tmp_path):
    rng = random.Random(4)
    store = L.Store(spark, str(tmp_path / "s"), ("location", "datetime", "id"))
    L.late_pull(store, spark.createDataFrame(landing(rng, 0, 0, 360, ["a", "b"]), SCHEMA))
    before = {t: files(store, t) for t in ("readings", "days", "features")}
    kept = content(store, "features", "location", "date", *FEATURES)
    late = [("a", START + dt.timedelta(days=300, hours=7), 1, 1234.5, START + dt.timedelta(days=2000))]
    changed = L.late_pull(store, spark.createDataFrame(late, SCHEMA))
    assert [tuple(r) for r in changed.days.collect()] == [("a", dt.date(2023, 10, 28), 202310)]
    assert changed.months == {"readings": [202310], "days": [202310], "features": [202310, 202311, 202312]}
    for table, months in changed.months.items():
        now = files(store, table)
        assert {m for m in now if now[m] != before[table][m]} == {str(m) for m in months}
    now = content(store, "features", "location", "date", *FEATURES)
    differ = {k for k in now if now[k] != kept[k]}
    assert differ and all(k[0] == "a" and k[1] >= dt.date(2023, 10, 28) for k in differ)


def test_a_pull_of_the_same_readings_touches_nothing(spark, tmp_path):
    store = L.Store(spark, str(tmp_path / "s"), ("location", "datetime", "id"))
    rows = spark.createDataFrame(landing(random.Random(5), 0, 0, 40, ["a"]), SCHEMA)
    L.late_pull(store, rows)
    before = {t: files(store, t) for t in ("days", "features")}
    again = L.late_pull(store, rows.withColumn("pulled_at", F.col("pulled_at") + F.expr("interval 1 day")))
    assert again.days.count() == 0 and again.months["days"] == again.months["features"] == []
    assert before == {t: files(store, t) for t in ("days", "features")}
    L.late_pull(store, rows.limit(0))
    assert before == {t: files(store, t) for t in ("days", "features")}


def test_features_read_only_the_months_they_need(spark, tmp_path, monkeypatch):
    store = L.Store(spark, str(tmp_path / "s"), ("location", "datetime", "id"))
    L.late_pull(store, spark.createDataFrame(landing(random.Random(6), 0, 0, 360, ["a"]), SCHEMA))
    plans = []
    settle = L.settle

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return settle(df, name)

    monkeypatch.setattr(L, "settle", watched)
    late = [("a", START + dt.timedelta(days=340), 1, 5.0, START + dt.timedelta(days=2000))]
    L.late_pull(store, spark.createDataFrame(late, SCHEMA))
    scans = [line for plan in plans for line in plan.split("\n") if "FileScan parquet" in line and "/s/" in line]
    assert scans and all("PartitionFilters: [isnotnull(month" in line or "PartitionFilters: [month" in line for line in scans)


def test_order_report_finds_disorder(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id", "id % 3 AS part")
    good, bad, over = (str(tmp_path / n) for n in ("good", "bad", "over"))
    tables.write_table(df, good, partition_by=["part"], sort_by=["k", "id"])
    summary = tables.order_summary(tables.order_report(spark, good, ["k", "id"], ["part"]), ["k", "id"], ["part"]).collect()
    assert len(summary) == 3 and all(r["sorted"] and r["apart"] for r in summary) and sum(r["n_rows"] for r in summary) == 1000
    df.orderBy(F.rand(1)).coalesce(1).write.parquet(bad)
    assert tables.order_summary(tables.order_report(spark, bad, ["k", "id"]), ["k", "id"]).first()["sorted"] is False
    df.repartition(4, "part").sortWithinPartitions("k", "id").write.parquet(over)
    r = tables.order_summary(tables.order_report(spark, over, ["k", "id"]), ["k", "id"]).first()
    assert r["sorted"] is True and r["apart"] is False
