"""Composed tables, the traps of the input data, and the shape of the physical plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from riverframe.plans import combine, dashboard, extremes, features, profile, scoring
from riverframe.plans.run import RunConfig, run
from riverframe.plans.training import make_training_set
from riverframe.sources import tables


def stamps(spark, data, name="datetime", value="rain"):
    df = spark.createDataFrame(data, f"location string, {name} string, {value} double")
    return df.withColumn(name, F.col(name).cast("timestamp_ntz"))


def test_join_uses_one_calendar(spark, rows):
    """A discharge stamped 16:00 UTC belongs to the next local day, as the local rain does."""
    hourly = stamps(spark, [("Klang", "2024-01-02 00:00:00", 1.0), ("Klang", "2024-01-02 23:00:00", 2.0)])
    daily = stamps(spark, [("Klang", "2024-01-01 16:00:00", 50.0)], "date", "river_discharge_m3s")
    aligned = combine.combine_hourly_daily(hourly, daily, daily_tz="Asia/Kuala_Lumpur")
    assert rows(aligned, "rain", "river_discharge_m3s") == [(1.0, 50.0), (2.0, 50.0)]
    assert combine.combine_hourly_daily(hourly, daily).count() == 0
    kept = combine.combine_hourly_daily(hourly, daily, how="left", fill=0.0)
    assert rows(kept, "rain", "river_discharge_m3s") == [(1.0, 0.0), (2.0, 0.0)]


@pytest.fixture(scope="module")
def world(spark):
    """Forty days of hourly rain in two places, a forecast overlapping by two days, a target."""
    def hours(place, first, n, base):
        t0 = dt.datetime(2024, 1, 1) + dt.timedelta(days=first)
        return [(place, str(t0 + dt.timedelta(hours=6 * i)), float((base + 7 * i) % 23)) for i in range(4 * n)]

    hourly = stamps(spark, hours("Klang", 0, 40, 1) + hours("Petaling", 0, 40, 5))
    forecast = stamps(spark, hours("Klang", 38, 20, 2) + hours("Petaling", 38, 20, 3))
    days = [(p, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(40 + (i * 13) % 31)) for p in ("Klang", "Petaling") for i in range(40)]
    daily = spark.createDataFrame(days, "location string, date date, river_discharge_m3s double")
    return hourly, forecast, daily


def day_totals(hourly, forecast, overlap):
    """{place: [(day, kind, sum, max)]} in the order of day and kind."""
    readings = {}
    for kind, frame in (("historical", hourly), ("forecast", forecast)):
        for r in frame.collect():
            readings.setdefault((r.location, r.datetime.date(), kind), []).append(r.rain)
    if overlap == "historical":
        readings = {k: v for k, v in readings.items() if k[2] == "historical" or (k[0], k[1], "historical") not in readings}
    out = {}
    for place, day, kind in sorted(readings):
        values = readings[place, day, kind]
        out.setdefault(place, []).append((day, kind, sum(values), max(values)))
    return out


def weighted(x, i, a):
    """The average in closed form: every earlier value with its weight, the first with what is left."""
    return (1 - a) ** i * x[0] + sum(a * (1 - a) ** (i - j) * x[j] for j in range(1, i + 1))


@pytest.mark.parametrize("overlap", ["historical", "both"])
def test_feature_table_equals_closed_forms(world, overlap):
    hourly, forecast, daily = world
    flow = {(r.location, r.date): r.river_discharge_m3s for r in daily.collect()}
    rows = {(r.location, r.date, r.data_type): r for r in features.build_features(*world, ["Klang", "Petaling"], overlap, None).collect()}
    seen = 0
    for place, days in day_totals(hourly, forecast, overlap).items():
        x = [d[2] for d in days]
        total = [0.0]
        for v in x:
            total.append(total[-1] + v)
        for i, (day, kind, amount, most) in enumerate(days):
            got = rows[place, day, kind]
            seen += 1
            assert (got.rain_sum_mm, got.rain_max_1h) == pytest.approx((amount, most))
            for k in (1, 2, 3, 7):
                assert got[f"rain_sum_lag_{k}"] == (pytest.approx(x[i - k]) if i >= k else None)
            for n in (3, 7, 14):
                assert got[f"rain_sum_roll{n}"] == pytest.approx(total[i + 1] - total[max(0, i + 1 - n)])
            for name, a in (("rain_ema_3", 1 / 2), ("rain_ema_7", 1 / 4), ("rain_api_7d", 1 / 5)):
                assert got[name] == pytest.approx(weighted(x, i, a))
            assert got.rain_delta_1d == pytest.approx(x[i] - x[i - 1] if i else 0.0)
            known = flow.get((place, day))
            assert got.river_discharge_m3s == known
            assert got.runoff_ratio_7d == (None if known is None else pytest.approx(known / (total[i + 1] - total[max(0, i - 6)] + 1e-6)))
    assert seen == len(rows)


def test_feature_order_is_the_contract(world):
    table = features.build_features(*world, ["Klang", "Petaling"], scale=None)
    # The nineteen features in their stored order.
    assert features.feature_names(["Klang", "Petaling"], leaky=True) == [
        "rain_sum_mm", "rain_max_1h", "rain_sum_lag_1", "rain_sum_lag_2", "rain_sum_lag_3", "rain_sum_lag_7",
        "rain_sum_roll3", "rain_sum_roll7", "rain_sum_roll14", "rain_ema_3", "rain_ema_7", "rain_delta_1d",
        "rain_api_7d", "loc_Klang", "loc_Petaling", "month", "is_monsoon", "heavy_rain", "runoff_ratio_7d"]
    assert table.columns[:3] == ["location", "date", "data_type"] and len(table.columns) == 23


def test_scaling_modes(world):
    scaled = features.build_features(*world, ["Klang", "Petaling"], scale="all")
    got = scaled.agg(F.avg("rain_sum_mm"), F.stddev_pop("rain_sum_mm"), F.max("river_discharge_m3s")).first()
    assert got[0] == pytest.approx(0, abs=1e-9) and got[1] == pytest.approx(1) and got[2] > 40
    past = features.build_features(*world, ["Klang", "Petaling"], scale="historical").filter("data_type = 'historical'")
    assert past.agg(F.avg("rain_sum_mm")).first()[0] == pytest.approx(0, abs=1e-9)


def test_training_and_scoring_share_features(world):
    names = features.feature_names(["Klang", "Petaling"])
    table = features.build_features(*world, ["Klang", "Petaling"], scale=None)
    made = make_training_set(table, names, n=14)
    assert {r.n_sequences for r in made.counts.collect()} == {40 - 7 - 14}

    def model():
        return lambda x: x[:, -1, 0]

    scored = scoring.score_forecast(table.dropna(subset=names), names, made.scaler, model)
    # 58 days less 7 for the longest lag less 14 for the sequence, in both places.
    assert scored.count() == 2 * (58 - 7 - 14)
    assert scored.select("predicted_discharge").distinct().count() > 10


def test_extremes(spark, rows):
    days = [("a", dt.date(2024, 1, i), float(i), float(i if i < 10 else 1)) for i in range(1, 12)]
    df = spark.createDataFrame(days, "location string, date date, rain_sum_mm double, river_discharge_m3s double")
    rain, flow = df.drop("river_discharge_m3s"), df.drop("rain_sum_mm").filter("date <> date'2024-01-09'")
    sep = extremes.concurrent_extremes(rain, flow, 0.5)
    # The rain limit, 6, is the median of all eleven days, one of which the join loses.
    assert rows(extremes.concurrent_events(sep), "rain_sum_mm") == [(6.0,), (7.0,), (8.0,)]
    joined = extremes.concurrent_extremes(rain, flow, 0.5, thresholds="joined")
    assert joined.agg(F.sum("extreme_rain")).first()[0] == 5
    summary = dict(rows(extremes.extreme_summary(sep)))
    assert summary["Total Records"] == 10 and summary["Concurrent Extreme Days"] == 3
    assert ("a", "Concurrent Both", 3) in rows(extremes.extremes_by_key(sep, named=True))


def test_profile(spark, rows):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 0.0), ("b", dt.date(2024, 2, 1), 2.0), ("b", dt.date(2024, 2, 2), None)],
                               "location string, date date, rain_sum_mm double")
    report = profile.profile(df, "date", rain="rain_sum_mm", bins=2)
    assert {"overview", "describe_by_key", "corr", "box_rain_sum_mm", "histogram_rain_sum_mm", "rain_share"} <= set(report)
    assert [r["column"] for r in report["nulls"].collect()][0] == "rain_sum_mm"
    assert rows(report["rain_days"]) == [("No Rain", "a", 1), ("No Rain", "b", 1), ("Rain", "b", 1)]


def test_profile_computes_its_table_once(spark):
    """However many of its tables are used: the joins and roll-ups behind a daily table are not run for each."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("ab"[i % 2], dt.date(2024, 1, 1 + i // 2), float(i % 5)) for i in range(40)], "location string, date date, rain_sum_mm double")
    report = profile.profile(df.mapInArrow(count, df.schema), "date", rain="rain_sum_mm", bins=2)
    assert {r.n for r in report["describe_by_key"].collect()} == {20}
    assert {(r.rain_label, r.n) for r in report["rain_share"].collect()} == {("No Rain", 8), ("Rain", 32)}
    assert {r.n_null for r in report["nulls"].collect()} == {0} and read.value == 40


def test_dashboard_filters_compose(world, rows):
    hourly, forecast, daily = world
    view = dashboard.View(location="Klang", start="2024-02-01", end="2024-02-20")
    overlay = dashboard.hourly_overlay(hourly, daily, view)
    assert {r.location for r in overlay.collect()} == {"Klang"} and overlay.count() == 4 * 9
    recent = dashboard.in_view(daily, dashboard.View(months=1, floor="2024-02-01", location="Petaling"))
    assert recent.agg(F.min("date"), F.count("*")).first()[:] == (dt.date(2024, 2, 1), 9)
    scored = forecast.select("location", F.to_date("datetime").alias("date"), F.lit("LOW").alias("flood_risk"))
    view = dashboard.dashboard_slice(daily, hourly, daily, scored, view)
    assert rows(view["risk"], "n_days", "n_low", "n_high") == [(52, 52, 0)]


def test_whole_run(spark, world, tmp_path):
    hourly, forecast, daily = world
    text = {"datetime": F.col("datetime").cast("string")}
    for df, name in ((hourly.withColumns(text), "w"), (forecast.withColumns(text), "p")):
        df.select("datetime", "rain", "location").coalesce(1).write.option("header", True).csv(str(tmp_path / name))
    daily.selectExpr("cast(date AS string) AS date", "river_discharge_m3s", "location").coalesce(1).write.option(
        "header", True).csv(str(tmp_path / "f"))

    def model():
        return lambda x: x[:, -1, 0]

    out = str(tmp_path / "out")
    run(spark, RunConfig(str(tmp_path / "w"), str(tmp_path / "f"), out, str(tmp_path / "p")), model)
    meta = spark.read.json(f"{out}/training_metadata").first()
    assert (meta.rows_used, meta.total_sequences, meta.feature_count) == (66, 38, 18)
    assert tables.read_feature_list(spark, f"{out}/feature_columns")[0] == "rain_sum_mm"
    scored = spark.read.parquet(f"{out}/flood_forecast")
    assert scored.count() == 2 * 18 and {"predicted_discharge", "flood_risk"} <= set(scored.columns)
    assert spark.read.parquet(f"{out}/combined").count() == hourly.count()


# -- plans ------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_window_runs_in_one_partition(spark, world):
    table = features.build_features(*world, ["Klang", "Petaling"], scale=None)
    flow = features.discharge_features(world[2])
    for df in (table, flow):
        lines = plan_of(df).split("\n")
        for i, line in enumerate(lines):
            if re.search(r"\bWindow \[", line):
                assert not any("SinglePartition" in below for below in lines[i : i + 3]), line


def test_feature_table_shuffles_once_on_the_key(world):
    plan = plan_of(features.build_features(*world, ["Klang", "Petaling"], scale=None))
    assert len(re.findall(r"Exchange hashpartitioning\(location#\d+, \d+\)", plan)) == 1
    assert plan.count("BatchEvalPython") == 0 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_last_n_is_limited_before_the_shuffle(world):
    from riverframe.operators.windows import last_n

    assert plan_of(last_n(world[0], ["location"], "datetime", 3)).count("WindowGroupLimit") == 2


def test_date_filter_reaches_the_scan(spark, world, tmp_path):
    from riverframe.operators.select import between_dates, in_year

    world[0].write.parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    for df in (between_dates(stored, "datetime", "2024-01-02", "2024-01-03"), in_year(stored, "datetime", 2024)):
        assert "GreaterThanOrEqual(datetime" in plan_of(df.select("rain"))


def test_scaling_reads_a_stored_table(world):
    plan = plan_of(features.build_features(*world, ["Klang", "Petaling"], scale="all"))
    assert "Window" not in plan and plan.count("FileScan parquet") <= 2
