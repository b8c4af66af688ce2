"""Quantiles, profiles and joins of statistics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverframe.operators import quantiles as Q
from riverframe.operators import scaling, select, stats
from riverframe.operators.joins import join_with_suffix, spread_daily, union_all, with_global_stats
from riverframe.operators.resample import month_means, pivot_first, resample, to_long


def test_quantile_hand_values(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 10)] + [(None,), (float("nan"),)], "x double")
    for method in ("exact", "plain"):
        assert Q.quantiles(df, {"x": 0.95}, method=method).first()[0] == pytest.approx(8.8)


@pytest.mark.parametrize("seed", range(3))
def test_binned_quantiles_are_exact(spark, monkeypatch, seed):
    """Force the binned path: hot value, heavy tail, several groups and wanted ranks."""
    monkeypatch.setattr(Q, "SMALL_GROUP", 100)
    monkeypatch.setattr(Q, "BINS", 64)
    rng = np.random.default_rng(seed)
    n = 20_000
    x = np.where(rng.random(n) < 0.33, 5.0, np.round(rng.lognormal(1, 2, n), 3))
    key = np.where(rng.random(n) < 0.9, "hot", "cold")
    df = spark.createDataFrame([(str(k), float(v)) for k, v in zip(key, x)], "k string, x double")
    ps = [0.99, 0.5, 0.05, 0.951]
    got = {r["k"]: r["q"] for r in Q.quantiles_long(df, ["x"], ps, ["k"]).collect()}
    for k in ("hot", "cold"):
        np.testing.assert_allclose(got[k], np.quantile(x[key == k], ps), rtol=1e-12)
    whole = Q.quantiles_long(df, ["x"], ps).first()["q"]
    np.testing.assert_allclose(whole, np.quantile(x, ps), rtol=1e-12)


def skewed(spark, seed, n=20_000):
    """A third of the values is one number; infinities, missing values, a group without a name and one without values."""
    rng = np.random.default_rng(seed)
    x = np.where(rng.random(n) < 0.33, 5.0, np.round(rng.lognormal(1, 2, n), 3))
    x[:5], x[5:9] = np.inf, -np.inf
    key = rng.choice(["hot", "cold", None], n, p=[0.8, 0.15, 0.05])
    rows = [(k, float(v), float(i)) for i, (k, v) in enumerate(zip(key, x))] + [("none", None, None), ("hot", float("nan"), None)]
    return spark.createDataFrame(rows, "k string, x double, y double").repartition(7), x, key


def quantiles_of(x, ps):
    """Linear interpolation, without the difference of two infinities."""
    x, out = np.sort(x), []
    for p in ps:
        r = p * (len(x) - 1)
        a, b = x[int(np.floor(r))], x[int(np.ceil(r))]
        out.append(a if a == b else (np.ceil(r) - r) * a + (r - np.floor(r)) * b)
    return out


@pytest.mark.parametrize("method", ["exact", "binned"])
@pytest.mark.parametrize("gathered", [100_000, 150])
def test_quantiles_by_sketches_are_exact(spark, monkeypatch, gathered, method):
    """Also where what lies between the ends is sketched again and again."""
    monkeypatch.setattr(Q, "SMALL_GROUP", 100)
    monkeypatch.setattr(Q, "GATHERED", gathered)
    monkeypatch.setattr(Q, "SKETCH", 200)
    monkeypatch.setattr(Q, "REACH", 0.05)
    monkeypatch.setattr(Q, "SPREAD", 0.1)
    df, x, key = skewed(spark, 1)
    ps = [0.99, 0.5, 0.05, 0.951, 0.0, 1.0, 0.3, 0.4]
    got = {(r["k"], r["metric"]): r["q"] for r in Q.quantiles_long(df, ["x", "y"], ps, ["k"], method).collect()}
    assert set(got) == {(k, m) for k in ("hot", "cold", None) for m in "xy"}
    for k in ("hot", "cold", None):
        mine = np.array([v is None if k is None else v == k for v in key])
        np.testing.assert_allclose(got[k, "x"], quantiles_of(x[mine], ps), rtol=1e-12)
        np.testing.assert_allclose(got[k, "y"], np.quantile(np.flatnonzero(mine), ps), rtol=1e-12)
    whole = {r["metric"]: r["q"] for r in Q.quantiles_long(df, ["x", "y"], ps, method=method).collect()}
    np.testing.assert_allclose(whole["x"], quantiles_of(x, ps), rtol=1e-12)
    np.testing.assert_allclose(whole["y"], np.quantile(np.arange(len(x)), ps), rtol=1e-12)


def test_narrowing_counts_values_where_they_are_read(spark, monkeypatch):
    """Brackets that are narrowed do not bring all values of a column together: no join, and no values are shuffled."""
    monkeypatch.setattr(Q, "SMALL_GROUP", 100)
    monkeypatch.setattr(Q, "GATHERED", 10)
    plans, narrowed = [], Q._narrowed

    def watched(*args):
        out = narrowed(*args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(Q, "_narrowed", watched)
    df, x, _ = skewed(spark, 4)
    found = Q.quantiles_long(df, ["x", "y"], [0.25, 0.5]).collect()
    np.testing.assert_allclose({r["metric"]: r["q"] for r in found}["x"], quantiles_of(x, [0.25, 0.5]), rtol=1e-12)
    assert plans and not [p for p in plans if "Join" in p]


def test_a_wrong_sketch_is_found_out(spark, monkeypatch):
    """Brackets that do not reach the rank: the counts show it and the bins answer."""
    monkeypatch.setattr(Q, "SMALL_GROUP", 100)
    monkeypatch.setattr(Q, "REACH", -0.05)
    monkeypatch.setattr(Q, "SPREAD", 0.0)
    asked = []
    binned = Q._binned
    monkeypatch.setattr(Q, "_binned", lambda *a: (asked.append(1), binned(*a))[1])
    df, x, _ = skewed(spark, 2)
    np.testing.assert_allclose(Q.quantiles_long(df, ["x"], [0.6, 0.9]).first()["q"], np.quantile(x, [0.6, 0.9]), rtol=1e-12)
    assert asked == [1]


def test_quantiles_read_their_input_twice(spark, monkeypatch):
    monkeypatch.setattr(Q, "SMALL_GROUP", 100)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df, x, _ = skewed(spark, 3)
    counted = df.mapInArrow(count, df.schema)
    found = Q.quantiles_long(counted, ["x", "y"], [0.25, 0.5, 0.75], ["k"]).collect()
    assert len(found) == 6 and read.value == 2 * df.count()


def test_a_wrong_bracket_raises(spark):
    df = spark.range(1).select(F.lit(3.0).alias("v"))
    assert df.select(Q._check(F.col("v"), F.lit(1.0), F.lit(3.0))).first()[0] == 3.0
    with pytest.raises(Exception, match="outside its bins"):
        df.select(Q._check(F.col("v"), F.lit(4.0), F.lit(5.0))).collect()


def test_collapse_keeps_order_and_marks_gaps(spark):
    df = spark.createDataFrame([(float(v),) for v in range(10)], "v double")
    edges = [F.lit(float(e)) for e in (2, 3, 6, 7)]
    got = [r[0] for r in df.select(Q._collapse(F.col("v"), edges)).collect()]
    low, high = float("-inf"), float("inf")
    assert got == [low, low, 2.0, 3.0, 4.5, 4.5, 6.0, 7.0, high, high]


def test_describe_and_box(spark, rows):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", None)], "k string, x double")
    got = stats.describe(df, ["x"], ["k"]).filter("k = 'a'").first()
    assert (got.n, got["mean"], got["min"], got.p25, got.p50, got.p75, got["max"]) == (5, 22.0, 1, 2, 3, 4, 100)
    assert rows(stats.describe(df, ["x"], ["k"]).filter("k = 'b'"), "n", "p50") == [(0, None)]
    assert rows(stats.box_stats(df, "x", ["k"])) == [("a", 2.0, 3.0, 4.0, 1.0, 4.0, 1)]


def test_histogram(spark, rows):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 4, 10)], "x double")
    assert rows(stats.histogram(df, "x", 5), "bin", "lo", "hi", "n") == [
        (1, 0.0, 2.0, 3), (2, 2.0, 4.0, 0), (3, 4.0, 6.0, 1), (4, 6.0, 8.0, 0), (5, 8.0, 10.0, 1)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert sum(r["n"] for r in stats.histogram(flat, "x", 4).collect()) == 2


def test_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 8.5, 5.0)], "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "a"] == pytest.approx(1) and got["a", "c"] is None
    want = np.corrcoef([1, 2, 4], [2, 4, 8.5])[0, 1]
    assert got["a", "b"] == got["b", "a"] == pytest.approx(want)
    assert stats.corr_pair(df, "a", "b").first()[0] == round(want, 3)


def test_counts(spark, rows):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 0, None), ("b", 1, 0.0), (None, 1, 5.0)], "k string, f int, x double")
    assert rows(stats.null_report(df)) == [("f", 0, 0.0), ("k", 1, 25.0), ("x", 1, 25.0)]
    assert rows(stats.value_share(df, "k")) == [("a", 2, 66.67), ("b", 1, 33.33)]
    assert rows(stats.flag_sums(df, ["f"], ["k"])) == [("a", 1), ("b", 1), (None, 1)]
    assert stats.n_distinct(df, "k").first()[0] == 2
    assert rows(stats.distinct_values(df, "k")) == [("a",), ("b",)]
    assert rows(stats.count_where(df, {"wet": F.col("x") > 0})) == [(2,)]
    assert rows(stats.class_weights(df, "f")) == [(0, 1, 2.0), (1, 3, pytest.approx(2 / 3))]
    assert stats.label_ratio(df, "f").first()[0] == 0.75
    assert stats.min_usable_length(df.dropna(subset=["k"]), ["k"], "x").first()[0] == 1
    assert rows(stats.summary_long(df, {"n": F.count("*"), "top": F.max("x")}, 2)) == [("n", 4.0), ("top", 5.0)]
    assert rows(stats.top_k(df, ["x"], 2), "x") == [(2.0,), (5.0,)]
    got = stats.overview(df, "f", ["x"]).first()
    assert (got.n_rows, got.first_ts, got.last_ts, got.max_x) == (4, 0, 1, 5.0)


def test_resample_of_missing_values(spark, rows):
    df = spark.sql("SELECT * FROM VALUES ('a', timestamp_ntz'2024-01-01 01:00:00', CAST(NULL AS DOUBLE)),"
                   " ('a', timestamp_ntz'2024-01-02 01:00:00', 2.0D), ('a', timestamp_ntz'2024-01-02 23:00:00', NULL)"
                   " AS t(location, datetime, rain)")
    aggs = {"s": ("sum", "rain"), "m": ("max", "rain")}
    assert rows(resample(df, ["location"], "datetime", aggs), "s", "m", "n_obs") == [(0.0, None, 1), (2.0, 2.0, 2)]
    kept = resample(df, ["location"], "datetime", aggs, null_sum="null")
    assert rows(kept, "s") == [(2.0,), (None,)]


def test_resample_units(spark, rows):
    df = spark.sql("SELECT 'a' AS k, timestamp_ntz'2024-03-10 02:45:30' AS t, 1.0D AS x")
    starts = {"day": "2024-03-10", "hour": "2024-03-10 02:00:00", "minute": "2024-03-10 02:45:00", "week": "2024-03-04",
              "month": "2024-03-01", "year": "2024-01-01"}
    for unit, start in starts.items():
        got = resample(df, ["k"], "t", {"s": ("sum", "x")}, unit).select(F.col("date").cast("string")).first()[0]
        assert got == start
    with pytest.raises(ValueError):
        resample(df, ["k"], "t", {"s": ("sum", "x")}, "fortnight")


def test_reshape(spark, rows):
    df = spark.createDataFrame([("p", "FMAXT", "30", 2), ("p", "FMAXT", "31", 1), ("p", "FMINT", None, 0), ("p", "FMINT", "22", 3)],
                               "loc string, datatype string, value string, seq int")
    wide = pivot_first(df, ["loc"], "datatype", "value", ["FMAXT", "FMINT", "FSIGW"], "seq")
    assert rows(wide) == [("p", "31", "22", None)]
    long = to_long(spark.createDataFrame([("a", 1.0, None)], "k string, x double, y double"), ["k"], ["x", "y"])
    assert rows(long) == [("a", "x", 1.0), ("a", "y", None)]
    months = month_means(spark.sql("SELECT 'a' AS location, date'2024-02-01' AS d, 4.0D AS x"), "d", ["x"])
    assert rows(months) == [("a", 2, 4.0, "February")]


def test_joins(spark, rows):
    hourly = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 6.0), ("a", 2, 7.0)], "location string, date int, rain double")
    daily = spark.createDataFrame([("a", 1, 9.0, "x"), ("a", 2, None, "y")], "location string, date int, flow double, note string")
    on = ["location", "date"]
    assert rows(spread_daily(hourly, daily, on, "flow", "inner"), "rain", "flow") == [(5.0, 9.0), (6.0, 9.0)]
    assert rows(spread_daily(hourly, daily, on, "flow", "left", 0.0), "rain", "flow") == [(5.0, 9.0), (6.0, 9.0), (7.0, 0.0)]
    clash = join_with_suffix(hourly.withColumn("note", F.lit("h")), daily, on, ("_weather", "_flood"))
    assert set(clash.columns) == {"location", "date", "rain", "flow", "note_weather", "note_flood"}
    both = union_all(hourly, daily.drop("note"))
    assert both.columns == ["location", "date", "rain", "flow"] and both.count() == 5
    with_mean = with_global_stats(hourly, {"m": F.avg("rain"), "n": F.count("*")})
    assert rows(with_mean, "m", "n") == [(6.0, 3)] * 3


def test_scaler(spark, rows, tmp_path):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "a double, b double")
    fitted = scaling.fit_scaler(df, ["a", "b"])
    assert rows(fitted) == [("a", 2.0, 1.0, 1.0, 2), ("b", 7.0, 1.0, 0.0, 3)]
    scaled = scaling.apply_scaler(df, fitted, ["a", "b"])
    assert rows(scaled) == rows(scaling.standardize(df, ["a", "b"])) == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]
    assert rows(scaling.apply_scaler(df, fitted, ["a"], with_mean=False), "a") == [(1.0,), (3.0,), (None,)]
    from riverframe.sources import tables

    tables.save_stats(fitted, str(tmp_path / "s"))
    assert rows(tables.load_stats(spark, str(tmp_path / "s"), ["a", "b"])) == rows(fitted)
    with pytest.raises(ValueError, match="'c'"):
        tables.load_stats(spark, str(tmp_path / "s"), ["a", "c"])


def test_one_hot(spark, rows):
    df = spark.createDataFrame([("Klang",), ("Petaling",), (None,)], "location string")
    assert rows(scaling.one_hot(df, "location")) == [("Klang", 1, 0), ("Petaling", 0, 1), (None, 0, 0)]
    indexed = scaling.category_index(df.dropna(), "location").transform(df.dropna())
    assert [r.location_idx for r in indexed.orderBy("location").collect()] == [0.0, 1.0]


def test_selection(spark, rows):
    df = spark.createDataFrame([(1, 2.0, "z")], "a int, wind_max double, c string")
    assert select.reorder(df, ["c"]).columns == ["c", "a", "wind_max"]
    assert select.features_except(df, ["c"]) == ["a", "wind_max"] == select.numeric_columns(df)
    assert select.columns_matching(df, "wind") == ["wind_max"]
    kept, dropped = select.select_existing(df, ["c", "nope", "a"])
    assert kept.columns == ["c", "a"] and dropped == ["nope"]
    assert rows(select.align_columns(df, ["b", "a"], "zero", keep=["c"])) == [("z", 0.0, 1)]
    assert rows(select.align_columns(df, ["b", "a"], "null")) == [(None, 1)]
    with pytest.raises(ValueError, match="'b'"):
        select.align_columns(df, ["b"])
    with pytest.raises(ValueError):
        select.require_rows(df.limit(0))
    assert select.rename(df, {"a": "value"}).columns[0] == "value"


def test_cleaning_and_date_filters(spark, rows):
    df = spark.createDataFrame(
        [(" Klang ", "2024-01-31 23:59:59", 1.0), ("Klang", "not a date", 2.0), (None, "2024-01-01", 3.0),
         ("Klang", "2024-02-01", float("nan")), ("Klang", "2023-12-31", 5.0)],
        "location string, datetime string, rain double")
    clean = select.floats_nan_to_null(select.normalize_keys(df, "datetime"))
    assert rows(clean, "location", "rain") == [("Klang", 1.0), ("Klang", 5.0), ("Klang", None)]
    assert rows(select.rejected_rows(df, "datetime")) == [(5, 1, 1)]
    assert rows(select.between_dates(clean, "datetime", "2024-01-01", "2024-01-31"), "rain") == [(1.0,)]
    assert rows(select.in_year(clean, "datetime", 2024), "rain") == [(1.0,), (None,)]
    assert rows(select.as_of(clean, "datetime", "2023-12-31"), "rain") == [(5.0,)]
    days = clean.withColumn("date", F.to_date("datetime"))
    assert rows(select.last_period(days, "date", 1), "rain") == [(1.0,), (None,)]
    assert rows(select.last_period(days, "date", 24, floor="2024-02-01"), "rain") == [(None,)]
    assert rows(select.fill_null(days, {"rain": 0.0}), "rain") == [(0.0,), (1.0,), (5.0,)]


def test_an_outlier_does_not_widen_the_brackets(spark):
    """Whatever the values are, few different ones are left for the reducer that interpolates."""
    from riverframe.operators import quantiles as Qn

    group = F.struct(F.lit("x").alias("metric")).alias(Qn.GROUP)
    value = F.when(F.col("id") == 7, F.lit(9.96e36)).when(F.col("id") % 1000 == 1, -F.col("id").cast("double")).otherwise(F.col("id") * 1e-3)
    long = spark.range(300_000).select(group, value.alias("value"))
    big = spark.range(1).select(group, F.lit(300_000).cast("bigint").alias("n"))
    found = Qn.brackets(long, big, [0.0, 0.5, 0.95, 1.0]).collect()
    assert len(found) == 4 and all(r["inside"] <= Qn.SMALL_GROUP and r["lo"] <= r["hi"] for r in found)
    q = Qn.quantiles_long(long.select("value"), ["value"], [0.0, 0.5, 0.95, 1.0]).first()["q"]
    plain = long.agg(F.percentile("value", F.array(*[F.lit(p) for p in (0.0, 0.5, 0.95, 1.0)]))).first()[0]
    assert q == plain
