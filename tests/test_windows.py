"""Window operators: hand values, and the chunked forms against the ordinary ones."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riverframe.operators import windows as W
from riverframe.operators.ema import ema, emas
from riverframe.operators.ordered import add_rows, cells, positions, use_chunks

K = ["location"]


def values(df, c, key="a"):
    return [r[0] for r in df.filter(F.col("location") == key).orderBy("date").select(c).collect()]


def test_lag_and_delta(series):
    df = series({"a": [1, None, 4], "b": [7]})
    out = W.lags(df, K, "date", "x", (1, 2), "lag")
    assert values(out, "lag1") == [None, 1, None] and values(out, "lag2") == [None, None, 1]
    assert values(out, "lag1", "b") == [None]
    out = add_rows(series({"a": [1, 3, 2]}), K, "date", {"d": W.delta_of("x"), "d0": W.delta_of("x", 0.0)})
    assert values(out, "d") == [None, 2, -1] and values(out, "d0") == [0, 2, -1]


def test_rolling_minimum_periods(series):
    df = series({"a": [1, None, 4, 5, 6]})
    assert values(W.rolling(df, K, "date", "x", 3, "sum", 1, out="r"), "r") == [1, 1, 5, 9, 15]
    assert values(W.rolling(df, K, "date", "x", 3, "mean", out="r"), "r") == [None, None, None, None, 5]


def test_rolling_calendar(spark):
    df = spark.sql("SELECT 'a' AS location, d AS date, x FROM VALUES (date'2024-01-01', 1.0D), (date'2024-01-02', 2.0D),"
                   " (date'2024-01-09', 3.0D) AS t(d, x)")
    assert values(W.rolling(df, K, "date", "x", 3, "sum", 1, calendar=True, out="r"), "r") == [1, 3, 3]
    assert values(W.rolling(df, K, "date", "x", 3, "sum", 1, out="r"), "r") == [1, 3, 6]
    with pytest.raises(ValueError):
        W.rolling(df.withColumn("date", F.col("date").cast("timestamp")), K, "date", "x", 3, calendar=True)


def test_pct_change_and_anomaly(series):
    df = series({"a": [2, 3, 0, 5]})
    assert values(W.pct_change(df, K, "date", "x", out="p"), "p") == [None, 0.5, -1.0, None]
    padded = W.pct_change(series({"a": [2, None, 3]}), K, "date", "x", pad=True, out="p")
    assert values(padded, "p") == [None, 0.0, 0.5]
    assert values(W.anomaly(series({"a": [1, 2, 6]}), K, "date", "x", 3, out="z"), "z") == [None, None, 3]


@pytest.mark.parametrize("chunk", [None, 100])
@pytest.mark.parametrize(
    "direction, want",
    [("ffill", [None, 1, 1, 1, 5, 5]), ("bfill", [1, 1, 5, 5, 5, None]), ("both", [1, 1, 1, 1, 5, 5])],
)
def test_fill(series, direction, want, chunk):
    df = series({"a": [None, 1, None, None, 5, None], "b": [None, None]})
    # One bucket per day, so that every value crosses buckets.
    out = W.fill_gaps(df, K, "date", ["x"], direction, chunk=chunk, width=86_400)
    assert values(out, "x") == want
    assert values(out, "x", "b") == [None, None]


def test_ema_hand_values(series):
    df = series({"a": [1, 2, 4], "b": [3]})
    assert values(ema(df, K, "date", "x", span=3, out="e"), "e") == [1, 1.5, 2.75]
    assert values(ema(df, K, "date", "x", span=3, out="e"), "e", "b") == [3]
    assert values(ema(df, K, "date", "x", alpha=1.0, out="e"), "e") == [1, 2, 4]


def test_ema_rejects_missing_values_and_bad_parameters(series):
    with pytest.raises(Exception, match="missing values"):
        ema(series({"a": [1, None]}), K, "date", "x", span=3, missing="error").collect()
    with pytest.raises(ValueError):
        ema(series({"a": [1]}), K, "date", "x")
    with pytest.raises(ValueError):
        ema(series({"a": [1]}), K, "date", "x", alpha=1.5)


@pytest.fixture(scope="module")
def noisy(spark):
    """Irregular readings, one key with most of the rows, shuffled."""
    rng = random.Random(7)
    data, t0 = [], dt.datetime(2024, 1, 1)
    for key, n in (("hot", 900), ("cold", 40), ("one", 1)):
        t = t0
        for i in range(n):
            t += dt.timedelta(seconds=rng.choice([1, 30, 600, 9000]))
            data.append((key, t, rng.uniform(-5, 50), i))
    rng.shuffle(data)
    return spark.createDataFrame(data, "location string, datetime timestamp_ntz, x double, id int").repartition(7)


def frame(df, *cols):
    return df.select("location", "id", *cols).toPandas().sort_values(["location", "id"]).reset_index(drop=True)


def test_positions(noisy):
    got = frame(positions(noisy, K, "datetime", "p", total="n", chunk=1), "p", "n")
    assert (got.p == got.id + 1).all()
    assert got.groupby("location").n.first().to_dict() == {"hot": 900, "cold": 40, "one": 1}


def test_hot_buckets_are_cut(noisy):
    """One bucket holds everything; it has to fall into pieces and give the same positions."""
    tagged, counts = cells(noisy, K, "datetime", width=10_000_000, hot_rows=50)
    assert counts.agg(F.max("__rows")).first()[0] < 200 and counts.count() > 10
    assert tagged.count() == noisy.count()
    got = frame(positions(noisy, K, "datetime", "p", width=10_000_000, hot_rows=50, chunk=1), "p")
    assert (got.p == got.id + 1).all()
    gappy = noisy.withColumn("x", F.when(F.col("id") % 7 == 3, F.col("x")))
    for direction in ("ffill", "bfill", "both"):
        plain = frame(W.fill_gaps(gappy, K, "datetime", ["x"], direction, chunk=0), "x")
        cut = frame(W.fill_gaps(gappy, K, "datetime", ["x"], direction, chunk=1, width=10_000_000, hot_rows=50), "x")
        pd.testing.assert_frame_equal(plain, cut)


@pytest.mark.parametrize("chunk", [1, 14, 64, 5000])
def test_chunked_windows_equal_plain_ones(noisy, chunk):
    exprs = {"l7": W.lag_of("x", 7), "m5": W.rolling_of("x", 5, "mean"), "s3": W.rolling_of("x", 3, "sum", 1),
             "d": W.delta_of("x"), "a": W.anomaly_of("x", 4)}
    plain = frame(add_rows(noisy, K, "datetime", exprs, chunk=0), *exprs)
    cut = frame(add_rows(noisy, K, "datetime", exprs, chunk=chunk), *exprs)
    pd.testing.assert_frame_equal(plain, cut, rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("block", [None, 1, 5, 64])
@pytest.mark.parametrize("chunk", [0, 1])
def test_ema_equals_pandas(noisy, block, chunk):
    alphas = {"e3": 0.5, "api": 0.2, "slow": 0.01}
    got = frame(emas(noisy, K, "datetime", "x", alphas, chunk=chunk, block=block), "x", *alphas)
    for name, a in alphas.items():
        want = got.groupby("location").x.transform(lambda s: s.ewm(alpha=a, adjust=False).mean())
        pd.testing.assert_series_equal(got[name], want, check_names=False, rtol=1e-9, atol=1e-9)


@pytest.fixture(scope="module")
def gappy(noisy):
    """Missing at the start, in runs longer than a block, singly, and one key without any value."""
    known = (F.col("id") >= 5) & (F.col("id") % 3 != 1) & ~F.col("id").between(200, 430) & (F.col("location") != "one")
    return noisy.withColumn("x", F.when(known, F.col("x")).when(F.col("id") % 2 == 0, F.lit(float("nan"))))


@pytest.mark.parametrize("block", [None, 1, 5, 64])
@pytest.mark.parametrize("chunk", [0, 1])
def test_ema_over_missing_values_equals_pandas(gappy, block, chunk):
    alphas = {"e3": 0.5, "api": 0.2, "slow": 0.01, "steep": 0.97, "last": 1.0}
    got = frame(emas(gappy, K, "datetime", "x", alphas, chunk=chunk, block=block), "x", *alphas)
    assert got.e3.isna().sum() == 11 and got.x.isna().sum() > 300
    for name, a in alphas.items():
        want = got.groupby("location").x.transform(lambda s: s.ewm(alpha=a, adjust=False).mean())
        pd.testing.assert_series_equal(got[name], want, check_names=False, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("chunk", [0, 1])
def test_complete_columns_have_the_same_averages_on_both_ways(noisy, chunk):
    alphas = {"e3": 0.5, "slow": 0.01}
    over_gaps, dense = (frame(emas(noisy, K, "datetime", "x", alphas, chunk=chunk, block=16, missing=m), *alphas) for m in ("skip", "error"))
    pd.testing.assert_frame_equal(over_gaps, dense, rtol=1e-9, atol=1e-9)


def test_a_gap_of_any_length_and_a_spike_before_it(spark):
    """What a spike of 1e25 leaves after 60 missing rows counts; after 20 000 nothing is left and nothing overflows."""
    for gap, chunk in ((60, 0), (60, 1), (20_000, 0), (20_000, 1)):
        df = spark.range(gap + 4).selectExpr("'a' AS location", "timestampadd(MINUTE, id, timestamp_ntz'2024-01-01') AS datetime", f"CASE WHEN id = 1 THEN 1e25 WHEN id <= 1 OR id > {gap} THEN 1.0 END AS x", "int(id) AS id")
        got = frame(emas(df, K, "datetime", "x", {"e": 0.5}, chunk=chunk), "x", "e")
        pd.testing.assert_series_equal(got.e, got.x.ewm(alpha=0.5, adjust=False).mean(), check_names=False, rtol=1e-9)


def test_missing_values_fail_where_they_must_not_be(gappy):
    with pytest.raises(Exception, match="missing values"):
        emas(gappy, K, "datetime", "x", {"e": 0.5}, missing="error").agg(F.sum("e")).collect()
    with pytest.raises(ValueError, match="skip or error"):
        emas(gappy, K, "datetime", "x", {"e": 0.5}, missing="drop")


@pytest.mark.parametrize("missing", ["skip", "error"])
def test_ema_lists_no_more_blocks_than_a_double_holds(noisy, missing):
    """A row does not carry the ends of all blocks before it: their number grows with the series, and the work with its square."""
    plan = emas(noisy, K, "datetime", "x", {"e": 0.4, "slow": 0.01}, chunk=0, missing=missing)._jdf.queryExecution().optimizedPlan().toString()
    lists = [part.split(" AS ")[0] for part in plan.split("collect_list(")[1:]]
    assert len(lists) >= 2 and not [part for part in lists if "unboundedpreceding" in part]


def test_ema_follows_values_over_empty_and_sparse_blocks(spark, rows):
    """One value in every few blocks, then none for many: as far back as the slow average reaches."""
    values = [float(i % 7) if i % 9 == 4 and not 300 < i < 700 or i > 900 else None for i in range(1000)]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "location string, i int, x double").selectExpr("location", "date_add(date'2020-01-01', i) AS date", "x")
    want = pd.Series(values).ewm(alpha=0.05, adjust=False).mean()
    for chunk in (0, 64):
        got = [r[0] for r in emas(df, K, "date", "x", {"e": 0.05}, chunk=chunk, block=4).orderBy("date").select("e").collect()]
        np.testing.assert_allclose(np.array(got, dtype=float), want.to_numpy(), rtol=1e-9)


def test_ema_equals_grouped_python(noisy):
    def fold(pdf):
        pdf = pdf.sort_values("datetime")
        y, out = None, []
        for x in pdf.x:
            y = x if y is None else 0.75 * y + 0.25 * x
            out.append(y)
        return pdf.assign(e=out)[["location", "id", "e"]]

    twin = noisy.groupBy("location").applyInPandas(fold, "location string, id int, e double")
    pd.testing.assert_frame_equal(
        frame(emas(noisy, K, "datetime", "x", {"e": 0.25}), "e"), frame(twin, "e"), rtol=1e-9, atol=1e-9
    )


def test_result_does_not_depend_on_partitioning(noisy):
    exprs = {"l": W.lag_of("x", 3), "s": W.rolling_of("x", 9, "sum", 1)}
    a = frame(add_rows(noisy.coalesce(1), K, "datetime", exprs, chunk=32), *exprs)
    b = frame(add_rows(noisy.repartition(13, "id"), K, "datetime", exprs, chunk=32), *exprs)
    pd.testing.assert_frame_equal(a, b)


def test_large_keys_are_chunked_on_their_own(noisy):
    assert use_chunks(noisy, K, "datetime", None) == 0
    assert use_chunks(noisy, K, "datetime", None, hot_rows=500) > 0
    exprs = {"m5": W.rolling_of("x", 5, "mean")}
    plain = frame(add_rows(noisy, K, "datetime", exprs), "m5")
    pd.testing.assert_frame_equal(plain, frame(add_rows(noisy, K, "datetime", exprs, hot_rows=500), "m5"), rtol=1e-12)


@pytest.fixture(scope="module")
def keyless(spark):
    """Rows of which a third have no key, several a day, under a DATE."""
    rng = random.Random(4)
    data = [(None if i % 3 == 0 else "ab"[i % 2], dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(20)), rng.uniform(0, 9) if i % 4 else None, i) for i in range(600)]
    return spark.createDataFrame(data, "location string, date date, x double, id int").repartition(5)


def by_id(df, *cols):
    return {r["id"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("chunk", [1, 37, 5000])
def test_rows_without_a_key_are_one_series_on_both_ways(keyless, chunk):
    how = {"tiebreak": ["id"]}
    exprs = {"l": W.lag_of("x", 2), "s": W.rolling_of("x", 5, "sum", 1)}
    plain, cut = (by_id(add_rows(keyless, K, "date", exprs, chunk=c, **how), *exprs) for c in (0, chunk))
    assert {k: pytest.approx(v) for k, v in plain.items()} == cut
    plain, cut = (by_id(positions(keyless, K, "date", "p", "n", chunk=c, **how), "p", "n") for c in (0, chunk))
    assert plain == cut and max(v[0] for v in plain.values()) == 200
    for direction in ("ffill", "bfill", "both"):
        plain, cut = (by_id(W.fill_gaps(keyless, K, "date", ["x"], direction, chunk=c, **how), "x") for c in (0, chunk))
        assert plain == cut
    full = keyless.fillna(0.5, ["x"])
    plain, cut = (by_id(emas(full, K, "date", "x", {"e": 0.3}, block=7, chunk=c, **how), "e") for c in (0, chunk))
    assert {k: pytest.approx(v) for k, v in plain.items()} == cut


def test_a_date_column_is_counted_like_any_other(keyless):
    assert use_chunks(keyless, K, "date", None, hot_rows=100) > 0 and use_chunks(keyless, K, "date", None) == 0


def test_average_keeps_what_a_huge_value_leaves(spark):
    """After a spike of 1e25 even a part in 1e-20 of it is far above the other values."""
    df = spark.range(400).selectExpr("'a' AS location", "date_add(date'2024-01-01', int(id)) AS date", "CASE WHEN id = 3 THEN 1e25 ELSE 1.0 END AS x", "int(id) AS id")
    want, y = [], None
    for x in [1.0, 1.0, 1.0, 1e25] + [1.0] * 396:
        y = x if y is None else 0.75 * y + 0.25 * x
        want.append(y)
    for chunk in (0, 64):
        got = by_id(emas(df, K, "date", "x", {"e": 0.25}, block=16, chunk=chunk), "e")
        assert [got[i][0] for i in range(400)] == pytest.approx(want, rel=1e-9)


def test_ends_of_series(series, rows):
    df = series({"a": [1, 2, 3, 4], "b": [5]})
    assert rows(W.last_n(df, K, "date", 2), "location", "x") == [("a", 3.0), ("a", 4.0), ("b", 5.0)]
    assert rows(W.skip_n(df, K, "date", 2), "location", "x") == [("a", 3.0), ("a", 4.0)]
    assert rows(W.skip_n(df, K, "date", 1), "location", "x") == [("a", 2.0), ("a", 3.0), ("a", 4.0)]


def test_zscore(series):
    df = series({"a": [1, 2, 3], "b": [10, 10, 10]})
    assert values(W.zscore(df, ["x"], by=K), "x_zscore") == [-1, 0, 1]
    assert values(W.zscore(df, ["x"], by=K), "x_zscore", "b") == [None, None, None]
    pop = values(W.zscore(series({"a": [1, 2, 3, 4, 10]}), ["x"], ddof=0), "x_zscore")
    assert pop[-1] == pytest.approx(6 / 3.1622776601683795)
    sample = values(W.zscore(series({"a": [1, 2, 3, 4, 10]}), ["x"]), "x_zscore")
    assert sample[-1] == pytest.approx(6 / 3.5355339059327378)
