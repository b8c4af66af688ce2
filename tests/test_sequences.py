"""Sequences, splits, horizon windows, metrics and models, with the known counts and scores."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverframe.operators import metrics, models, sequences as S
from riverframe.plans import evaluate, scoring, training

K = ["location"]


def test_sequences_stay_inside_a_key(series, rows):
    df = series({"a": [1, 2, 3, 4], "b": [10, 20], "c": [5]})
    out = S.sequences(df, K, "date", ["x"], 2, "x").withColumn("s", F.flatten("sequence"))
    got = [(k, v, list(s)) for k, v, s in rows(out, "location", "x", "s")]
    assert got == [("a", 3.0, [1.0, 2.0]), ("a", 4.0, [2.0, 3.0])]
    assert rows(S.sequence_counts(df, K, 2)) == [("a", 4, 2), ("b", 2, 0), ("c", 1, 0)]


def test_chunked_sequences_equal_plain(series, rows):
    df = series({"a": range(50), "b": range(7)})
    plain = S.sequences(df, K, "date", ["x"], 5, "x")
    cut = S.sequences(df, K, "date", ["x"], 5, "x", chunk=8)
    assert rows(plain.withColumn("sequence", F.flatten("sequence").cast("string"))) == rows(
        cut.withColumn("sequence", F.flatten("sequence").cast("string")))


def test_splits(series, rows):
    df = series({"a": range(10), "b": range(5)})

    def sizes(**how):
        out = S.chrono_split(df, K, "date", **how).groupBy("location", "split").count()
        return {(r.location, r.split): r["count"] for r in out.collect()}

    assert sizes() == {("a", "train"): 8, ("a", "test"): 2, ("b", "train"): 4, ("b", "test"): 1}
    # 12 of 15 rows laid end to end: the whole of a and two of b.
    assert sizes(mode="concat") == {("a", "train"): 10, ("b", "train"): 2, ("b", "test"): 3}
    assert sizes(chunk=4) == sizes() and sizes(mode="concat", chunk=4) == sizes(mode="concat")
    assert sizes(ratios=(0.7, 0.15, 0.15)) == {
        ("a", "train"): 7, ("a", "val"): 1, ("a", "test"): 2, ("b", "train"): 3, ("b", "val"): 1, ("b", "test"): 1}
    assert sizes(ratios=(0.75, 0.25), rounding="ceil_test") == {
        ("a", "train"): 7, ("a", "test"): 3, ("b", "train"): 3, ("b", "test"): 2}
    late = S.chrono_split(df, K, "date").filter("split = 'test'").agg(F.min("x")).first()[0]
    assert late == 4.0


def test_known_training_counts(series):
    """Two locations of 5896 complete days give the counts of the stored run."""
    df = series({"Klang": [float(i % 97) for i in range(5896)], "Petaling": [float(i % 89) for i in range(5896)]}, "2010-01-08")
    made = training.make_training_set(df, ["x"], "x", n=14, history=None, mode="concat")
    got = training.training_metadata(made, ["x"], "x", 14, counts_map=True).first().asDict()
    assert got == {"sequence_length": 14, "target_column": "x", "feature_count": 1, "rows_used": 11792,
                   "total_sequences": 11764, "train_sequences": 9411, "test_sequences": 2353,
                   "location_sequence_counts": {"Klang": 5882, "Petaling": 5882}}


def test_scaler_fitted_on_train_only(series):
    df = series({"a": [0, 2, 0, 2, 100]})
    made = training.make_training_set(df, ["x"], "x", n=1, history=None, fit_on_train=True)
    assert made.scaler.first()["mean"] == 1.0


def test_labels(series, rows):
    df = series({"a": [99, 100, 101, 102, 103]})
    assert rows(S.label_at(df, "x", 100.0), "x", "label")[-1] == (99.0, 0)
    assert rows(S.label_quantile(df, "x", 0.5).filter("label = 1"), "x") == [(101.0,), (102.0,), (103.0,)]
    flagged = df.withColumn("is_extreme", F.lit(1))
    assert S.label_quantile(flagged, "x", prefer="is_extreme").agg(F.sum("label")).first()[0] == 5


def test_horizon_repeats_the_last_row(series, rows):
    df = series({"a": [1, 2, 3, 4], "b": [9]})
    out = S.horizon_windows(df, K, "date", ["x"], 3, "2024-01-09").withColumn("s", F.flatten("sequence"))
    got = [(str(d), h, list(s)) for d, h, s in rows(out, "date", "step", "s")]
    assert got == [("2024-01-05", 1, [2, 3, 4]), ("2024-01-06", 2, [3, 4, 4]), ("2024-01-07", 3, [4, 4, 4]),
                   ("2024-01-08", 4, [4, 4, 4]), ("2024-01-09", 5, [4, 4, 4])]
    ok, rejected = S.eligible(df, K, 3, ["x"])
    assert ok.count() == 4 and rows(rejected) == [("b", 1)]
    assert S.horizon_windows(df, K, "date", ["x"], 3, "2024-01-04").count() == 0


# Confusion counts of the three stored models and their scores.
GOLDEN = {
    "CNN": ((2, 8, 27, 2316), (0.9851253718657034, 0.2, 0.06896551724137931, 0.10256410256410256)),
    "LSTM": ((0, 2, 29, 2322), (0.9868253293667658, 0.0, 0.0, 0.0)),
    "CNN-LSTM": ((0, 3, 29, 2321), (0.9864003399915002, 0.0, 0.0, 0.0)),
}


@pytest.fixture(scope="module")
def judged(spark):
    cells = [(m, y, p, n) for m, (c, _) in GOLDEN.items() for (y, p), n in zip(((1, 1), (0, 1), (1, 0), (0, 0)), c)]
    grid = spark.createDataFrame(cells, "model string, y int, p int, n int")
    return grid.withColumn("i", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(1), F.col("n"))))).drop("n", "i")


def test_known_scores(judged):
    got = {r["Model"]: tuple(r)[1:] for r in metrics.compare_models(judged, "y", "p").collect()}
    assert got == {m: scores for m, (_, scores) in GOLDEN.items()}
    counts = {r.model: (r.tp, r.fp, r.fn, r.tn) for r in metrics.binary_metrics(judged, "y", "p", ["model"]).collect()}
    assert counts == {m: c for m, (c, _) in GOLDEN.items()}


def test_confusion_and_report(judged, rows):
    cnn = judged.filter("model = 'CNN'")
    assert rows(metrics.confusion(cnn, "y", "p")) == [(0, 0, 2316), (0, 1, 8), (1, 0, 27), (1, 1, 2)]
    report = {r.label: r for r in metrics.class_report(cnn, "y", "p").collect()}
    assert report["1"].support == 29 and report["0"].support == 2324
    assert report["1"].precision == 0.2 and report["accuracy"].f1 == GOLDEN["CNN"][1][0]
    assert report["macro avg"].precision == pytest.approx((0.2 + 2316 / 2343) / 2)
    assert report["weighted avg"].recall == pytest.approx(GOLDEN["CNN"][1][0])


def test_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0), (5.0, 2.0)], "y double, p double")
    got = metrics.regression_error(df, "y", "p").first()
    assert (got.rmse, got.mae, got.n) == (pytest.approx(5**0.5), 2.0, 2)
    judged = evaluate.compare_at_threshold(df, "y", {"m": "p"}, 2.0).first()
    assert (judged["Accuracy"], judged["Precision"], judged["Recall"]) == (0.5, 0.5, 1.0)


def test_evaluate_cut(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.4)], "label int, p1 double")
    assert evaluate.evaluate(df)["metrics"].first().tp == 1
    assert evaluate.evaluate(df, strict=True)["metrics"].first().tp == 0


def test_score_and_horizon(series, rows):
    def last_value_model():
        return lambda x: x[:, -1, 0] * 100

    df = series({"a": [1, 2, 3, 4], "b": [1, 2]})
    scored = scoring.score_forecast(df, ["x"], None, last_value_model, n=2)
    assert rows(scored, "location", "date", "predicted_discharge", "flood_risk") == [
        ("a", dt.date(2024, 1, 3), 200.0, "MEDIUM"), ("a", dt.date(2024, 1, 4), 300.0, "MEDIUM")]
    with pytest.raises(ValueError, match="rain_sum_mm"):
        scoring.score_forecast(df, ["rain_sum_mm"], None, last_value_model)
    ahead, rejected = scoring.forecast_horizon(df, ["x"], None, last_value_model, "2024-01-06", n=3, target=None)
    assert rows(ahead, "location", "step", "predicted_discharge", "flood_risk") == [("a", 1, 400.0, "HIGH"), ("a", 2, 400.0, "HIGH")]
    assert rows(rejected) == [("b", 2)]


def test_score_shape(series):
    df = series({"a": range(6)}).withColumn("y", F.col("x") * 10)
    model = lambda: lambda x: np.asarray([b[0, 1] + b[2, 0] for b in x])
    scored = models.score(S.sequences(df, K, "date", ["x", "y"], 3), model, (3, 2))
    assert [r.prediction for r in scored.orderBy("date").collect()] == [0 + 2, 10 + 3, 20 + 4]


def test_trees_and_tuning(series):
    from pyspark.ml.classification import DecisionTreeClassifier

    df = series({"a": [i % 2 for i in range(60)], "b": [(i // 2) % 2 for i in range(60)]})
    rows_ = S.sequences(df, K, "date", ["x"], 3, "x").withColumn("label", F.col("x").cast("int"))
    rows_ = S.chrono_split(rows_, K, "date")
    rows_ = models.with_class_weights(S.with_vector(S.flatten_sequences(rows_)).select("label", "split", "features", "location"))
    for model in (models.fit_tree(rows_.filter("split = 'train'")), models.fit_forest(rows_.filter("split = 'train'"), trees=5)):
        out = models.positive_probability(model.transform(rows_.filter("split = 'test'")))
        assert out.filter((F.col("p1") > 0.5).cast("int") != F.col("label")).count() == 0
    best, table = models.tune(rows_, DecisionTreeClassifier(seed=1), [{"maxDepth": 1}, {"maxDepth": 5}])
    assert best.depth > 1 and {t["maxDepth"] for t in table} == {1, 5} and max(t["f1"] for t in table) == 1.0


def test_actual_and_forecast(series, rows):
    a, f = series({"a": [1]}), series({"a": [2]}, "2024-01-02").withColumnRenamed("x", "p")
    assert rows(S.actual_vs_forecast(a, f, K, "date", "x", "p"), "value", "type") == [(1.0, "actual"), (2.0, "forecast")]
