"""Parameter search: schedules by hand, draws, survivors, and small models."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from riverframe.operators import models, search as X, sequences as S
from riverframe.plans import tuning

SPACE = {"a": X.Choice(("x", "y")), "b": X.Steps(1, 9, 2), "c": X.Steps(0.1, 0.5, 0.1)}


def test_options():
    assert X.Steps(32, 128, 32).options() == (32, 64, 96, 128)
    assert X.Steps(0.1, 0.5, 0.1).options() == (0.1, 0.2, 0.3, 0.4, 0.5)
    assert X.Steps(1, 6, 2).options() == (1, 3, 5)


def test_draws_are_distinct_repeatable_and_spread():
    sets = X.draw(SPACE, 30)
    assert sets == X.draw(SPACE, 30) != X.draw(SPACE, 30, seed=1)
    assert len({tuple(sorted(s.items())) for s in sets}) == 30
    every = X.draw(SPACE, 10_000)
    assert len(every) == 50 and all(s["a"] in "xy" and s["b"] in (1, 3, 5, 7, 9) for s in every)
    rates = [s["r"] for s in X.draw({"r": X.LogUniform(1e-4, 1e-1), "k": X.Choice((1, 2))}, 3000)]
    assert min(rates) >= 1e-4 and max(rates) <= 1e-1
    assert sum(r < 1e-3 for r in rates) / 3000 == pytest.approx(1 / 3, abs=0.04), "evenly over the logarithm"


def test_brackets_for_81_and_3():
    """ceil(5 / (s + 1) * 3^s) sets on 81 / 3^s."""
    found = [[(r.size, r.budget) for r in rungs] for rungs in X.brackets(81, 3)]
    assert found == [
        [(81, 1), (27, 3), (9, 9), (3, 27), (1, 81)],
        [(34, 3), (11, 9), (3, 27), (1, 81)],
        [(15, 9), (5, 27), (1, 81)],
        [(8, 27), (2, 81)],
        [(5, 81)],
    ]


@settings(deadline=None)
@given(st.integers(1, 400), st.integers(2, 5))
def test_no_rung_is_empty_and_every_bracket_ends_on_the_whole_budget(budget, factor):
    for rungs in X.brackets(budget, factor):
        assert rungs[-1].budget == budget and rungs[-1].keep == 1 and rungs[0].budget >= 1
        for a, b in zip(rungs, rungs[1:]):
            assert a.keep == b.size >= 1 and b.budget == pytest.approx(a.budget * factor)


@pytest.mark.parametrize("bad", [(9, 1, 1), (0.5, 3, 1), (9, 3, 0)])
def test_schedules_that_make_no_sense(bad):
    with pytest.raises(ValueError):
        X.brackets(*bad)


def test_hyperband_keeps_the_best_of_every_rung():
    asked = []

    def evaluate(trials, budget):
        asked.append((len(trials), budget))
        return [-((t.params["b"] - 5) ** 2) - t.params["c"] + 1 / budget for t in trials]

    found = X.hyperband(SPACE, evaluate, 9, 3)
    assert asked == [(9, 1), (3, 3), (1, 9), (5, 3), (1, 9), (3, 9)]
    assert found.best.budget == 9 and found.best.score == max(t.score for t in found.trials if t.budget == 9)
    for b in range(3):
        for i in range(3 - b):
            rung = [t for t in found.trials if (t.bracket, t.rung) == (b, i)]
            assert min(t.score for t in rung if t.survived) >= max([t.score for t in rung if not t.survived], default=-math.inf)
            later = {t.trial for t in found.trials if (t.bracket, t.rung) == (b, i + 1)}
            assert not later or later == {t.trial for t in rung if t.survived}


def test_missing_scores_lose_ties_keep_their_order_and_losses_are_minimised():
    scores = [None, 0.5, float("nan"), 0.5, 0.2]
    for larger, first in ((True, 1), (False, 4)):
        found = X.random_search(SPACE, lambda trials, budget: scores, 5, larger=larger)
        assert found.best.trial == first and [t.trial for t in found.trials if t.survived] == [first]
    nothing = X.random_search(SPACE, lambda trials, budget: [None] * 5, 5)
    assert nothing.best.trial == 0 and nothing.best.score is None


def test_table(spark):
    found = X.random_search(SPACE, lambda trials, budget: [0.1 * t.trial for t in trials], 4)
    rows = found.table(spark).orderBy("trial").collect()
    assert [r["score"] for r in rows] == pytest.approx([0, 0.1, 0.2, 0.3]) and [r["survived"] for r in rows] == [False] * 3 + [True]
    assert rows[0]["params"]["a"] in "xy"


@pytest.fixture(scope="module")
def split(spark):
    """Two keys of 150 days; the label follows a threshold on one of three features, the last fifth is test."""
    rng = random.Random(3)
    rows = []
    for key in "ab":
        for i in range(150):
            x = [rng.random() for _ in range(3)]
            rows.append((key, i, x, int(x[1] > 0.7 or (x[0] > 0.5 and x[2] > 0.8))))
    df = spark.createDataFrame(rows, "location string, i int, features array<double>, label int").selectExpr("location", "date_add(date'2024-01-01', i) AS date", "features", "label")
    return S.with_vector(S.chrono_split(df, ["location"], "date", chunk=0)).select("location", "date", "label", "split", "features")


def test_validation_tail(split):
    both = {m: {(r["location"], r["split"]): r["n"] for r in S.validation_tail(split, ["location"], "date", 0.25, m, chunk=0).groupBy("location", "split").agg(F.count("*").alias("n")).collect()} for m in ("concat", "per_key")}
    assert both["concat"] == {("a", "train"): 120, ("a", "test"): 30, ("b", "train"): 60, ("b", "val"): 60, ("b", "test"): 30}
    assert both["per_key"] == {(k, s): n for k in "ab" for s, n in (("train", 90), ("val", 30), ("test", 30))}
    tail = S.validation_tail(split, ["location"], "date", 0.25, "per_key", chunk=0)
    last = tail.filter("split = 'train'").agg(F.max("date")).first()[0]
    assert last < tail.filter("split = 'val'").agg(F.min("date")).first()[0] and tail.columns == split.columns


def test_age(split):
    aged = X.with_age(split.drop("split"), ["location"], "date", chunk=0)
    newest = aged.filter("age <= 0.1").agg(F.count("*").alias("n"), F.min("date").alias("d")).first()
    assert newest["n"] == 30 and newest["d"] == aged.agg(F.max("date")).first()[0].replace(month=5, day=15)


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.0), (0, 1.0)], "y int, p double")
    want = -(math.log(0.9) + math.log(0.8) + 2 * math.log(X.EPSILON)) / 4
    assert X.log_loss(df, "y", F.col("p")) == pytest.approx(want, rel=1e-6)


def test_random_search_of_a_tree_finds_the_depth_that_is_needed(split):
    space = {"maxDepth": X.Steps(1, 6, 1), "minInstancesPerNode": X.Choice((1, 5))}
    tuned = tuning.tune_model(split, DecisionTreeClassifier(seed=1), space, max_trials=12)
    assert len(tuned.search.trials) == 12 and tuned.search.best.params["maxDepth"] >= 2
    assert tuned.model.getMaxDepth() == tuned.search.best.params["maxDepth"]
    # The whole space was drawn, so the best is that of a grid over the same rows.
    rows = tuned.rows
    grid = [{"maxDepth": d, "minInstancesPerNode": m} for d in range(1, 7) for m in (1, 5)]
    _, table = models.tune(rows, DecisionTreeClassifier(seed=1, weightCol="weight"), grid)
    assert tuned.search.best.score == pytest.approx(max(t["f1"] for t in table))
    assert rows.filter("split = 'test'").count() == 0 and rows.count() == 240


def test_hyperband_over_trees_of_a_forest(split):
    space = {"maxDepth": X.Steps(1, 6, 1), "subsamplingRate": X.Choice((0.6, 0.8, 1.0))}
    tuned = tuning.tune_model(split, RandomForestClassifier(seed=1), space, "hyperband", max_budget=4, factor=2, budget_param="numTrees")
    assert {t.budget for t in tuned.search.trials} == {1, 2, 4} and tuned.model.getNumTrees == 4
    assert tuned.search.best.score == max(t.score for t in tuned.search.trials if t.budget == 4)


def test_hyperband_over_the_newest_days(split, monkeypatch):
    """A rung reads the newest share of every key's training days."""
    sizes = []
    plain = DecisionTreeClassifier.fit
    monkeypatch.setattr(DecisionTreeClassifier, "fit", lambda self, df: (sizes.append((df.count(), df.agg(F.max("age")).first()[0])), plain(self, df))[1])
    tuned = tuning.tune_model(split, DecisionTreeClassifier(seed=1), {"maxDepth": X.Steps(1, 8, 1)}, "hyperband", max_budget=4, factor=2, parallelism=1)
    train = tuned.rows.filter("split = 'train'").count()
    # 120 training rows of key a, 72 of key b before the tail.
    assert train == 192 and {n for n, _ in sizes[:-1]} == {48, 96, 192} and sizes[-1][0] == 240
    assert all(age <= n / train + 1e-9 for n, age in sizes[:-1])


def test_losses_and_several_executions(split):
    tuned = tuning.tune_model(split, LogisticRegression(), {"regParam": X.LogUniform(1e-4, 1.0)}, max_trials=4, objective="log_loss")
    scores = [t.score for t in tuned.search.trials]
    assert tuned.search.best.score == min(scores) > 0
    twice = tuning.tune_model(split, RandomForestClassifier(numTrees=2, seed=1), {"maxDepth": X.Choice((3,))}, max_trials=1, executions=2)
    once = [tuning.tune_model(split, RandomForestClassifier(numTrees=2, seed=s), {"maxDepth": X.Choice((3,))}, max_trials=1).search.best.score for s in (1, 2)]
    assert twice.search.best.score == pytest.approx(sum(once) / 2)
    with pytest.raises(ValueError, match="random or hyperband"):
        tuning.tune_model(split, LogisticRegression(), {"regParam": X.Choice((0.1,))}, "grid")


def test_decay_needs_listed_options(series):
    with pytest.raises(ValueError, match="listed"):
        tuning.search_index_decay(series({"a": [1, 2]}).withColumn("y", F.col("x")), "x", "y", {"alpha": X.LogUniform(0.1, 0.9)})
