"""Searching the parameters of a model and of the precipitation index on a training set."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverframe.operators.ema import emas
from riverframe.operators.models import with_class_weights
from riverframe.operators.ordered import DAILY
from riverframe.operators.search import Search, Space, by_aggregate, fit_and_score, hyperband, larger_is_better, random_search, refit, with_age
from riverframe.operators.sequences import validation_tail
from riverframe.operators.settle import settle

KEY, DAY = "location", "date"


@dataclass(frozen=True)
class Tuned:
    """The model refitted on all training rows with the best parameters, the search, and the rows it ran on."""

    model: object
    search: Search
    rows: DataFrame


def tune_model(
    split_rows: DataFrame,
    estimator,
    space: Space,
    method: str = "random",
    max_trials: int = 10,
    max_budget: float = 27,
    factor: int = 3,
    min_budget: float = 1,
    budget_param: str | None = None,
    objective: str = "f1",
    validation: float = 0.2,
    keys: Sequence[str] = (KEY,),
    ts: str = DAY,
    y: str = "label",
    seed: int = 42,
    executions: int = 1,
    parallelism: int = 4,
    chunk: int | None = DAILY,
) -> Tuned:
    """Search on the ``train`` rows of a split, of which the newest ``validation`` share is held out for the scores.

    ``split_rows`` has keys, time, ``y``, ``split`` and ``features`` (a vector). Classes are weighted by the training rows. The
    rows are written once, newest first inside each file; test rows play no part. ``method`` is ``random`` or ``hyperband``, whose
    budget is ``budget_param`` of the estimator or, without one, the newest share of the training days.
    """
    marked = validation_tail(split_rows.filter(F.col("split") == "train"), keys, ts, validation, chunk=chunk)
    aged = with_age(marked.filter(F.col("split") == "train"), keys, ts, chunk=chunk)
    weighted = with_class_weights(aged, y)
    held = marked.filter(F.col("split") == "val").withColumns({"age": F.lit(0.0), "weight": F.lit(1.0)})
    columns = [*keys, ts, y, "split", "features", "age", "weight"]
    rows = settle(weighted.select(*columns).unionByName(held.select(*columns)).sortWithinPartitions("age"), "search")
    estimator = estimator.copy({estimator.weightCol: "weight", estimator.labelCol: y})
    larger = larger_is_better(objective)
    how = {"objective": objective, "executions": executions, "parallelism": parallelism, "y": y}
    if method == "random":
        search = random_search(space, fit_and_score(rows, estimator, **how), max_trials, seed, larger)
    elif method == "hyperband":
        budget = {"budget_param": budget_param} if budget_param else {"age_col": "age"}
        evaluate = fit_and_score(rows, estimator, **how, **budget, max_budget=max_budget)
        search = hyperband(space, evaluate, max_budget, factor, min_budget, seed, larger)
    else:
        raise ValueError(f"method must be random or hyperband, not {method!r}")
    best = search.best
    given = best.params | ({budget_param: int(best.budget)} if method == "hyperband" and budget_param else {})
    whole = with_class_weights(rows.drop("weight"), y)
    return Tuned(refit(estimator, given, whole), search, rows)


def search_index_decay(
    days: DataFrame, rain: str, target: str, space: Space, max_days: int = 729, factor: int = 3, min_days: int = 27, seed: int = 42
) -> Search:
    """Hyperband over the decay ``alpha`` of the precipitation index: its correlation with the target on the newest days of each key.

    The index of every option is computed in one pass over the whole series and written once; a rung is one aggregate.
    """
    options = space["alpha"].options()
    if options is None:
        raise ValueError("the decay needs listed options: one column each is computed at once")
    names = {a: f"index_{i}" for i, a in enumerate(options)}
    indexed = emas(days.select(KEY, DAY, rain, target), [KEY], DAY, rain, {n: a for a, n in names.items()}, chunk=DAILY)
    back = F.row_number().over(Window.partitionBy(KEY).orderBy(F.desc(DAY)))
    stored = settle(indexed.withColumn("back", back), "index")
    evaluate = by_aggregate(lambda budget: stored.filter(F.col("back") <= budget), lambda p: F.corr(names[p["alpha"]], target))
    return hyperband(space, evaluate, max_days, factor, min_days, seed)
