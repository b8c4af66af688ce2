"""Parameter search: seeded random search and Hyperband over settled, chronologically split rows.

A space says what each parameter may be; :func:`draw` takes distinct parameter sets from it, the same ones for the same
seed. Random search gives every set the whole budget. Hyperband (successive halving in several brackets) starts many sets on a small
budget and keeps the best share of every rung for the next, larger one. What a budget is, is for the evaluation to say: an
estimator's own parameter (trees, iterations), the newest share of the training days, or a number of days.

An evaluation gets all parameter sets of a rung at once and returns one score each. :func:`fit_and_score` trains Spark ML
estimators side by side; scores that are aggregates can be computed for the whole rung in one pass (:func:`by_aggregate`).
What the driver holds is one row per trial.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverframe.operators.metrics import binary_metrics
from riverframe.operators.ordered import positions

#: Probabilities are kept this far from 0 and 1 in a logarithm.
EPSILON = 1e-7
SMALLER_IS_BETTER = {"log_loss"}
TRIALS = "trial int, bracket int, rung int, budget double, params map<string,string>, score double, survived boolean"


@dataclass(frozen=True)
class Choice:
    values: tuple

    def options(self) -> tuple:
        return self.values


@dataclass(frozen=True)
class Steps:
    """``low``, ``low + step``, ... up to ``high`` inclusive."""

    low: float
    high: float
    step: float

    def options(self) -> tuple:
        n = math.floor((self.high - self.low) / self.step + 1e-9) + 1
        whole = all(isinstance(v, int) for v in (self.low, self.high, self.step))
        return tuple(self.low + i * self.step if whole else round(self.low + i * self.step, 12) for i in range(n))


@dataclass(frozen=True)
class LogUniform:
    """Any value between the two, evenly spread over its logarithm."""

    low: float
    high: float

    def options(self) -> None:
        return None


Space = Mapping[str, Choice | Steps | LogUniform]


def draw(space: Space, n: int, seed: int = 42) -> list[dict]:
    """Up to ``n`` distinct parameter sets in drawing order; all there are, where the space holds no more."""
    rng = random.Random(seed)
    options = {k: v.options() for k, v in sorted(space.items())}
    total = None if any(o is None for o in options.values()) else math.prod(len(o) for o in options.values())
    if total is not None:
        # A set is a number in the mixed base of its options, so distinct numbers are distinct sets.
        out = []
        for number in rng.sample(range(total), min(n, total)):
            params = {}
            for name, values in options.items():
                number, at = divmod(number, len(values))
                params[name] = values[at]
            out.append(params)
        return out
    out = []
    for _ in range(n):
        out.append({k: rng.choice(o) if o is not None else math.exp(rng.uniform(math.log(space[k].low), math.log(space[k].high))) for k, o in options.items()})
    return out


@dataclass(frozen=True)
class Rung:
    size: int
    budget: float
    keep: int


def brackets(max_budget: float, factor: int = 3, min_budget: float = 1) -> list[list[Rung]]:
    """The rungs of every bracket, the one with the most and shortest trials first.

    With ``s`` halvings left, ``ceil((s_max + 1) / (s + 1) * factor^s)`` sets start on ``max_budget / factor^s``; each rung
    keeps the best ``1 / factor`` of its sets, and the last one keeps one.
    """
    if factor < 2 or not 0 < min_budget <= max_budget:
        raise ValueError("factor must be 2 or more, and 0 < min_budget <= max_budget")
    most = 0
    while min_budget * factor ** (most + 1) <= max_budget:
        most += 1
    out = []
    for s in range(most, -1, -1):
        size = -(-(most + 1) * factor**s // (s + 1))
        rungs = []
        for i in range(s + 1):
            n = size // factor**i
            rungs.append(Rung(n, max_budget / factor ** (s - i), max(1, n // factor) if i < s else 1))
        out.append(rungs)
    return out


@dataclass(frozen=True)
class Trial:
    trial: int
    params: dict
    bracket: int = 0
    rung: int = 0
    budget: float = 1.0
    score: float | None = None
    survived: bool = False


Evaluate = Callable[[Sequence[Trial], float], Sequence[float | None]]


@dataclass
class Search:
    """Every evaluation in order; ``best`` is the best one among those that had the largest budget."""

    larger: bool
    trials: list[Trial] = field(default_factory=list)

    @property
    def best(self) -> Trial:
        full = max(t.budget for t in self.trials)
        return _ranked([t for t in self.trials if t.budget == full], self.larger)[0]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(t.trial, t.bracket, t.rung, float(t.budget), {k: str(v) for k, v in t.params.items()}, t.score, t.survived) for t in self.trials]
        return spark.createDataFrame(rows, TRIALS)


def _ranked(trials: Sequence[Trial], larger: bool) -> list[Trial]:
    """Best first; a missing score is last, and equal scores keep the order in which they were drawn."""
    def place(t: Trial):
        lost = t.score is None or math.isnan(t.score)
        return (lost, 0.0 if lost else -t.score if larger else t.score, t.trial)

    return sorted(trials, key=place)


def _halve(sets: Sequence[Trial], rungs: Sequence[Rung], evaluate: Evaluate, larger: bool) -> list[Trial]:
    done, going = [], list(sets)
    for i, rung in enumerate(rungs):
        scores = evaluate(going, rung.budget)
        scored = [replace(t, rung=i, budget=rung.budget, score=s) for t, s in zip(going, scores, strict=True)]
        kept = {t.trial for t in _ranked(scored, larger)[: rung.keep]}
        done += [replace(t, survived=t.trial in kept) for t in scored]
        going = [t for t in going if t.trial in kept]
    return done


def random_search(space: Space, evaluate: Evaluate, max_trials: int = 10, seed: int = 42, larger: bool = True, budget: float = 1.0) -> Search:
    sets = [Trial(i, params) for i, params in enumerate(draw(space, max_trials, seed))]
    return Search(larger, _halve(sets, [Rung(len(sets), budget, 1)], evaluate, larger))


def hyperband(space: Space, evaluate: Evaluate, max_budget: float, factor: int = 3, min_budget: float = 1, seed: int = 42, larger: bool = True) -> Search:
    """All brackets one after the other; every bracket draws sets of its own (fewer, where the space holds no more)."""
    out, number = Search(larger), 0
    for b, rungs in enumerate(brackets(max_budget, factor, min_budget)):
        sets = [Trial(number + i, params, bracket=b) for i, params in enumerate(draw(space, rungs[0].size, seed + b))]
        number += len(sets)
        out.trials += _halve(sets, rungs, evaluate, larger)
    return out


# -- evaluations ----------------------------------------------------------------


def with_age(df: DataFrame, keys: Sequence[str], ts: str, out: str = "age", chunk: int | None = None) -> DataFrame:
    """Where a row stands in its key, from just above 0 (newest) to 1 (oldest): ``age <= 0.25`` is the newest quarter."""
    placed = positions(df, keys, ts, "__pos", total="__total", chunk=chunk)
    return placed.withColumn(out, (F.col("__total") - F.col("__pos") + 1) / F.col("__total")).drop("__pos", "__total")


def log_loss(df: DataFrame, y: str, p1: Column) -> float | None:
    """Mean negative log likelihood of 0/1 labels."""
    p = F.greatest(F.least(p1, F.lit(1 - EPSILON)), F.lit(EPSILON))
    return df.agg(F.avg(-F.log(F.when(F.col(y) == 1, p).otherwise(1 - p)))).first()[0]


def fit_and_score(
    rows: DataFrame, estimator, y: str = "label", split_col: str = "split", train: str = "train", held_out: str = "val",
    objective: str = "f1", budget_param: str | None = None, age_col: str | None = None, max_budget: float = 1.0,
    executions: int = 1, parallelism: int = 4,
) -> Evaluate:
    """Fit an estimator on ``train`` rows for every set and score it on ``held_out`` rows (``f1``, ``accuracy`` or ``log_loss``).

    A budget is the value of ``budget_param``; or, with ``age_col``, the newest ``budget / max_budget`` of the training rows;
    or nothing. ``rows`` must be stored (settled), as every trial reads them: sorted by age inside a file, the filter on it
    skips row groups. ``executions`` averages over as many seeds.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    from pyspark.ml.functions import vector_to_array

    spark = rows.sparkSession
    test = rows.filter(F.col(split_col) == held_out)

    def one(trial: Trial, budget: float, run: int) -> float | None:
        given = dict(trial.params)
        fit_rows = rows.filter(F.col(split_col) == train)
        if budget_param:
            given[budget_param] = int(budget) if float(budget).is_integer() else max(1, round(budget))
        elif age_col:
            fit_rows = fit_rows.filter(F.col(age_col) <= budget / max_budget)
        if run and estimator.hasParam("seed"):
            given["seed"] = estimator.getOrDefault("seed") + run
        model = estimator.copy({estimator.getParam(k): v for k, v in given.items()}).fit(fit_rows)
        scored = model.transform(test)
        if objective == "log_loss":
            return log_loss(scored, y, vector_to_array("probability")[1])
        return binary_metrics(scored, y, "prediction").first()[objective]

    def evaluate(trials: Sequence[Trial], budget: float) -> list[float | None]:
        jobs = [(t, budget, run) for t in trials for run in range(executions)]
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            scores = list(pool.map(lambda j: inheritable_thread_target(spark)(one)(*j), jobs))
        groups = [scores[i * executions : (i + 1) * executions] for i in range(len(trials))]
        return [None if any(s is None for s in g) else sum(g) / executions for g in groups]

    return evaluate


def by_aggregate(rows: Callable[[float], DataFrame], score: Callable[[dict], Column]) -> Evaluate:
    """Scores that are aggregates: one pass over ``rows(budget)`` for all sets of a rung."""

    def evaluate(trials: Sequence[Trial], budget: float) -> list[float | None]:
        row = rows(budget).agg(*[score(t.params).alias(f"s{i}") for i, t in enumerate(trials)]).first()
        return [row[f"s{i}"] for i in range(len(trials))]

    return evaluate


def larger_is_better(objective: str) -> bool:
    return objective not in SMALLER_IS_BETTER


def refit(estimator, params: Mapping, df: DataFrame):
    """The estimator with the chosen parameters, fitted on ``df`` (train and validation rows together)."""
    return estimator.copy({estimator.getParam(k): v for k, v in params.items()}).fit(df)
