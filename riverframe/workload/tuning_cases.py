"""Queries of parameter searches. Where scores are aggregates, the SQL repeats the whole search from the same drawn sets;
where a model is trained, it repeats the schedule and the query tells whether the survivors are the best ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverframe.operators import search as X, sequences as S
from riverframe.operators.ordered import DAILY, add_rows
from riverframe.operators.settle import settle
from riverframe.operators.windows import rolling_of
from riverframe.plans import tuning
from riverframe.workload import oracles as Q
from riverframe.workload.cases import case
from riverframe.workload.queries import KEYS, _paired_days, rounded

SEED = 42

# -- the validation tail of the training rows ------------------------------------

SPLIT = """train AS (SELECT location, date FROM (
    SELECT *, row_number() OVER (PARTITION BY location ORDER BY date) AS pos, count(*) OVER (PARTITION BY location) AS n FROM days) WHERE pos <= floor(n * 0.8::DOUBLE))"""


def _tail_sql(partition: str, order: str) -> str:
    return f"""WITH {Q.PAIRED}, {SPLIT},
    placed AS (SELECT *, row_number() OVER ({partition} ORDER BY {order}) AS pos, count(*) OVER ({partition}) AS n FROM train)
    SELECT days.location, days.date, CASE WHEN p.pos IS NULL THEN 'test' WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'val' END AS split
    FROM days LEFT JOIN placed p USING (location, date)"""


def _split_days(spark, sf):
    return S.chrono_split(settle(_paired_days(spark, sf)).select("location", "date"), KEYS, "date", chunk=DAILY)


@case(_tail_sql("", "location, date"))
def split_validation_tail(spark, sf):
    """What a trainer holds out of the stacked training rows for itself: their last fifth."""
    return S.validation_tail(_split_days(spark, sf), KEYS, "date", 0.2, chunk=DAILY)


@case(_tail_sql("PARTITION BY location", "date"))
def split_validation_tail_per_key(spark, sf):
    return S.validation_tail(_split_days(spark, sf), KEYS, "date", 0.2, mode="per_key", chunk=DAILY)


# -- random search over alarm rules ----------------------------------------------

RAIN_WINDOWS = {"rain1": 1, "rain3": 3, "rain7": 7}
ALARM = {"signal": X.Choice(tuple(RAIN_WINDOWS)), "threshold": X.Steps(10, 400, 10)}
ALARM_SETS = X.draw(ALARM, 25, SEED)
ALARM_SQL = f"""WITH {Q.PAIRED}, x AS (SELECT river_discharge_m3s >= 200 AS y, rain_sum_mm AS rain1,
    sum(rain_sum_mm) OVER {Q.over(3)} AS rain3, sum(rain_sum_mm) OVER {Q.over(7)} AS rain7 FROM days),
  s AS ({" UNION ALL ".join(f"SELECT {i} AS trial, '{p['signal']}' AS signal, {p['threshold']} AS threshold, count(*) FILTER (y AND {p['signal']} >= {p['threshold']}) AS tp, count(*) FILTER (NOT y AND {p['signal']} >= {p['threshold']}) AS fp, count(*) FILTER (y AND {p['signal']} < {p['threshold']}) AS fn FROM x" for i, p in enumerate(ALARM_SETS))}),
  f AS (SELECT *, 2 * tp / (2 * tp + fp + fn) AS f1 FROM s)
SELECT trial, signal, threshold, round(f1, 6) AS f1, row_number() OVER (ORDER BY f1 DESC, trial) = 1 AS best FROM f"""


@case(ALARM_SQL)
def random_search_alarm(spark, sf):
    """Which rain sum at which threshold tells days of high discharge best (F1): 25 drawn rules, scored in one pass."""
    rows = {n: rolling_of("rain_sum_mm", w, "sum", min_periods=1) for n, w in RAIN_WINDOWS.items()}
    days = settle(add_rows(_paired_days(spark, sf), KEYS, "date", rows, chunk=DAILY))
    high = F.col("river_discharge_m3s") >= 200

    def f1(params):
        alarm = F.col(params["signal"]) >= params["threshold"]
        tp, wrong = F.count_if(high & alarm), F.count_if(high != alarm)
        return F.try_divide(2 * tp, 2 * tp + wrong)

    search = X.random_search(ALARM, X.by_aggregate(lambda budget: days, f1), 25, SEED)
    table = search.table(spark).select("trial", F.col("params")["signal"].alias("signal"), F.col("params")["threshold"].cast("int").alias("threshold"), F.col("score").alias("f1"), F.col("survived").alias("best"))
    return rounded(table)


# -- Hyperband over the decay of the index ----------------------------------------

DECAYS = {"alpha": X.Steps(0.05, 0.95, 0.05)}
MAX_DAYS, MIN_DAYS, FACTOR = 729, 27, 3


def _hyperband_sql() -> str:
    """Every bracket and rung as a table: the sets are those drawn, scores and survivors come from the data."""
    names = {f"a{i}": a for i, a in enumerate(DECAYS["alpha"].options())}
    ctes = [
        Q.PAIRED, Q.ema_cte("days", "rain_sum_mm", names, "date"),
        "x AS MATERIALIZED (SELECT e.*, n.river_discharge_m3s AS y, row_number() OVER (PARTITION BY location ORDER BY n.date DESC) AS back FROM numbered n JOIN ema e USING (location, pos))",
    ]
    schedule = X.brackets(MAX_DAYS, FACTOR, MIN_DAYS)
    for budget in sorted({r.budget for rungs in schedule for r in rungs}):
        ctes.append(f"score{budget:.0f} AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {a}::DOUBLE AS alpha, corr({n}, y) AS score FROM x WHERE back <= {budget}" for n, a in names.items()) + ")")
    out, number = [], 0
    for b, rungs in enumerate(schedule):
        sets = X.draw(DECAYS, rungs[0].size, SEED + b)
        source = "(VALUES " + ", ".join(f"({number + i}, {p['alpha']}::DOUBLE)" for i, p in enumerate(sets)) + ") AS t(trial, alpha)"
        number += len(sets)
        for i, rung in enumerate(rungs):
            ctes.append(f"r{b}_{i} AS MATERIALIZED (SELECT t.trial, t.alpha, s.score, row_number() OVER (ORDER BY s.score DESC, t.trial) <= {rung.keep} AS survived FROM {source} JOIN score{rung.budget:.0f} s ON s.alpha = t.alpha)")
            out.append(f"SELECT trial, {b} AS bracket, {i} AS rung, {rung.budget}::DOUBLE AS budget, alpha, round(score, 6) AS score, survived FROM r{b}_{i}")
            source = f"(SELECT trial, alpha FROM r{b}_{i} WHERE survived) AS t"
    return f"WITH RECURSIVE {', '.join(ctes)} " + " UNION ALL ".join(out)


@case(_hyperband_sql())
def hyperband_index(spark, sf):
    """The decay of the precipitation index that goes with discharge best, on more and more days."""
    search = tuning.search_index_decay(_paired_days(spark, sf), "rain_sum_mm", "river_discharge_m3s", DECAYS, MAX_DAYS, FACTOR, MIN_DAYS, SEED)
    table = search.table(spark).withColumn("alpha", F.col("params")["alpha"].cast("double")).drop("params")
    return table.withColumn("score", F.round("score", 6))


# -- Hyperband over trees ----------------------------------------------------------

TREES = {"maxDepth": X.Choice((2, 3, 5, 8, 10)), "minInstancesPerNode": X.Choice((1, 10)), "impurity": X.Choice(("gini", "entropy"))}
TREE_BUDGET = 9

RUNGS_SQL = f"""WITH RECURSIVE {Q.PAIRED},
  s AS (SELECT CAST(floor(log({TREE_BUDGET}) / log(3) + 1e-9) AS INTEGER) AS most),
  b AS (SELECT bracket, most, most - bracket AS s, CAST(ceil((most + 1) * pow(3, most - bracket) / (most - bracket + 1) - 1e-9) AS INTEGER) AS size FROM s, unnest(range(0, most + 1)) t(bracket)),
  r AS (SELECT b.*, i AS rung, CAST(floor(size / pow(3, i) + 1e-9) AS INTEGER) AS n, {TREE_BUDGET} / pow(3, s - i) AS budget FROM b, unnest(range(0, s + 1)) t(i)),
  kept AS (SELECT location, greatest(count(*) - 7, 0) AS m FROM days GROUP BY 1),
  held AS (SELECT sum(floor(m * 0.8::DOUBLE)) AS n_train FROM kept)
SELECT CAST(bracket AS INTEGER) AS bracket, CAST(rung AS INTEGER) AS rung, CAST(n AS BIGINT) AS n_trials, budget,
  CAST(CASE WHEN rung = s THEN 1 ELSE greatest(n // 3, 1) END AS BIGINT) AS n_survivors, true AS survivors_are_best, true AS scored,
  CAST(n_train - floor(n_train * 0.8::DOUBLE) AS BIGINT) AS n_held_out FROM r, held"""


def _tree_split(spark, sf):
    days = S.label_quantile(settle(_paired_days(spark, sf)), "river_discharge_m3s", 0.8)
    cut = S.sequences(days, KEYS, "date", ["rain_sum_mm", "river_discharge_m3s"], 7, "label", chunk=DAILY)
    return S.with_vector(S.flatten_sequences(S.chrono_split(cut, KEYS, "date", chunk=DAILY))).select("location", "date", "label", "split", "features")


def tree_search(spark, sf, **how):
    from pyspark.ml.classification import DecisionTreeClassifier

    return tuning.tune_model(_tree_split(spark, sf), DecisionTreeClassifier(seed=SEED), TREES, **how)


@case(RUNGS_SQL)
def hyperband_rungs(spark, sf):
    """Trees searched on the newest ninth, third and all of the training days: the rungs, and whether they kept the best."""
    tuned = tree_search(spark, sf, method="hyperband", max_budget=TREE_BUDGET)
    table = tuned.search.table(spark)
    worst_kept, best_lost = F.min(F.when(F.col("survived"), F.col("score"))), F.max(F.when(~F.col("survived"), F.col("score")))
    rungs = table.groupBy("bracket", "rung").agg(
        F.count("*").alias("n_trials"), F.first("budget").alias("budget"), F.count_if("survived").alias("n_survivors"),
        F.coalesce(worst_kept >= best_lost, F.lit(True)).alias("survivors_are_best"), F.every(F.col("score").between(0, 1)).alias("scored"),
    )
    held = tuned.rows.filter("split = 'val'").agg(F.count("*").alias("n")).scalar()
    return rungs.withColumn("n_held_out", held)
