"""Trees on stored bags: the same for every layout, rows outside a bag without weight, votes by hand."""

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riverframe.operators import models as M
from riverframe.operators.sequences import with_vector

BAGS = ["(id * 7) % 3", "CASE WHEN id % 5 = 0 THEN NULL ELSE 1 + id % 2 END", "id % 4 - 1"]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(300).select("id", (F.col("id") % 13).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    df = df.withColumn("label", ((F.col("a") > 6) | (F.col("b") == 2)).cast("int"))
    return with_vector(df.withColumn("features", F.array("a", "b")))


def scores(df, forest):
    return {r["id"]: (round(r["p1"], 9), r["votes"]) for r in M.vote(df, forest).collect()}


def test_forest_does_not_depend_on_the_layout(table):
    def grow(df):
        return M.fit_bagged(df, [F.expr(b) for b in BAGS], depth=3)

    assert scores(table, grow(table.coalesce(1))) == scores(table, grow(table.repartition(7, "b")))


def test_votes_are_those_of_trees_fitted_alone(table):
    forest = M.fit_bagged(table, [F.expr(b) for b in BAGS], depth=2)
    total, votes = dict.fromkeys(range(300), 0.0), dict.fromkeys(range(300), 0)
    for bag in BAGS:
        own = table.withColumn("w", F.expr(bag).cast("double")).filter("w > 0")
        model = DecisionTreeClassifier(maxDepth=2, weightCol="w", seed=42).fit(own)
        for r in model.transform(table).select("id", vector_to_array("probability")[1].alias("p")).collect():
            total[r["id"]] += r["p"]
            votes[r["id"]] += r["p"] > 0.5
    assert scores(table, forest) == {k: (round(total[k] / 3, 9), votes[k]) for k in total}


def test_bags_without_rows_and_lists_of_wrong_length(table):
    with pytest.raises(Exception):
        M.fit_bagged(table, [F.lit(0)])
    with pytest.raises(ValueError):
        M.fit_bagged(table, [])
    with pytest.raises(ValueError):
        M.fit_bagged(table, [F.lit(1)], features=[[0], [1]])


def test_trees_see_their_features_alone(table):
    forest = M.fit_bagged(table, [F.lit(1), F.lit(1)], depth=2, features=[[0], [1]])
    p = M.vote(table, forest).groupBy("a", "b").agg(F.count_distinct("p1").alias("n")).agg(F.max("n")).first()[0]
    assert p == 1 and M.vote(table.limit(0), forest).columns == [*table.columns, "p1", "votes"]
