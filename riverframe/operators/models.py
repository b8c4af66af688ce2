"""Training and batch scoring. Trees are Spark ML; any other model is injected as a function
over numpy batches, which Spark calls once per Arrow batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverframe.operators.joins import join_groups
from riverframe.operators.stats import class_weights


def with_class_weights(df: DataFrame, y: str = "label", out: str = "weight") -> DataFrame:
    """Balanced weight of each row's class. There is one weight row per class, so Spark broadcasts it."""
    weights = class_weights(df, y).select(F.col("label").alias(y), F.col("weight").alias(out))
    return join_groups(df, weights, [y], measured=True)


def fit_tree(df: DataFrame, depth: int = 10, weight: str | None = "weight", seed: int = 42, **params):
    return _fit(DecisionTreeClassifier(maxDepth=depth, seed=seed, **params), df, weight)


def fit_forest(df: DataFrame, depth: int = 10, trees: int = 100, weight: str | None = "weight", seed: int = 42, **params):
    return _fit(RandomForestClassifier(maxDepth=depth, numTrees=trees, seed=seed, **params), df, weight)


def _fit(estimator, df: DataFrame, weight: str | None):
    if weight:
        estimator = estimator.setWeightCol(weight)
    # Fitting reads its rows several times; keep them for as long as it runs.
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(kept)
    finally:
        kept.unpersist()


def fit_bagged(
    df: DataFrame, weights: Sequence[Column], depth: int = 10, features: Sequence[Sequence[int]] | None = None, seed: int = 42, parallelism: int = 4, **params
) -> list[PipelineModel]:
    """A forest with given bags: tree ``t`` weighs a row by ``weights[t]`` and sees the features at ``features[t]``.

    A random forest draws its bags per partition, so that its trees depend on how the rows lie in files. Weights that
    are a function of the row (a hash of its key) give the same trees on every layout. Rows of weight 0, null or below
    are not in a bag; a bag without rows is an error."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    if not weights:
        raise ValueError("a forest needs at least one bag")
    if features is not None and len(features) != len(weights):
        raise ValueError("one list of features per bag")
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)

    def grow(t: int) -> PipelineModel:
        bag = kept.withColumn("__weight", weights[t].cast("double")).filter("__weight > 0")
        tree = DecisionTreeClassifier(maxDepth=depth, seed=seed, weightCol="__weight", rawPredictionCol="", predictionCol="", probabilityCol=f"__p{t}", **params)
        if features is None:
            return Pipeline(stages=[tree]).fit(bag)
        part = VectorSlicer(inputCol="features", outputCol=f"__features{t}", indices=list(features[t]))
        return Pipeline(stages=[part, tree.setFeaturesCol(f"__features{t}")]).fit(bag)

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            return list(pool.map(inheritable_thread_target(df.sparkSession)(grow), range(len(weights))))
    finally:
        kept.unpersist()


def vote(df: DataFrame, forest: Sequence[PipelineModel], cut: float = 0.5, out: str = "p1", votes: str = "votes") -> DataFrame:
    """Mean probability of the trees, and how many of them are above ``cut``. One pass over the rows."""
    names = df.columns
    for tree in forest:
        df = tree.transform(df)
    p = [vector_to_array(f"__p{t}")[1] for t in range(len(forest))]
    mean = sum(p[1:], p[0]) / len(p)
    above = [(x > cut).cast("int") for x in p]
    return df.select(*names, mean.alias(out), sum(above[1:], above[0]).alias(votes))


def positive_probability(df: DataFrame, c: str = "probability", out: str = "p1") -> DataFrame:
    return df.withColumn(out, vector_to_array(c)[1])


def score(
    df: DataFrame,
    make_model: Callable[[], Callable[[np.ndarray], np.ndarray]],
    shape: Sequence[int],
    c: str = "sequence",
    out: str = "prediction",
    batch: int = 1024,
    category: str | None = None,
) -> DataFrame:
    """Score ``n x f`` sequences. ``make_model`` loads the model once per Python worker and returns
    a function from a ``(rows, n, f)`` array to one value per row. Only the sequence column
    travels to Python; keys and dates stay in the JVM. With ``category`` (the place of the row's category, constant over
    a sequence) the function also gets an integer array of places, -1 where there is none."""

    def make_predict():
        model = make_model()

        def predict(x: np.ndarray) -> np.ndarray:
            return np.asarray(model(x), dtype=np.float64).reshape(len(x))

        def predict_placed(x: np.ndarray, place: np.ndarray) -> np.ndarray:
            return np.asarray(model(x, place.reshape(len(x)).astype(np.int64)), dtype=np.float64).reshape(len(x))

        return predict_placed if category else predict

    shapes = [list(shape), [1]] if category else [list(shape)]
    udf = predict_batch_udf(make_predict, return_type=T.DoubleType(), batch_size=batch, input_tensor_shapes=shapes)
    inputs = [F.flatten(c), F.array(F.coalesce(F.col(category), F.lit(-1)).cast("double"))] if category else [F.flatten(c)]
    return df.withColumn(out, udf(*inputs))


def tune(
    df: DataFrame, estimator, grid: Sequence[dict], y: str = "label", split_col: str = "split", parallelism: int = 4
) -> tuple[object, list[dict]]:
    """Fit every parameter set on ``train`` rows and keep the one with the best F1 on the rest.

    The split is chronological, so Spark's random ``TrainValidationSplit`` does not apply. The
    fits run side by side, and each candidate returns one row of scores.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    from riverframe.operators.metrics import binary_metrics

    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    train, held_out = kept.filter(F.col(split_col) == "train"), kept.filter(F.col(split_col) != "train")

    def trial(params: dict):
        model = estimator.copy({estimator.getParam(k): v for k, v in params.items()}).fit(train)
        f1 = binary_metrics(model.transform(held_out), y, "prediction").first()["f1"]
        return model, {**params, "f1": f1}

    spark = df.sparkSession
    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            trials = list(pool.map(inheritable_thread_target(spark)(trial), grid))
    finally:
        kept.unpersist()
    best = max(trials, key=lambda t: t[1]["f1"])
    return best[0], [t[1] for t in trials]
