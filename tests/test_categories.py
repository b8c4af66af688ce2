"""The sparse category block against one column per category."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from riverframe.operators import categories as K, scaling
from riverframe.plans.run import RunConfig, run
from riverframe.sources import tables

NAMES = ["Kuala", "Klang", "Petaling", "Ampang", "Ümlaut", "a", "10", "9"]


@pytest.fixture(scope="module")
def keys(spark):
    data = [(i, None if i % 7 == 0 else NAMES[(i * i) % 8]) for i in range(200)]
    return spark.createDataFrame(data, "id int, location string").repartition(5)


def test_places_are_alphabetical_ranks(keys):
    found = K.fit_categories(keys, "location")
    rows = found.table.orderBy("index").collect()
    used = sorted({r["location"] for r in keys.collect()} - {None}, key=lambda s: s.encode())
    assert [r["category"] for r in rows] == used and [r["index"] for r in rows] == list(range(len(used))) and found.size == len(used)
    assert sum(r["n"] for r in rows) == keys.dropna().count()


def test_block_equals_scaled_columns(keys):
    """Cold values plus the sparse block are the standardized 0/1 columns."""
    found = K.fit_categories(keys, "location")
    names = [r["category"] for r in found.table.orderBy("index").collect()]
    cold = np.array([r["cold"] for r in found.table.orderBy("index").collect()])
    dense = scaling.standardize(scaling.one_hot(keys, "location", names), [f"loc_{n}" for n in names])
    want = {r["id"]: [r[f"loc_{n}"] for n in names] for r in dense.collect()}
    for r in K.one_hot_sparse(keys, "location", found, scaled=True).collect():
        x = cold.copy()
        x[r["location_hot"]["indices"]] += r["location_hot"]["values"]
        assert r["location_hot"]["size"] == len(names) and x == pytest.approx(want[r["id"]], abs=1e-9)
    assert K.cold_sum(found) == pytest.approx(cold.sum())
    weights = found.table.select("category", (F.col("index") * 2.0).alias("weight"))
    assert K.cold_sum(found, weights) == pytest.approx((cold * 2 * np.arange(len(cold))).sum())


def test_unknown_and_missing_keys_have_empty_blocks(spark, keys):
    found = K.fit_categories(keys, "location")
    new = spark.createDataFrame([("nowhere",), (None,), ("Klang",)], "location string")
    blocks = {r["location"]: r["location_hot"] for r in K.one_hot_sparse(new, "location", found).collect()}
    assert blocks["nowhere"]["indices"] == blocks[None]["indices"] == [] and blocks["Klang"]["values"] == [1.0]
    assert {r["location"]: r["loc_index"] is None for r in K.with_index(new, "location", found).collect()} == {"nowhere": True, None: True, "Klang": False}


def test_edges(spark):
    empty = K.fit_categories(spark.createDataFrame([], "location string"), "location")
    assert empty.size == 0 and empty.table.collect() == []
    only = K.fit_categories(spark.createDataFrame([("x",), ("x",)], "location string"), "location")
    assert tuple(only.table.first())[1:] == (0, 2, 1.0, 1.0, -1.0)


def test_numbers_as_keys_and_round_trip(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") % 700).alias("k"))
    found = K.fit_categories(df, "k")
    found.save(str(tmp_path / "c"))
    again = K.load_categories(spark, str(tmp_path / "c"))
    assert again.size == 700 and sorted(map(tuple, again.table.collect())) == sorted(map(tuple, found.table.collect()))
    places = {r["k"]: r["loc_index"] for r in K.with_index(df, "k", again).collect()}
    assert places == {int(s): i for i, s in enumerate(sorted(str(k) for k in range(700)))}


def test_sparse_vectors_train_like_dense_columns(spark, keys):
    found = K.fit_categories(keys, "location")
    names = [r["category"] for r in found.table.orderBy("index").collect()]
    rows = K.with_index(keys, "location", found).withColumns({"dense": F.array(F.col("id") / 100.0, F.lit(1.5)), "label": ((F.col("id") % 3 == 0) | (F.col("location") == "Klang")).cast("int")}).fillna(0, ["label"])
    sparse = K.sparse_features(rows, "dense", 2, found.size)
    assert sparse.first()["features"].size == 2 + found.size
    from pyspark.ml.functions import array_to_vector

    columns = scaling.one_hot(rows, "location", names)
    dense = columns.withColumn("features", array_to_vector(F.concat("dense", F.array(*[F.col(f"loc_{n}").cast("double") for n in names]))))
    fit = LogisticRegression(regParam=0.1, tol=1e-10, maxIter=200)
    a, b = fit.fit(sparse), fit.fit(dense)
    assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), abs=1e-6) and a.intercept == pytest.approx(b.intercept, abs=1e-6)


def test_whole_run_with_more_locations_than_columns(spark, tmp_path):
    """230 locations: features, training set, categories and scores, with places instead of columns."""
    n = 230
    hours = spark.range(n * 30).selectExpr("concat('site-', id div 30) AS location", "cast(date_add(date'2024-01-01', int(id % 30)) AS string) AS datetime", "double((id * 37) % 11) AS rain")
    for name, first, last in (("w", 0, 24), ("p", 24, 30)):
        hours.filter(F.dayofmonth("datetime").between(first + 1, last)).withColumn("datetime", F.concat("datetime", F.lit(" 12:00:00"))).select("datetime", "rain", "location").coalesce(1).write.option("header", True).csv(str(tmp_path / name))
    hours.filter(F.dayofmonth("datetime") <= 24).selectExpr("datetime AS date", "rain * 3 AS river_discharge_m3s", "location").coalesce(1).write.option("header", True).csv(str(tmp_path / "f"))

    def model():
        return lambda x, place: x[:, -1, 0] * 0 + place

    out = str(tmp_path / "out")
    training = run(spark, RunConfig(str(tmp_path / "w"), str(tmp_path / "f"), out, str(tmp_path / "p"), sequence_length=5), model)
    order = tables.read_feature_list(spark, f"{out}/feature_columns")
    assert order[-1] == "loc[*]" and not any(c.startswith("loc_") for c in order)
    found = K.load_categories(spark, f"{out}/categories")
    place = {r["category"]: r["index"] for r in found.table.collect()}
    assert found.size == n and place == {s: i for i, s in enumerate(sorted(place))}
    assert {r["n"] for r in found.table.collect()} == {30}, "rows of the feature table"
    scored = spark.read.parquet(f"{out}/flood_forecast").collect()
    assert len(scored) == n * 6 and all(r["predicted_discharge"] == place[r["location"]] for r in scored)
    sequences = training.sequences
    assert K.INDEX in sequences.columns and sequences.filter(F.col(K.INDEX).isNull()).count() == 0
    assert len(sequences.first()["sequence"][0]) == len(order) - 1
