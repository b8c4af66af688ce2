"""Windows cut from rows that travel once, against the table of sequences."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverframe.operators import blocks as B, models, sequences as S
from riverframe.plans import scoring

K = ["location"]
N = 5


@pytest.fixture(scope="module")
def table(spark):
    """Keys of 0 to 700 rows, one without a name, one whose name starts like another's; missing features; two kinds of rows."""
    rows = []
    for key, m in (("long", 700), ("longer", 40), ("five", 5), ("six", 6), ("one", 1), (None, 30)):
        for i in range(m):
            rows.append((key, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i * i % 17), None if i % 11 == 3 else float(i), "forecast" if i % 3 == 0 else "historical", i % 4 if key else None))
    return spark.createDataFrame(rows, "location string, date date, a double, b double, kind string, place int").repartition(7)


def weighted():
    def make():
        return lambda x: (np.nan_to_num(x) * np.arange(1, x.shape[1] * x.shape[2] + 1).reshape(1, x.shape[1], x.shape[2])).sum(axis=(1, 2))

    return make


def by_day(df, c="prediction"):
    return {(r["location"], r["date"]): r[c] for r in df.collect()}


@pytest.mark.parametrize("chunk", [0, 1, 64])
def test_scores_are_those_of_the_sequences(table, chunk):
    copied = models.score(S.sequences(table.fillna(0.0, ["b"]), K, "date", ["a", "b"], N, chunk=0), weighted(), (N, 2))
    want = by_day(copied)
    got = by_day(B.score_rows(table, K, "date", ["a", "b"], N, weighted(), chunk=chunk, batch=13))
    assert got == pytest.approx(want) and len(got) == 695 + 35 + 1 + 25


def test_batches_of_any_size_see_the_rows_before(spark, table):
    want = by_day(B.score_rows(table, K, "date", ["a", "b"], N, weighted(), chunk=0))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("1", "3", "7"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert by_day(B.score_rows(table, K, "date", ["a", "b"], N, weighted(), chunk=0)) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("chunk", [0, 64])
def test_only_wanted_rows_are_scored_and_places_travel(table, chunk):
    def make():
        return lambda x, place: x[:, -1, 0] * 10 + place

    got = by_day(B.score_rows(table, K, "date", ["a"], N, make, wanted=F.col("kind") == "forecast", category="place", chunk=chunk))
    rows = sorted((r for r in table.collect()), key=lambda r: (str(r["location"]), r["date"]))
    want = {}
    for i, r in enumerate(rows):
        if i >= N and rows[i - N]["location"] == r["location"] and r["kind"] == "forecast":
            want[r["location"], r["date"]] = rows[i - 1]["a"] * 10 + (-1 if r["place"] is None else r["place"])
    assert got == want


@pytest.mark.parametrize("n", [2, 14])
def test_each_row_goes_to_python_once(spark, table, n):
    """Whatever the length of the sequences; the model itself tells how many windows it saw."""
    sent = spark.sparkContext.accumulator(0)
    plain = B._scorer

    def counting(*args):
        run = plain(*args)

        def counted(batches):
            def watched():
                for b in batches:
                    sent.add(b.column("__x").flatten().__len__())
                    yield b

            return run(watched())

        return counted

    try:
        B._scorer = counting
        rows = B.score_rows(table, K, "date", ["a", "b"], n, weighted(), chunk=0).collect()
    finally:
        B._scorer = plain
    assert sent.value == 2 * table.count() and len(rows) > 700


def test_score_forecast_sends_no_sequences(table):
    plan = scoring.score_forecast(table.fillna(0.0), ["a", "b"], None, weighted(), N)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "MapInArrow" in plan and plan.count("Exchange hashpartitioning") == 1


def test_stored_blocks_hold_every_window(table):
    full = table.fillna(0.0, ["b"])
    want = {(r["location"], r["date"]): (r["sequence"], r["kind"]) for r in S.sequences(full, K, "date", ["a", "b"], N, "kind", chunk=0).collect()}
    found, stored = {}, 0
    for r in B.sequence_blocks(full, K, "date", ["a", "b"], N, "kind", size=32, chunk=0).collect():
        views = B.windows_of(r["x"], N, 2, r["n_windows"])
        assert views.shape == (r["n_windows"], N, 2) and len(r["stamps"]) == r["n_windows"] <= 32 and r["n_before"] <= N
        stored += len(r["x"]) // 2
        found |= {(r["location"], day): (v.tolist(), y) for day, v, y in zip(r["stamps"], views, r["labels"], strict=True)}
    assert found == want
    assert stored <= (1 + N / 32) * 776 + 6 * N


def test_empty_tables(table):
    none = table.limit(0)
    assert B.score_rows(none, K, "date", ["a"], N, weighted(), chunk=0).collect() == []
    assert B.sequence_blocks(none, K, "date", ["a"], N, chunk=0).collect() == []
