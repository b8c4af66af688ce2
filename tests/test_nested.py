"""JSON of unknown shape."""

import pytest

from riverframe.sources import nested as N


@pytest.fixture
def texts(spark):
    rows = [
        (1, '{"a": {"b": {"c": 1, "d": "x"}}, "l": [{"p": 1.5, "q": [{"r": 1}]}, {"p": 2, "q": [{"r": 2}, {"s": "t"}]}], "odd name": true}'),
        (2, '{"a": {"b": {"c": 2.5}}, "l": [], "z": null, "mixed": 1}'),
        (3, '{"mixed": {"x": 1}}'),
        (4, "no json"), (5, None), (6, "[1, 2]"), (7, "{}"), (8, "3"),
    ]
    return spark.createDataFrame(rows, "id int, j string").repartition(3)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["id"], []).append(r.asDict(True))
    return out


def test_shape_merges_all_rows(texts):
    shape = {f.name: f.dataType.simpleString() for f in N.shape_of(texts, "j").fields}
    assert shape["a"] == "struct<b:struct<c:double,d:string>>" and shape["odd name"] == "boolean"
    assert shape["l"] == "array<struct<p:double,q:array<struct<r:bigint,s:string>>>>" and shape["mixed"] == shape["z"] == "string"


def test_fields_become_columns(texts):
    flat = N.flatten_json(texts, "j", ["id"])
    assert set(flat.columns) == {"id", "a_b_c", "a_b_d", "l", "mixed", "odd name", "z"}
    rows = by_id(flat)
    assert (rows[1][0]["a_b_c"], rows[1][0]["a_b_d"], rows[1][0]["odd name"], rows[2][0]["a_b_c"]) == (1.0, "x", True, 2.5)
    assert rows[2][0]["mixed"] == "1" and rows[3][0]["mixed"] == '{"x":1}'
    assert all(v is None for i in (4, 5, 6, 7, 8) for k, v in rows[i][0].items() if k != "id") and len(rows) == 8


def test_lists_become_rows_one_in_another(texts):
    rows = by_id(N.flatten_json(texts, "j", ["id"], ["l", "l.q"], sep="."))
    inner = sorted((r["l.at"], r["l.p"], r["l.q.at"], r["l.q.r"], r["l.q.s"]) for r in rows[1] if r["l.q.at"] is not None)
    assert [(a, p, b) for a, p, b, _, _ in inner] == [(0, 1.5, 0), (1, 2.0, 0), (1, 2.0, 1)] and inner[2][4] == "t"
    assert all(len(rows[i]) == 1 and rows[i][0]["l.at"] is None for i in (2, 3, 4, 5, 6, 7, 8))


def test_a_given_shape_saves_the_pass_and_wrong_types_are_missing(spark, texts):
    from pyspark.sql import types as T

    shape = T._parse_datatype_string("a struct<b: struct<d: string>>, mixed bigint")
    rows = by_id(N.flatten_json(texts, "j", ["id"], shape=shape))
    assert rows[1][0]["a_b_d"] == "x" and rows[2][0]["mixed"] == 1


def test_what_is_no_record_is_counted(texts, spark):
    assert {r["reason"]: r["n"] for r in N.invalid_json(texts, "j").collect()} == {"missing": 1, "no JSON": 1, "no object": 2}
    empty = spark.createDataFrame([(1, "[]"), (2, None)], "id int, j string")
    assert [r["id"] for r in N.flatten_json(empty, "j", ["id"]).collect()] == [1, 2]
    assert N.flatten_json(empty.limit(0), "j", ["id"]).collect() == []


def test_paths_that_are_not_there(texts):
    with pytest.raises(ValueError, match="is no list"):
        N.flatten_json(texts, "j", ["id"], ["a"])
    with pytest.raises(ValueError, match="no field"):
        N.flatten_json(texts, "j", ["id"], ["nothing"])
