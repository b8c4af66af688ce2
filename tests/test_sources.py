"""Payloads, pages, tables and artifacts on landed files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from riverframe.sources import payloads as P
from riverframe.sources import schemas, tables


def land(path, *records):
    path.mkdir()
    for i, r in enumerate(records):
        (path / f"{i}.json").write_text(json.dumps(r))
    return str(path)


def payload(fetched="2024-01-01T00:00:00Z", start=1704067200, hours=3, lat=3.1107, lon=101.6089, values=(1.0, None, 2.5, 9.0)):
    return {"source": "archive", "fetched_at": fetched, "latitude": lat, "longitude": lon, "start": start,
            "end": start + hours * 3600, "interval": 3600,
            "vars": [{"code": "rain", "altitude": 0, "member": 0, "values": list(values)},
                     {"code": "rain", "altitude": 0, "member": 1, "values": [3.0, 4.0, 5.0]},
                     {"code": "temperature", "altitude": 2, "member": 0, "values": [20.0, 21.0, 22.0]},
                     {"code": "unknown", "altitude": 7, "member": 0, "values": [0.0]}]}


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame(list(schemas.STATIONS), schemas.LOCATIONS)


def test_expand_payload(spark, stations, rows, tmp_path):
    raw = P.read_payloads(spark, land(tmp_path / "p", payload()))
    # The service answers with its grid point, a few hundred metres off.
    located = P.tag_location(raw, stations, within_km=2.0)
    assert rows(located, "location") == [("Petaling",)]
    rain = P.expand_payload(located, "Asia/Kuala_Lumpur").filter("variable = 'rain' AND value <> 4")
    # Half-open axis: the fourth value lies beyond the end. UTC midnight is 8:00 local.
    assert rows(rain.filter("value < 3"), "datetime", "value") == [
        (dt.datetime(2024, 1, 1, 8), 1.0), (dt.datetime(2024, 1, 1, 10), 2.5)]
    assert P.expand_payload(located).count() == 3 + 3 + 3 + 1


def test_ensemble(spark, stations, rows, tmp_path):
    located = P.tag_location(P.read_payloads(spark, land(tmp_path / "p", payload())), stations)
    lookup = spark.sql("SELECT 'rain' AS code, 0 AS altitude, 'rain' AS variable UNION ALL SELECT 'temperature', 2, 'temperature_2m'")
    long = P.route_variables(P.expand_ensemble(located), lookup)
    assert {r.variable for r in long.collect()} == {"rain", "temperature_2m"}
    wide = P.members_to_wide(long.filter("variable = 'rain'"), ["rain"], [0, 1])
    assert rows(wide, "rain_member0", "rain_member1") == [(1.0, 3.0), (2.5, 5.0), (None, 4.0)]
    assert rows(P.pick_member(long, "rain", 1), "rain") == [(3.0,), (4.0,), (5.0,)]
    assert rows(P.pick_member(long, "rain", "mean"), "rain") == [(2.0,), (3.75,), (4.0,)]


def test_newest_payload_wins(spark, stations, rows, tmp_path):
    path = land(tmp_path / "p", payload(), payload("2024-01-02T00:00:00Z", values=(7.0, 8.0, 9.0, 0.0)))
    located = P.tag_location(P.read_payloads(spark, path), stations)
    long = P.expand_payload(located, keys=["location", "fetched_at"]).filter("variable = 'rain' AND value > 5.5")
    assert rows(P.newest_payload(long, ["location", "datetime"], "fetched_at"), "value") == [(7.0,), (8.0,), (9.0,)]


def test_pages(spark, rows, tmp_path):
    def page(offset, n):
        return {"offset": offset, "results": [{"locationid": f"L{offset + i}", "locationname": "x"} for i in range(n)]}

    whole = land(tmp_path / "whole", page(0, 50), page(50, 50), page(100, 7))
    assert P.read_pages(spark, whole).select("locationid").distinct().count() == 107
    schema = schemas.MET_LOCATIONS

    def complete(path):
        return P.pages_complete(spark.read.schema(schema).json(path)).first().complete

    assert complete(whole)
    assert not complete(land(tmp_path / "hole", page(0, 50), page(100, 7)))
    assert not complete(land(tmp_path / "cut", page(0, 50), page(50, 50)))
    assert complete(land(tmp_path / "empty_end", page(0, 50), page(50, 0)))


def test_flatten(spark, tmp_path):
    record = {"results": [{"locationname": "Klang", "date": "2024-01-01", "datatype": "FMAXT", "value": "33",
                           "attributes": {"unit": "C"}, "latitude": 3.0, "longitude": 101.4}]}
    raw = spark.read.schema(schemas.MET_RESULTS).json(land(tmp_path / "m", record))
    flat = P.flatten_struct(P.explode_results(raw))
    assert flat.columns == ["locationname", "date", "datatype", "value", "attributes_unit", "latitude", "longitude"]
    assert flat.first().attributes_unit == "C"
    deep = spark.range(1).select(F.struct(F.struct(F.lit(1).alias("c")).alias("b.x")).alias("a"))
    assert P.flatten_struct(deep).columns == ["a_b.x_c"]


def test_tables(spark, rows, tmp_path):
    src = tmp_path / "w.csv"
    src.write_text("datetime,rain,location\n2024-01-01 00:00:00,NaN, Klang\n2024-01-01 01:00:00,,Klang\n2024-01-01 02:00:00,1.5,Klang\n")
    df = tables.read_table(spark, str(src), schemas.WEATHER_HOURLY)
    assert rows(df, "rain") == [(1.5,), (None,), (None,)]
    tables.write_table(df, str(tmp_path / "out"), partition_by=["location"], sort_by=["datetime"])
    assert tables.read_table(spark, str(tmp_path / "out"), fmt="parquet").count() == 3
    tables.write_table(df, str(tmp_path / "csv"), fmt="csv", sort_by=["datetime"])
    assert tables.read_table(spark, str(tmp_path / "csv"), schemas.WEATHER_HOURLY).count() == 3
    with pytest.raises(ValueError):
        tables.read_table(spark, str(src))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_table(spark, str(tmp_path / "none"), schemas.WEATHER_HOURLY)
    wrong = tmp_path / "x.csv"
    wrong.write_text("when,rain,location\n1,2,3\n")
    with pytest.raises(Exception):
        tables.read_table(spark, str(wrong), schemas.WEATHER_HOURLY).collect()


def test_artifacts(spark, rows, tmp_path):
    names = ["b", "a", "c"]
    tables.write_feature_list(spark, names, str(tmp_path / "f"))
    assert tables.read_feature_list(spark, str(tmp_path / "f")) == names
    scores = spark.createDataFrame([("CNN", 0.9, 0.2, 0.1, 0.1)], "Model string, Accuracy double, Precision double, Recall double, `F1-Score` double")
    tables.write_metrics(scores, str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).columns[-1] == "F1-Score"
    with pytest.raises(ValueError):
        tables.write_metrics(scores.drop("Recall"), str(tmp_path / "n"))


def test_locations_by_distance(spark):
    """Two stations in one former cell: the nearer one wins, a payload just across an edge is found, none is lost."""
    stations = spark.createDataFrame([("a", 3.1052, 101.60), ("b", 3.1098, 101.60), ("pole", 89.999, 10.0), ("date line", 0.0, 179.999)], "location string, latitude double, longitude double")
    calls = [(1, 3.1051, 101.60), (2, 3.1049, 101.60), (3, 3.1099, 101.6001), (4, 3.2, 101.6), (5, None, 1.0), (6, 89.9995, -170.0), (7, 0.001, -179.9995)]
    df = spark.createDataFrame(calls, "id int, latitude double, longitude double")
    found = {r["id"]: r["location"] for r in P.nearest_location(df, stations, 1.0).collect()}
    assert found == {1: "a", 2: "a", 3: "b", 4: None, 5: None, 6: "pole", 7: "date line"}
    assert {r["id"] for r in P.untagged(df, stations, 1.0).collect()} == {4, 5}
    assert P.tag_location(df, stations, 1.0).columns == ["id", "latitude", "longitude", "location"]


def test_settled_tables_go(spark):
    import os

    from riverframe.operators import settle as settle_module
    from riverframe.session import checkpoint_dir

    with settle_module.settled(spark):
        df = settle_module.settle(spark.range(5), "gone-after")
        assert df.count() == 5
    assert not [n for n in os.listdir(checkpoint_dir(spark).removeprefix("file://")) if n.startswith("gone-after")]


def test_forecast_files_of_three_forms(spark, rows, tmp_path):
    from riverframe.plans.run import RunConfig, found_locations, load_inputs

    def land_csv(name, header, lines):
        (tmp_path / name).write_text("\n".join([header, *lines]) + "\n")
        return str(tmp_path / name)

    weather = land_csv("w.csv", "datetime,rain,location", ["2024-01-01 00:00:00,1.0,Klang", "2024-01-01 06:00:00,2.0, Petaling "])
    flood = land_csv("f.csv", "date,river_discharge_m3s,location", ["2024-01-01,5.0,Klang"])
    wide = land_csv("m.csv", "datetime,location,rain_member0,rain_member1", ["2024-01-02 00:00:00,Klang,1.0,3.0", "2024-01-02 06:00:00,Klang,,5.0"])
    days = land_csv("d.csv", "date,rain,location", ["2024-01-02,4.0,Kajang"])
    read = lambda **how: load_inputs(spark, RunConfig(weather, flood, "out", **how))
    hourly, forecast, _ = read(weather_forecast=wide, member=1)
    assert rows(forecast, "location", "rain") == [("Klang", 3.0), ("Klang", 5.0)]
    assert rows(read(weather_forecast=wide, member="mean")[1], "rain") == [(2.0,), (5.0,)]
    daily = read(weather_forecast=days)[1]
    assert rows(daily, "location", "rain", "datetime") == [("Kajang", 4.0, dt.datetime(2024, 1, 2))]
    assert found_locations(hourly, daily) == ["Kajang", "Klang", "Petaling"]


def test_newest_payload_is_an_aggregate(spark, rows):
    data = [("a", 1, None, {"k": 1}), ("a", 2, 5, {"k": 2}), ("a", 3, 5, {"k": 3}), (None, 4, 1, None), (None, 5, 0, None), ("b", 6, None, {})]
    df = spark.createDataFrame(data, "key string, `the.id` int, fetched int, body map<string,int>")
    newest = P.newest_payload(df, ["key"], "fetched", ["`the.id`"])
    assert newest.columns == df.columns
    assert [r[1] for r in sorted(newest.collect(), key=lambda r: r[1])] == [3, 4, 6]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan
    assert P.newest_payload(df.limit(0), ["key"], "fetched").collect() == []
