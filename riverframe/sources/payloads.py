"""Landed API payloads to rows. Fetching is not this library's task: a client lands JSON, Spark
reads all of it at once."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverframe.functions.columns import from_epoch, nan_to_null, to_local
from riverframe.sources import schemas

PAGE_SIZE = 50


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.API_PAYLOAD).json(path)


def _stamp(position: str, tz: str | None) -> Column:
    utc = from_epoch(F.col("start") + F.col(position) * F.col("interval"))
    return to_local(utc, tz) if tz else utc


def expand_payload(payloads: DataFrame, tz: str | None = None, keys: Sequence[str] = ("location",)) -> DataFrame:
    """``(keys, datetime, variable, value)`` from start, end, interval and one array per variable.

    The time axis is half-open, ``[start, end)``: values beyond it are dropped. ``tz`` moves the
    UTC stamps to local wall-clock time.
    """
    return (
        _expanded(payloads, keys)
        .select(*keys, _stamp("pos", tz).alias("datetime"), F.col("code").alias("variable"), "value")
    )


def _expanded(payloads: DataFrame, keys: Sequence[str]) -> DataFrame:
    per_var = payloads.select(*keys, "start", "end", "interval", F.explode("vars").alias("var"))
    points = per_var.select(
        *keys, "start", "end", "interval", "var.code", "var.altitude", "var.member", F.posexplode("var.values")
    )
    in_range = F.col("start") + F.col("pos") * F.col("interval") < F.col("end")
    return points.filter(in_range).withColumn("value", nan_to_null(F.col("col").cast("double"))).drop("col")


def expand_ensemble(payloads: DataFrame, tz: str | None = None, keys: Sequence[str] = ("location",)) -> DataFrame:
    """``(keys, datetime, code, altitude, member, value)``, one row per variable and member."""
    return _expanded(payloads, keys).select(
        *keys, _stamp("pos", tz).alias("datetime"), "code", "altitude", "member", "value"
    )


def route_variables(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Name variables by (code, altitude); rows no lookup row names are dropped."""
    named = lookup.select("code", "altitude", "variable")
    return df.join(named, ["code", "altitude"], "inner").drop("code", "altitude")


def members_to_wide(df: DataFrame, variables: Sequence[str], members: Sequence[int], keys: Sequence[str] = ("location",), newest: str | None = None) -> DataFrame:
    """``{variable}_member{n}`` columns, as the wide files have them; the lists are given, not searched.

    Of repeated pulls the value with the largest ``newest`` counts; without such a column the largest value.
    """
    name = F.concat("variable", F.lit("_member"), F.col("member").cast("string"))
    columns = [f"{v}_member{m}" for v in variables for m in members]
    return (
        df.withColumn("__name", name)
        .groupBy(*keys, "datetime")
        .pivot("__name", columns)
        .agg(F.max("value") if newest is None else F.max_by("value", F.when(F.col("value").isNotNull(), F.col(newest))))
    )


def pick_member(df: DataFrame, variable: str, member: int | str = 0, keys: Sequence[str] = ("location",), out: str | None = None) -> DataFrame:
    """One series out of an ensemble: a member, or ``"mean"`` / ``"median"`` across members."""
    rows = df.filter(F.col("variable") == variable)
    out = out or variable
    if isinstance(member, int):
        return rows.filter(F.col("member") == member).select(*keys, "datetime", F.col("value").alias(out))
    fn = {"mean": F.avg, "median": F.median}[member]
    return rows.groupBy(*keys, "datetime").agg(fn("value").alias(out))


EARTH_KM = 6371.0088
KM_PER_DEGREE = EARTH_KM * math.pi / 180


def nearest_location(df: DataFrame, locations: DataFrame, within_km: float = 5.0) -> DataFrame:
    """Add ``location`` and ``distance_km`` of the nearest location within reach; NULL where there is none.

    Services answer with their grid point, so coordinates differ a little. The earth is cut into cells about as wide
    as the reach; a location is entered in every cell that its surroundings touch, so that a payload looks into its own
    cell only, on an edge as well, and neither drops out nor multiplies. Equally near ones: the first by name.
    Payloads without coordinates have no location.
    """
    size = within_km / KM_PER_DEGREE
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    # How many degrees the reach is to the east and to the west, at its widest.
    # Surroundings that hold a pole reach all the way round.
    narrow = F.least(F.lit(math.sin(math.radians(size))) / F.cos(F.radians(lat)), F.lit(1.0))
    east = F.when(F.abs(lat) + size < 90, F.degrees(F.asin(narrow))).otherwise(F.lit(180.0))
    cell = lambda c: F.floor(c / size)
    around = locations.select("location", lat.alias("__lat"), lon.alias("__lon"), east.alias("__east"), F.explode(F.array(F.lit(-360.0), F.lit(0.0), F.lit(360.0))).alias("__turn"))
    around = around.filter(F.col("__lat").isNotNull() & F.col("__lon").isNotNull())
    around = around.select("*", F.explode(F.sequence(cell(F.col("__lat") - size), cell(F.col("__lat") + size))).alias("__row"))
    turned = F.col("__lon") + F.col("__turn")
    around = around.filter(F.abs(turned) <= 180 + F.col("__east")).select("*", F.explode(F.sequence(cell(turned - F.col("__east")), cell(turned + F.col("__east")))).alias("__column"))
    # One row per cell, with the few locations near it.
    near = around.groupBy("__row", "__column").agg(F.collect_set(F.struct("location", "__lat", "__lon")).alias("__near"))

    def haversine(x: Column) -> Column:
        a = F.pow(F.sin(F.radians(x["__lat"] - lat) / 2), 2) + F.cos(F.radians(lat)) * F.cos(F.radians(x["__lat"])) * F.pow(F.sin(F.radians(x["__lon"] - lon) / 2), 2)
        return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))

    reached = F.filter(F.transform("__near", lambda x: F.struct(haversine(x).alias("distance_km"), x["location"].alias("location"))), lambda x: x["distance_km"] <= within_km)
    placed = df.withColumns({"__row": cell(lat), "__column": cell(lon)}).join(near, ["__row", "__column"], "left")
    best = placed.withColumn("__best", F.array_min(reached))
    return best.withColumns({"location": F.col("__best.location"), "distance_km": F.col("__best.distance_km")}).drop("__row", "__column", "__near", "__best")


def tag_location(df: DataFrame, locations: DataFrame, within_km: float = 5.0) -> DataFrame:
    """Payloads with the name of the nearest location; those too far from all are in :func:`untagged`."""
    return nearest_location(df, locations, within_km).filter(F.col("location").isNotNull()).drop("distance_km")


def untagged(df: DataFrame, locations: DataFrame, within_km: float = 5.0) -> DataFrame:
    """Payloads that no location is near to, to be looked at and counted."""
    return nearest_location(df, locations, within_km).filter(F.col("location").isNull()).drop("location", "distance_km")


def newest_payload(df: DataFrame, key_cols: Sequence[str], fetched_at: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """A later pull supersedes an earlier one for the same key.

    An aggregate, not a window: every task keeps one pull per key before the shuffle, so a key pulled often is no hot one."""
    rest = [c for c in df.columns if c not in key_cols]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(c) for c in (fetched_at, *tiebreak)])).alias("__newest")
    return df.groupBy(*key_cols).agg(newest).select(*[F.col(f"__newest.`{c}`" if c in rest else f"`{c}`").alias(c) for c in df.columns])


def read_pages(spark: SparkSession, path: str, schema: str = schemas.MET_LOCATIONS, results: str = "results") -> DataFrame:
    """All landed pages of a listing, one row per result."""
    return explode_results(spark.read.schema(schema).json(path), results)


def explode_results(pages: DataFrame, results: str = "results") -> DataFrame:
    return pages.select(F.explode(results).alias("__r")).select("__r.*")


def pages_complete(pages: DataFrame, results: str = "results", offset: str = "offset", page_size: int = PAGE_SIZE) -> DataFrame:
    """Whether the landed pages are the whole listing: no hole, and a short or empty last page."""
    size = F.size(results)
    facts = pages.agg(
        F.max(offset).alias("last_offset"),
        F.countDistinct(offset).alias("n_pages"),
        F.max_by(size, F.col(offset)).alias("last_size"),
    )
    no_hole = F.col("n_pages") == F.floor(F.col("last_offset") / page_size) + 1
    return facts.select("n_pages", "last_offset", (no_hole & (F.col("last_size") < page_size)).alias("complete"))


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs to flat columns, ``a.b`` becoming ``a_b``, at any depth."""
    def leaves(fields, path: tuple[str, ...]):
        for f in fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType.fields, here)
            else:
                yield here

    paths = list(leaves(df.schema.fields, ()))
    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in paths])
