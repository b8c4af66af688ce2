"""A late pull, and tables whose order is proved: what files hold afterwards, against a rebuild in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverframe.plans import incremental as L
from riverframe.sources import tables as files
from riverframe.workload import oracles as Q
from riverframe.workload import tables as T
from riverframe.workload.cases import case, scratch
from riverframe.workload.queries import rounded

FEATURES = ["rain_sum_mm", "rain_max_1h", "rain_sum_lag_1", "rain_sum_lag_7", "rain_sum_roll3", "rain_sum_roll14", "rain_delta_1d", "rain_ema_3", "rain_ema_7", "rain_api_7d"]
AVERAGES = {"rain_ema_3": 0.5, "rain_ema_7": 0.25, "rain_api_7d": 0.2}

# The last pull of every reading: orders of one kind in January 1998 never came.
LATE = f"""rain AS (
  SELECT o_orderpriority AS location, CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice / 9973.0), 11) AS rain_sum_mm, max(o_totalprice / 9973.0) AS rain_max_1h
  FROM orders WHERE NOT (o_orderkey % 13 = 5 AND year(o_orderdate) = 1998 AND month(o_orderdate) = 1) GROUP BY 1, 2),
{Q.ema_cte('rain', 'rain_sum_mm', AVERAGES, 'date')},
f AS (SELECT *, lag(rain_sum_mm, 1) OVER {Q.W} AS rain_sum_lag_1, lag(rain_sum_mm, 7) OVER {Q.W} AS rain_sum_lag_7, sum(rain_sum_mm) OVER {Q.over(3)} AS rain_sum_roll3,
  sum(rain_sum_mm) OVER {Q.over(14)} AS rain_sum_roll14, coalesce(rain_sum_mm - lag(rain_sum_mm, 1) OVER {Q.W}, 0) AS rain_delta_1d FROM numbered)"""


def _late(spark, sf):
    """Three pulls: history with wrong and missing readings, an unchanged one, and a late one of the days since February 1998."""
    orders = T.load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("location"), F.col("o_orderdate").alias("datetime"), "o_orderkey", (F.col("o_totalprice") / 9973.0).alias("rain")
    ).where(~((F.col("o_orderkey") % 13 == 5) & (F.year("datetime") == 1998) & (F.month("datetime") == 1)))
    stamp = lambda day: F.lit(day).cast("timestamp_ntz").alias("pulled_at")
    wrong = F.when((F.col("o_orderkey") % 10 == 1) & (F.col("datetime") >= "1998-02-01"), F.col("rain") * 3).otherwise(F.col("rain")).alias("rain")
    early = orders.where((F.col("datetime") < "1998-06-01") & ~((F.col("o_orderkey") % 7 == 2) & (F.col("datetime") >= "1998-02-01")))
    store = L.Store(spark, scratch(spark, "late"), ("location", "datetime", "o_orderkey"), digits=T.DIGITS)
    L.late_pull(store, early.select("location", "datetime", "o_orderkey", wrong, stamp("1998-06-01")))
    repeated = L.late_pull(store, early.where("datetime < '1995-01-01'").select("location", "datetime", "o_orderkey", "rain", stamp("1998-06-02")))
    late = L.late_pull(store, orders.where("datetime >= '1998-02-01'").select("location", "datetime", "o_orderkey", "rain", stamp("1998-08-01")))
    return store, repeated, late


@case(f"WITH RECURSIVE {LATE} SELECT f.location, f.date, f.pos AS position, {Q.r(*FEATURES)} FROM f JOIN ema USING (location, pos)")
def features_after_late_pull(spark, sf):
    """Features after a late pull, equal to a rebuild from the newest readings."""
    store, _, _ = _late(spark, sf)
    return rounded(store.read("features").select("location", "date", "position", *FEATURES))


@case("""WITH m AS (SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month FROM orders WHERE o_orderdate >= TIMESTAMP '1998-02-01')
SELECT t AS "table", month FROM m, (VALUES ('readings'), ('days'), ('features')) v(t)
UNION ALL SELECT DISTINCT 'readings, repeated', CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01'""")
def months_of_late_pull(spark, sf):
    """The months that the late pull wrote; a pull that changed nothing writes its readings alone."""
    _, repeated, late = _late(spark, sf)
    rows = [(t, m) for t, months in late.months.items() for m in months] + [(f"{t}, repeated", m) for t, months in repeated.months.items() for m in months]
    return spark.createDataFrame(rows, "table string, month int")


@case(f"""WITH {Q.RAIN}, k AS (SELECT CAST(year(date) AS INTEGER) AS year, struct_pack(location := location, date := date) AS k FROM rain)
SELECT year, count(*) AS n_rows, min(k).location AS first_location, min(k).date AS first_date, max(k).location AS last_location, max(k).date AS last_date, true AS sorted, true AS apart FROM k GROUP BY 1""")
def sorted_sink_check(spark, sf):
    """A table written by year, sorted by location and day: what the rows of its files, in their order, say."""
    path = scratch(spark, "sorted")
    files.write_table(T.rain_daily(spark, sf).withColumn("year", F.year("date")), path, partition_by=["year"], sort_by=["location", "date"])
    report = files.order_report(spark, path, ["location", "date"], ["year"])
    return files.order_summary(report, ["location", "date"], ["year"])


@case(f"""WITH {Q.RAIN}, k AS (SELECT struct_pack(date := date, location := location) AS k FROM rain)
SELECT count(*) AS n_rows, min(k).date AS first_date, min(k).location AS first_location, max(k).date AS last_date, max(k).location AS last_location, true AS sorted, true AS apart FROM k""")
def sorted_table_check(spark, sf):
    """A table in one order over all its files."""
    path = scratch(spark, "sorted")
    files.write_table(T.rain_daily(spark, sf), path, sort_by=["date", "location"])
    return files.order_summary(files.order_report(spark, path, ["date", "location"]), ["date", "location"])


@case(Q.ORACLES["model_comparison"])
def model_comparison_round_trip(spark, sf):
    """The comparison of models as written to its file and read again."""
    from riverframe.workload.queries import REGISTRY

    path = scratch(spark, "comparison")
    files.write_metrics(REGISTRY["model_comparison"](spark, sf), path)
    return files.read_metrics(spark, path)
