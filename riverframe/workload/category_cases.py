"""Queries of the sparse category block: customers as locations, far more than a table has columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverframe.operators import categories as K
from riverframe.operators.resample import resample
from riverframe.plans import features, scoring
from riverframe.workload import oracles as Q
from riverframe.workload import tables as T
from riverframe.workload.cases import case
from riverframe.workload.queries import rounded

# A third of the orders has no customer here.
SOME = """named AS (SELECT o_orderkey, CASE WHEN o_custkey % 3 > 0 THEN o_custkey END AS o_custkey FROM orders)"""
TABLE = f"""{SOME}, total AS (SELECT count(*) AS rows FROM named),
counted AS (SELECT CAST(o_custkey AS VARCHAR) AS category, count(*) AS n FROM named WHERE o_custkey IS NOT NULL GROUP BY 1),
placed AS (SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS index, n, n / rows AS mean FROM counted, total),
cats AS (SELECT *, CASE WHEN mean = 1 THEN 1 ELSE sqrt(mean * (1 - mean)) END AS scale FROM placed)"""


def _some(spark, sf):
    return T.load(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")).alias("o_custkey"))


@case(f"WITH {TABLE} SELECT category, index, n, round(mean, 9) AS mean, round(scale, 9) AS scale, round(-mean / scale, 9) AS cold FROM cats")
def category_table(spark, sf):
    return rounded(K.fit_categories(_some(spark, sf), "o_custkey").table, 9)


@case(f"""WITH {TABLE}, size AS (SELECT CAST(count(*) AS INTEGER) AS size FROM cats)
SELECT o_orderkey, size, index, round(1 / scale, 6) AS difference, CASE WHEN index IS NULL THEN NULL ELSE 1.0::DOUBLE END AS hot
FROM named CROSS JOIN size LEFT JOIN cats ON CAST(o_custkey AS VARCHAR) = category""")
def one_hot_sparse(spark, sf):
    """The block of every order, plain and scaled."""
    rows = _some(spark, sf)
    found = K.fit_categories(rows, "o_custkey")
    plain = K.one_hot_sparse(rows, "o_custkey", found, "plain")
    both = K.one_hot_sparse(plain, "o_custkey", found, "scaled", scaled=True)
    first = lambda c: F.get(F.col(c), 0)
    return both.select("o_orderkey", "plain.size", first("plain.indices").alias("index"), F.round(first("scaled.values"), 6).alias("difference"), first("plain.values").alias("hot"))


CUSTOMER_DAYS = """days AS (SELECT 'c' || o_custkey AS location, CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice / 9973.0), 11) AS rain_sum_mm FROM orders GROUP BY 1, 2),
cats AS (SELECT location, row_number() OVER (ORDER BY location) - 1 AS index FROM (SELECT DISTINCT location FROM days))"""


def _customer_days(spark, sf):
    orders = T.load(spark, sf, "orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("location"), F.col("o_orderdate").alias("datetime"), (F.col("o_totalprice") / 9973.0).alias("rain"))
    return resample(orders, ["location"], "datetime", {"rain_sum_mm": ("sum", "rain")}, n_obs=None, digits=T.DIGITS)


def placed_model():
    """A stand-in model that reads the sequence and the place of its location."""

    def make():
        return lambda x, place: x[:, :, 0].mean(axis=1) + place * 0.001

    return make


@case(f"""WITH {CUSTOMER_DAYS}, w AS (SELECT location, date, count(*) OVER p AS n, avg(rain_sum_mm) OVER p AS before FROM days
  WINDOW p AS (PARTITION BY location ORDER BY date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
scored AS (SELECT location, date, before + index * 0.001 AS predicted_discharge FROM w JOIN cats USING (location) WHERE n = 3)
SELECT location, date, round(predicted_discharge, 6) AS predicted_discharge, {Q.PREDICTED_RISK} AS flood_risk FROM scored""")
def score_forecast_sparse(spark, sf):
    """Every customer a location: the model gets sequences and places."""
    days = _customer_days(spark, sf)
    placed = K.with_index(days, "location", K.fit_categories(days, "location"))
    return rounded(scoring.score_forecast(placed, ["rain_sum_mm"], None, placed_model(), 3, category=K.INDEX))


@case(f"""WITH {CUSTOMER_DAYS} SELECT location, date, index AS loc_index, round(rain_sum_mm, 6) AS rain_sum_mm,
  round(sum(rain_sum_mm) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rain_sum_roll3, CAST(month(date) AS INTEGER) AS month
FROM days JOIN cats USING (location)""")
def feature_table_sparse(spark, sf):
    """The feature table of all customers: one place instead of thousands of columns."""
    orders = T.load(spark, sf, "orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("location"), F.col("o_orderdate").alias("datetime"), (F.col("o_totalprice") / 9973.0).alias("rain"))
    daily = T.flow_daily(spark, sf)
    table = features.build_features(orders, None, daily, K.fit_categories(orders, "location"), scale=None)
    return rounded(table.select("location", "date", F.col(K.INDEX).cast("bigint").alias(K.INDEX), "rain_sum_mm", "rain_sum_roll3", "month"))
