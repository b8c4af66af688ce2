"""Queries of rows that travel once: stored blocks, and scores of long keys in chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverframe.operators import blocks as B
from riverframe.workload import oracles as Q
from riverframe.workload import tables as T
from riverframe.workload.cases import both_ways, both_ways_sql, case
from riverframe.workload.queries import KEYS, mean_model, rounded

SIZE, STEPS = 64, 14


@case(f"""WITH {Q.RAIN}, p AS (SELECT *, row_number() OVER {Q.W} AS pos FROM rain),
b AS (SELECT *, unnest(range((pos - 1) // {SIZE}, (pos - 1 + {STEPS}) // {SIZE} + 1)) AS block FROM p),
m AS (SELECT location, block, count(*) FILTER (block > (pos - 1) // {SIZE}) AS n_before, count(*) FILTER (block = (pos - 1) // {SIZE} AND pos > {STEPS}) AS n_windows,
  min(date) FILTER (block = (pos - 1) // {SIZE} AND pos > {STEPS}) AS first_day, sum(rain_sum_mm) AS total, count(*) AS n_rows FROM b GROUP BY 1, 2)
SELECT location, block, CAST(n_before AS INTEGER) AS n_before, CAST(n_windows AS INTEGER) AS n_windows, first_day, round(total, 6) AS total, CAST(n_rows AS INTEGER) AS n_rows FROM m WHERE n_windows > 0""")
def sequence_blocks(spark, sf):
    """Rain in blocks of 64 days with the 14 days before them: every window, 1.2 times the rows."""
    blocks = B.sequence_blocks(T.rain_daily(spark, sf), KEYS, "date", ["rain_sum_mm"], STEPS, size=SIZE, chunk=0)
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return blocks.select("location", "block", "n_before", "n_windows", F.col("stamps")[0].alias("first_day"), F.round(total, 6).alias("total"), F.size("x").alias("n_rows"))


@case(both_ways_sql(f"WITH {Q.READINGS}", f"""
SELECT location, datetime, event_id, round(prediction, 6) AS prediction FROM (
  SELECT *, avg(rain) OVER w AS prediction, count(*) OVER w AS n FROM readings
  WINDOW w AS (PARTITION BY location ORDER BY datetime, event_id ROWS BETWEEN {STEPS} PRECEDING AND 1 PRECEDING)) WHERE n = {STEPS}"""))
def score_readings(spark, sf):
    """Raw readings scored in order, on whole keys and in chunks."""
    return rounded(both_ways(lambda chunk: B.score_rows(T.readings(spark, sf), KEYS, "datetime", ["rain"], STEPS, mean_model(), chunk=chunk, tiebreak=["event_id"])))
