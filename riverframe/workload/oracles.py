"""The same queries as SQL for DuckDB, keyed by query name."""

from __future__ import annotations

# -- shared table expressions ----------------------------------------------

RAIN = """rain AS (
  SELECT o_orderpriority AS location, CAST(o_orderdate AS DATE) AS date,
         round(sum(o_totalprice / 9973.0), 11) AS rain_sum_mm, max(o_totalprice / 9973.0) AS rain_max_1h
  FROM orders GROUP BY 1, 2)"""
SHIP = """ship AS (
  SELECT o_orderpriority AS location, l_shipdate AS datetime, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
FLOW = SHIP + """, flow AS (
  SELECT location, CAST(datetime AS DATE) AS date, round(sum(l_extendedprice / 997.0), 11) AS river_discharge_m3s
  FROM ship GROUP BY 1, 2)"""
BOTH = f"{RAIN}, {FLOW}, days AS (SELECT * FROM rain LEFT JOIN flow USING (location, date))"
PAIRED = f"{RAIN}, {FLOW}, days AS (SELECT * FROM rain JOIN flow USING (location, date))"
WEATHER = """weather AS (
  SELECT l_returnflag AS location, CAST(l_shipdate AS DATE) AS date,
         round(sum(l_extendedprice / 9973.0), 11) AS rain_sum_mm,
         round(sum(l_quantity), 11) AS precipitation_sum_mm,
         round(avg(l_quantity), 11) AS temperature_mean_c,
         max(l_tax * 100.0) AS wind_speed_max_mps, max(l_discount * 100.0) AS wind_gust_max_mps
  FROM lineitem GROUP BY 1, 2)"""
FLAG_FLOW = """flag_flow AS (
  SELECT l_returnflag AS location, CAST(l_shipdate AS DATE) AS date,
         round(sum(l_extendedprice * (1 - l_discount) / 997.0), 11) AS river_discharge_m3s
  FROM lineitem GROUP BY 1, 2)"""
READINGS = """readings AS (
  SELECT event_type AS location, ts AS datetime, value AS rain, event_id FROM events)"""
WIDE = """wide AS (
  SELECT event_type AS location, ts AS datetime, value AS rain, value * 0.5 AS precipitation,
         CAST(user_id AS DOUBLE) AS temperature_2m,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS wind_speed_10m,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) * 1.5 AS wind_gusts_10m
  FROM events)"""
TARGET = """target AS (
  SELECT o_orderpriority AS location, CAST(o_orderdate AS DATE) AS date,
         round(avg(o_totalprice / 9973.0 * 10.0), 11) AS river_discharge_m3s
  FROM orders GROUP BY 1, 2)"""
LABELS = "p AS (SELECT quality AS label, toxic AS predicted FROM labels)"
W = "(PARTITION BY location ORDER BY date)"
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def over(n: int) -> str:
    return f"(PARTITION BY location ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def strict(fn: str, c: str, n: int) -> str:
    return f"CASE WHEN count({c}) OVER {over(n)} >= {n} THEN {fn}({c}) OVER {over(n)} END"


def ema_cte(source: str, value: str, alphas: dict[str, float], order: str) -> str:
    """Recursive CTE ``ema`` with one column per alpha, keyed by location and position."""
    seeds = ", ".join(f"x AS {n}" for n in alphas)
    steps = ", ".join(f"(1 - {a}) * e.{n} + {a} * s.x" for n, a in alphas.items())
    return f"""numbered AS (
      SELECT *, {value} AS x, row_number() OVER (PARTITION BY location ORDER BY {order}) AS pos FROM {source}),
    ema AS (
      SELECT location, pos, {seeds} FROM numbered WHERE pos = 1
      UNION ALL
      SELECT s.location, s.pos, {steps} FROM ema e JOIN numbered s ON s.location = e.location AND s.pos = e.pos + 1)"""


def gap_ema_cte(source: str, value: str, alphas: dict[str, float], order: str) -> str:
    """As :func:`ema_cte` over missing values: the older weights decay over a gap, which has no weight of its own."""
    seeds = ", ".join(f"x AS {n}" for n in alphas)

    def step(n: str, a: float) -> str:
        kept = f"pow(1 - {a}, e.gap + 1)"
        return f"CASE WHEN s.x IS NULL THEN e.{n} WHEN e.{n} IS NULL THEN s.x ELSE ({kept} * e.{n} + {a} * s.x) / ({kept} + {a}) END"

    return f"""numbered AS (
      SELECT *, {value} AS x, row_number() OVER (PARTITION BY location ORDER BY {order}) AS pos FROM {source}),
    ema AS (
      SELECT location, pos, 0 AS gap, {seeds} FROM numbered WHERE pos = 1
      UNION ALL
      SELECT s.location, s.pos, CASE WHEN s.x IS NULL THEN e.gap + 1 ELSE 0 END, {", ".join(step(n, a) for n, a in alphas.items())}
      FROM ema e JOIN numbered s ON s.location = e.location AND s.pos = e.pos + 1)"""


def r(*cols: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


ORACLES: dict[str, str] = {}

# -- roll-ups ---------------------------------------------------------------

ORACLES["daily_rollup"] = f"""
WITH {READINGS}
SELECT location, CAST(datetime AS DATE) AS date, round(sum(rain), 6) AS rain_sum_mm,
       round(max(rain), 6) AS rain_max_1h, count(*) AS n_obs
FROM readings GROUP BY 1, 2"""
WIDE_DAYS = """wide_days AS (
  SELECT location, CAST(datetime AS DATE) AS date, sum(rain) AS rain_sum_mm, sum(precipitation) AS precip_sum_mm,
         avg(temperature_2m) AS temp_mean, max(temperature_2m) AS temp_max, min(temperature_2m) AS temp_min,
         max(wind_speed_10m) AS wind_max, max(wind_gusts_10m) AS gust_max, max(rain) AS rain_max_1h, count(*) AS n_obs
  FROM wide GROUP BY 1, 2)"""
WIDE_COLS = ("rain_sum_mm", "precip_sum_mm", "temp_mean", "temp_max", "temp_min", "wind_max", "gust_max", "rain_max_1h")
ORACLES["daily_rollup_wide"] = f"WITH {WIDE}, {WIDE_DAYS} SELECT location, date, n_obs, {r(*WIDE_COLS)} FROM wide_days"
ORACLES["forecast_rollup"] = f"""
WITH {SHIP}, d AS (
  SELECT location, CAST(datetime AS DATE) AS date, sum(l_extendedprice / 9973.0) AS rain_sum,
         max(l_extendedprice / 9973.0) AS rain_max, avg(l_extendedprice / 9973.0) AS rain_mean
  FROM ship GROUP BY 1, 2),
l AS (SELECT *, lag(rain_sum, 1) OVER {W} AS rain_sum_lag1, lag(rain_sum, 2) OVER {W} AS rain_sum_lag2,
             lag(rain_sum, 3) OVER {W} AS rain_sum_lag3, {strict('avg', 'rain_sum', 3)} AS rain_3d_avg FROM d)
SELECT location, date, {r('rain_sum', 'rain_max', 'rain_mean', 'rain_sum_lag1', 'rain_sum_lag2', 'rain_sum_lag3', 'rain_3d_avg')}
FROM l WHERE rain_sum_lag3 IS NOT NULL"""
ORACLES["month_mean"] = f"""
WITH {RAIN}
SELECT location, CAST(month(date) AS INTEGER) AS month, round(avg(rain_sum_mm), 6) AS rain_sum_mm,
       round(avg(rain_max_1h), 6) AS rain_max_1h, any_value(monthname(date)) AS month_name
FROM rain GROUP BY 1, 2"""
ORACLES["mean_by_key"] = f"""
WITH {WEATHER}
SELECT location, round(avg(rain_sum_mm), 6) AS rain_sum_mm, round(avg(temperature_mean_c), 6) AS temperature_mean_c,
       round(avg(wind_speed_max_mps), 6) AS wind_speed_max_mps FROM weather GROUP BY 1"""

# -- joins and unions -------------------------------------------------------

HOURLY = """hourly AS (
  SELECT o_orderpriority AS location, o_orderdate AS datetime, o_totalprice / 9973.0 AS rain FROM orders)"""
ORACLES["hourly_daily_combine"] = f"""
WITH {HOURLY}, {FLOW}
SELECT datetime, h.location, round(rain, 6) AS rain, round(river_discharge_m3s, 6) AS river_discharge_m3s
FROM hourly h JOIN flow f ON f.location = h.location AND f.date = CAST(h.datetime AS DATE)"""
ORACLES["hourly_daily_fill0"] = f"""
WITH {HOURLY}, {FLOW}
SELECT datetime, h.location, round(rain, 6) AS rain, coalesce(round(river_discharge_m3s, 6), 0) AS river_discharge_m3s
FROM hourly h LEFT JOIN flow f ON f.location = h.location AND f.date = CAST(h.datetime AS DATE)"""
for name, kind in (("target_left", "LEFT"), ("target_inner", "INNER")):
    ORACLES[name] = f"""
WITH {RAIN}, {FLOW}
SELECT location, date, {r('rain_sum_mm', 'rain_max_1h', 'river_discharge_m3s')}
FROM rain {kind} JOIN flow USING (location, date)"""
ORACLES["join_suffix"] = f"""
WITH {PAIRED}
SELECT location, date, {r('rain_sum_mm', 'rain_max_1h', 'river_discharge_m3s')},
       CAST(month(date) AS INTEGER) AS month_weather, CAST(month(date) AS INTEGER) AS month_flood FROM days"""
ORACLES["union_tagged"] = f"""
WITH {RAIN}, {FLOW}
SELECT location, date, 'historical' AS data_type, {r('rain_sum_mm', 'rain_max_1h')},
       CAST(NULL AS DOUBLE) AS river_discharge_m3s FROM rain
UNION ALL
SELECT location, date, 'forecast', NULL, NULL, round(river_discharge_m3s, 6) FROM flow"""

# -- windows ----------------------------------------------------------------

ORACLES["lag_features"] = f"""
WITH {RAIN}
SELECT location, date, round(rain_sum_mm, 6) AS rain_sum_mm,
       {", ".join(f"round(lag(rain_sum_mm, {k}) OVER {W}, 6) AS rain_sum_mm_lag_{k}" for k in (1, 2, 3, 7))}
FROM rain"""
ORACLES["rolling_min1"] = f"""
WITH {RAIN}
SELECT location, date, round(rain_sum_mm, 6) AS rain_sum_mm,
       {", ".join(f"round(sum(rain_sum_mm) OVER {over(n)}, 6) AS roll{n}" for n in (3, 7, 14))} FROM rain"""
ORACLES["rolling_strict"] = f"""
WITH {RAIN}, s AS (SELECT location, date, rain_sum_mm, {strict('avg', 'rain_sum_mm', 3)} AS mean3,
  {strict('avg', 'rain_sum_mm', 30)} AS mean30, {strict('sum', 'rain_sum_mm', 7)} AS sum7 FROM rain)
SELECT location, date, {r('rain_sum_mm', 'mean3', 'mean30', 'sum7')} FROM s"""
ORACLES["rolling_calendar"] = f"""
WITH {RAIN}
SELECT location, date, round(rain_sum_mm, 6) AS rain_sum_mm, round(sum(rain_sum_mm) OVER (
  PARTITION BY location ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 6) AS sum7d FROM rain"""
ORACLES["delta"] = f"""
WITH {RAIN}, s AS (SELECT location, date, rain_sum_mm, rain_sum_mm - lag(rain_sum_mm) OVER {W} AS change FROM rain)
SELECT location, date, {r('rain_sum_mm', 'change')}, coalesce(round(change, 6), 0) AS change0 FROM s"""
ORACLES["pct_change"] = f"""
WITH {RAIN}
SELECT location, date, round(rain_sum_mm, 6) AS rain_sum_mm,
       round(rain_sum_mm / nullif(lag(rain_sum_mm) OVER {W}, 0) - 1, 6) AS pct FROM rain"""
ORACLES["pct_change_padded"] = f"""
WITH {BOTH}, f AS (SELECT location, date, river_discharge_m3s,
  last_value(river_discharge_m3s IGNORE NULLS) OVER (PARTITION BY location ORDER BY date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS padded FROM days)
SELECT location, date, round(river_discharge_m3s, 6) AS river_discharge_m3s,
       round(padded / nullif(lag(padded) OVER {W}, 0) - 1, 6) AS pct FROM f"""
ORACLES["anomaly"] = f"""
WITH {RAIN}
SELECT location, date, round(rain_sum_mm, 6) AS rain_sum_mm,
       round(rain_sum_mm - {strict('avg', 'rain_sum_mm', 3)}, 6) AS anomaly FROM rain"""
RW = "(PARTITION BY location ORDER BY datetime, event_id)"


def reading_frame(n: int) -> str:
    return f"(PARTITION BY location ORDER BY datetime, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


ORACLES["reading_windows"] = f"""
WITH {READINGS}
SELECT location, datetime, round(rain, 6) AS rain, event_id, round(lag(rain, 2) OVER {RW}, 6) AS lag2,
       round(CASE WHEN count(rain) OVER {reading_frame(7)} >= 7 THEN avg(rain) OVER {reading_frame(7)} END, 6) AS mean7,
       round(sum(rain) OVER {reading_frame(3)}, 6) AS sum3, round(rain - lag(rain) OVER {RW}, 6) AS change
FROM readings"""
ORACLES["reading_positions"] = f"""
WITH {READINGS}
SELECT *, row_number() OVER {RW} AS position, count(*) OVER (PARTITION BY location) AS n_key FROM readings"""
ORACLES["ema_span"] = f"""
WITH RECURSIVE {RAIN}, {ema_cte('rain', 'rain_sum_mm', {'ema3': 0.5, 'ema7': 0.25}, 'date')}
SELECT n.location, date, {r('rain_sum_mm', 'ema3', 'ema7')} FROM numbered n JOIN ema USING (location, pos)"""
ORACLES["api_index"] = f"""
WITH RECURSIVE {RAIN}, {ema_cte('rain', 'rain_sum_mm', {'rain_api_7d': 0.2}, 'date')}
SELECT n.location, date, {r('rain_sum_mm', 'rain_api_7d')} FROM numbered n JOIN ema USING (location, pos)"""
ORACLES["ema_readings"] = f"""
WITH RECURSIVE {READINGS}, {ema_cte('readings', 'rain', {'ema4': 0.4, 'api': 0.2}, 'datetime, event_id')}
SELECT n.location, datetime, event_id, {r('rain', 'ema4', 'api')} FROM numbered n JOIN ema USING (location, pos)"""
ORACLES["fill_both"] = f"""
WITH {READINGS}, h AS (SELECT location, date_trunc('hour', datetime) AS hour, sum(rain) AS rain FROM readings GROUP BY 1, 2),
span AS (SELECT location, min(hour) AS lo, max(hour) AS hi FROM h GROUP BY 1),
grid AS (SELECT location, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM span),
g AS (SELECT location, hour, rain FROM grid LEFT JOIN h USING (location, hour))
SELECT location, hour, round(rain, 6) AS rain, round(coalesce(
  last_value(rain IGNORE NULLS) OVER (PARTITION BY location ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(rain IGNORE NULLS) OVER (PARTITION BY location ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS filled
FROM g"""
ORACLES["fill_forward_daily"] = f"""
WITH {BOTH}
SELECT location, date, round(last_value(river_discharge_m3s IGNORE NULLS) OVER (PARTITION BY location ORDER BY date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS river_discharge_m3s FROM days"""
ORACLES["last_n_per_key"] = f"""
WITH {READINGS}
SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY location ORDER BY datetime DESC, event_id DESC) <= 14"""
ORACLES["skip_n_per_key"] = f"WITH {READINGS} SELECT * FROM readings QUALIFY row_number() OVER {RW} > 14"


def z(c: str, dev: str = "stddev_samp", part: str = "") -> str:
    return f"({c} - avg({c}) OVER ({part})) / nullif({dev}({c}) OVER ({part}), 0)"


ORACLES["zscore_global"] = f"""
WITH {RAIN}
SELECT location, date, {r('rain_sum_mm', 'rain_max_1h')}, round({z('rain_sum_mm')}, 6) AS rain_sum_mm_zscore,
       round({z('rain_max_1h')}, 6) AS rain_max_1h_zscore FROM rain"""
ORACLES["zscore_by_key"] = f"""
WITH {RAIN}
SELECT location, date, round(rain_sum_mm, 6) AS rain_sum_mm,
       round({z('rain_sum_mm', part='PARTITION BY location')}, 6) AS rain_sum_mm_zscore FROM rain"""
ORACLES["global_stats"] = f"""
WITH {FLOW}
SELECT location, date, round(river_discharge_m3s, 6) AS river_discharge_m3s,
       round(avg(river_discharge_m3s) OVER (), 6) AS mean_flow, round(max(river_discharge_m3s) OVER (), 6) AS max_flow,
       count(river_discharge_m3s) OVER () AS n_flow FROM flow"""

for chunked in ("reading_windows", "ema_readings"):
    ORACLES[f"{chunked}_chunked"] = ORACLES[chunked]
ORACLES["fill_both_by_cells"] = ORACLES["fill_both"]

# -- scaling ----------------------------------------------------------------

SCALED = ("rain_sum_mm", "rain_max_1h", "river_discharge_m3s")
ORACLES["scaler_fit"] = f"WITH {BOTH}" + " UNION ALL ".join(
    f""" SELECT '{c}' AS feature, round(avg({c}), 5) AS mean, round(sqrt(var_pop({c})), 5) AS scale,
 round(var_pop({c}), 5) AS var, count({c}) AS n FROM days""" for c in SCALED)
ORACLES["scaler_apply"] = f"""
WITH {BOTH}
SELECT location, date, {", ".join(f"round({z(c, 'stddev_pop')}, 6) AS {c}" for c in SCALED)} FROM days"""
ORACLES["one_hot"] = f"""
WITH {RAIN} SELECT location, date,
{", ".join(f'''CAST(location = '{v}' AS INTEGER) AS "loc_{v}"''' for v in PRIORITIES)} FROM rain"""

# -- quantiles and extremes -------------------------------------------------

ORACLES["quantile_thresholds"] = """
WITH ps AS (SELECT unnest([0.05, 0.5, 0.8, 0.95, 0.99])::DOUBLE AS p)
""" + " UNION ALL ".join(f"""
SELECT '{c}' AS metric, unnest([0.05, 0.5, 0.8, 0.95, 0.99])::DOUBLE AS p,
       round(unnest(quantile_cont({c}::DOUBLE, [0.05, 0.5, 0.8, 0.95, 0.99])), 6) AS q FROM lineitem"""
    for c in ("l_extendedprice", "l_quantity"))
ORACLES["quantile_by_key"] = f"""
WITH {READINGS} SELECT location, round(quantile_cont(rain, 0.95), 6) AS rain FROM readings GROUP BY 1"""


def extreme_cte(separate: bool = True) -> str:
    sources = ("rain", "flow") if separate else ("days", "days")
    limits = [
        f"(SELECT quantile_cont({c}::DOUBLE, 0.8) FROM {s})"
        for c, s in zip(("rain_sum_mm", "river_discharge_m3s"), sources)
    ]
    return f"""{PAIRED}, flagged AS (
  SELECT date, location, rain_sum_mm, river_discharge_m3s,
         CAST(rain_sum_mm >= {limits[0]} AS INTEGER) AS extreme_rain,
         CAST(river_discharge_m3s >= {limits[1]} AS INTEGER) AS extreme_discharge FROM days),
x AS (SELECT *, extreme_rain * extreme_discharge AS extreme_both FROM flagged)"""


ORACLES["extreme_days"] = f"WITH {extreme_cte()} SELECT * REPLACE (round(rain_sum_mm, 6) AS rain_sum_mm, round(river_discharge_m3s, 6) AS river_discharge_m3s) FROM x"
ORACLES["extreme_days_joined"] = f"WITH {extreme_cte(False)} SELECT * REPLACE (round(rain_sum_mm, 6) AS rain_sum_mm, round(river_discharge_m3s, 6) AS river_discharge_m3s) FROM x"
ORACLES["concurrent_events"] = f"WITH {extreme_cte()} SELECT * REPLACE (round(rain_sum_mm, 6) AS rain_sum_mm, round(river_discharge_m3s, 6) AS river_discharge_m3s) FROM x WHERE extreme_both = 1"
ORACLES["extreme_summary"] = f"""
WITH {extreme_cte()}
SELECT 'Total Records' AS metric, CAST(count(*) AS DOUBLE) AS value FROM x
UNION ALL SELECT 'Extreme Rainfall Days', CAST(sum(extreme_rain) AS DOUBLE) FROM x
UNION ALL SELECT 'Extreme Discharge Days', CAST(sum(extreme_discharge) AS DOUBLE) FROM x
UNION ALL SELECT 'Concurrent Extreme Days', CAST(sum(extreme_both) AS DOUBLE) FROM x
UNION ALL SELECT 'Rain-Discharge Correlation', round(corr(rain_sum_mm, river_discharge_m3s), 3) FROM x"""
ORACLES["extreme_by_key_long"] = f"""
WITH {extreme_cte()}
SELECT location, 'Extreme Rain' AS variable, CAST(sum(extreme_rain) AS BIGINT) AS value FROM x GROUP BY 1
UNION ALL SELECT location, 'Extreme Discharge', CAST(sum(extreme_discharge) AS BIGINT) FROM x GROUP BY 1
UNION ALL SELECT location, 'Concurrent Both', CAST(sum(extreme_both) AS BIGINT) FROM x GROUP BY 1"""

# -- profile ----------------------------------------------------------------

ORACLES["overview"] = f"""
WITH {BOTH}
SELECT count(*) AS n_rows, min(date) AS first_ts, max(date) AS last_ts,
{", ".join(f"round(min({c}), 6) AS min_{c}, round(max({c}), 6) AS max_{c}, round(avg({c}), 6) AS mean_{c}"
           for c in ('rain_sum_mm', 'river_discharge_m3s'))} FROM days"""
ORACLES["distinct_keys"] = "SELECT DISTINCT o_orderpriority AS location FROM orders"
ORACLES["distinct_count"] = "SELECT count(DISTINCT l_orderkey) AS n_distinct FROM lineitem"
ORACLES["profile_nulls"] = f"WITH {BOTH} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS n_null,
    round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 4) AS pct FROM days"""
    for c in ("location", "date", "rain_sum_mm", "rain_max_1h", "river_discharge_m3s"))


def describe_sql(c: str, table: str, by: str = "", digits: int = 5) -> str:
    lead = f"{by}, " if by else ""
    parts = {
        "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "p25": f"quantile_cont({c}::DOUBLE, 0.25)",
        "p50": f"quantile_cont({c}::DOUBLE, 0.5)", "p75": f"quantile_cont({c}::DOUBLE, 0.75)", "max": f"max({c})",
    }
    cells = ", ".join(f"round({e}, {digits}) AS {n}" for n, e in parts.items())
    return f"SELECT {lead}'{c}' AS metric, count({c}) AS n, {cells} FROM {table}" + (f" GROUP BY {by}" if by else "")


ORACLES["describe_global"] = " UNION ALL ".join(
    describe_sql(c, "lineitem", digits=4) for c in ("l_extendedprice", "l_quantity", "l_discount"))
ORACLES["describe_by_key"] = f"WITH {BOTH} " + " UNION ALL ".join(
    describe_sql(c, "days", "location") for c in ("rain_sum_mm", "river_discharge_m3s"))
ORACLES["value_share"] = """
SELECT CASE WHEN l_discount > 0 THEN 'Rain' ELSE 'No Rain' END AS rain_label, count(*) AS n,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM lineitem GROUP BY 1"""
ORACLES["rain_days_by_key"] = f"""
WITH {WEATHER}
SELECT CASE WHEN wind_gust_max_mps > 0 THEN 'Rain' ELSE 'No Rain' END AS rain_label, location, count(*) AS n
FROM weather GROUP BY 1, 2"""
ORACLES["corr_pair"] = f"WITH {BOTH} SELECT round(corr(rain_sum_mm, river_discharge_m3s), 6) AS corr FROM days"
WEATHER_COLS = ("rain_sum_mm", "precipitation_sum_mm", "temperature_mean_c", "wind_speed_max_mps", "wind_gust_max_mps")
ORACLES["corr_matrix"] = f"WITH {WEATHER} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM weather" for a in WEATHER_COLS for b in WEATHER_COLS)
ORACLES["histogram"] = """
WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
bins AS (SELECT CAST(unnest(range(1, 41)) AS INTEGER) AS bin),
c AS (SELECT least(CAST(floor((o_totalprice - lo) * 40 / (hi - lo)) AS INTEGER) + 1, 40) AS bin, count(*) AS n
      FROM orders, e GROUP BY 1)
SELECT bin, round(lo + (bin - 1) * ((hi - lo) / 40), 6) AS lo, round(lo + bin * ((hi - lo) / 40), 6) AS hi,
       coalesce(n, 0) AS n
FROM bins CROSS JOIN e LEFT JOIN c USING (bin)"""
ORACLES["box_stats"] = f"""
WITH {READINGS}, q AS (SELECT location, quantile_cont(rain, 0.25) AS q1, quantile_cont(rain, 0.5) AS median,
  quantile_cont(rain, 0.75) AS q3 FROM readings GROUP BY 1),
j AS (SELECT *, rain BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM readings JOIN q USING (location))
SELECT location, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
       round(min(rain) FILTER (WHERE inside), 6) AS lo_whisker, round(max(rain) FILTER (WHERE inside), 6) AS hi_whisker,
       count(*) FILTER (WHERE NOT inside) AS n_outlier FROM j GROUP BY 1"""
ORACLES["class_weights"] = f"""
WITH {LABELS}
SELECT label, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM p GROUP BY 1"""
ORACLES["label_ratio"] = f"""
WITH {FLOW} SELECT location, round(avg(CASE WHEN river_discharge_m3s >= 100 THEN 1.0 ELSE 0.0 END), 6) AS ratio
FROM flow GROUP BY 1"""
ORACLES["usable_length"] = f"""
WITH {BOTH}, k AS (SELECT location, count(river_discharge_m3s) AS known FROM days GROUP BY 1)
SELECT min(known) AS usable_length FROM k"""
ORACLES["count_flags"] = f"""
WITH {BOTH}
SELECT location, count(*) FILTER (WHERE rain_sum_mm > 0) AS rainy, count(*) FILTER (WHERE rain_sum_mm > 50) AS heavy,
       count(*) FILTER (WHERE river_discharge_m3s >= 100) AS flood FROM days GROUP BY 1"""
ORACLES["topk_days"] = f"WITH {RAIN} SELECT location, date, {r('rain_sum_mm', 'rain_max_1h')} FROM (FROM rain ORDER BY rain_sum_mm DESC, date DESC, location DESC LIMIT 10)"

# -- reshaping --------------------------------------------------------------

ORACLES["pivot_first_reading"] = f"""
SELECT user_id, {", ".join(f"min_by(value, event_id) FILTER (WHERE event_type = '{t}') AS {t}"
                           for t in ('click', 'error', 'purchase', 'signup', 'view'))}
FROM events GROUP BY 1"""
ORACLES["unpivot"] = f"WITH {BOTH} " + " UNION ALL ".join(
    f"SELECT location, date, '{c}' AS variable, round({c}, 6) AS value FROM days" for c in SCALED)

# -- scalars and filters ----------------------------------------------------

ORACLES["calendar_features"] = f"""
WITH {RAIN}
SELECT location, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(dayofyear(date) AS INTEGER) AS dayofyear, CAST(isodow(date) - 1 AS INTEGER) AS weekday,
       CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, CAST(month(date) IN (10, 11, 12, 1, 2, 3) AS INTEGER) AS is_monsoon,
       strftime(date, '%Y-%m-%d') AS text, CAST(date + 1 AS DATE) AS tomorrow FROM rain"""
ORACLES["local_days"] = """
SELECT event_id, ts + INTERVAL 8 HOUR AS local_ts, CAST(ts + INTERVAL 8 HOUR AS DATE) AS local_date FROM events"""
ORACLES["composites"] = f"""
WITH {WEATHER}
SELECT location, date, round(rain_sum_mm + precipitation_sum_mm + 0.5 * wind_speed_max_mps, 6) AS atmo_index,
       round(temperature_mean_c * wind_speed_max_mps, 6) AS temp_wind,
       round(wind_gust_max_mps - wind_speed_max_mps, 6) AS gust_spread,
       round(rain_sum_mm / (precipitation_sum_mm + 0.000001::DOUBLE), 6) AS ratio,
       round(greatest(least(rain_sum_mm, 50.0), 5.0), 6) AS clamped,
       CAST(rain_sum_mm > 50 AS INTEGER) AS heavy_rain FROM weather"""
RISK = "CASE WHEN river_discharge_m3s > 300 THEN 'HIGH' WHEN river_discharge_m3s > 150 THEN 'MEDIUM' ELSE 'LOW' END"
ORACLES["risk_class"] = f"WITH {FLOW} SELECT location, date, {RISK} AS flood_risk FROM flow"
ORACLES["risk_counts"] = f"""
WITH {FLOW}, k AS (SELECT location, {RISK} AS risk FROM flow)
SELECT location, count(*) AS n_days, count(*) FILTER (WHERE risk = 'HIGH') AS n_high,
       count(*) FILTER (WHERE risk = 'MEDIUM') AS n_medium, count(*) FILTER (WHERE risk = 'LOW') AS n_low
FROM k GROUP BY 1"""
ORACLES["relabelled"] = """
SELECT CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'filled' ELSE o_orderstatus END AS status, count(*) AS n
FROM orders GROUP BY 1"""
ORACLES["relative_period"] = f"""
WITH {RAIN} SELECT location, date, {r('rain_sum_mm', 'rain_max_1h')} FROM rain
WHERE date >= greatest((SELECT max(date) FROM rain) - INTERVAL 6 MONTHS, DATE '1995-01-01')"""
ORACLES["year_slice"] = f"""
WITH {HOURLY} SELECT * FROM hourly WHERE datetime >= TIMESTAMP '1998-01-01' AND datetime < TIMESTAMP '1999-01-01'"""
ORACLES["as_of_slice"] = f"WITH {HOURLY} SELECT * FROM hourly WHERE CAST(datetime AS DATE) <= DATE '1996-06-30'"
ORACLES["date_range"] = f"""
WITH {READINGS} SELECT * FROM readings WHERE CAST(datetime AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-10'"""
# -- sequences and splits ---------------------------------------------------


def sequence_sql(source: str, features: tuple[str, ...], n: int, extra: str = "", names: tuple[str, ...] = ()) -> str:
    frame = f"(PARTITION BY location ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    total = " + ".join(f"sum({f}) OVER {frame}" for f in features)
    return f"""SELECT location, date{extra}, CAST({n * len(features)} AS INTEGER) AS n_values,
       round(lag({features[0]}, {n}) OVER {W}, 6) AS first_value, round(lag({features[0]}, 1) OVER {W}, 6) AS last_value,
       round({total}, 5) AS sum_values FROM {source}
       QUALIFY count(*) OVER {frame} = {n}"""


LABEL = ", round(river_discharge_m3s, 6) AS river_discharge_m3s"
ORACLES["sequences"] = f"""
WITH {PAIRED} {sequence_sql('days', ('rain_sum_mm', 'river_discharge_m3s'), 14, LABEL)}"""
ORACLES["sequence_counts"] = f"""
WITH {PAIRED} SELECT location, count(*) AS n_rows, greatest(count(*) - 14, 0) AS n_sequences FROM days GROUP BY 1"""


def split_sql(source: str, case: str, concat: bool) -> str:
    part, order = ("", "location, date") if concat else ("PARTITION BY location", "date")
    return f"""SELECT * EXCLUDE (pos, n), {case} AS split FROM (
      SELECT *, row_number() OVER ({part} ORDER BY {order}) AS pos, count(*) OVER ({part}) AS n FROM {source})"""


TWO = "CASE WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END"
ORACLES["split_per_key"] = f"WITH {PAIRED}, k AS (SELECT location, date FROM days) {split_sql('k', TWO, False)}"
ORACLES["split_concat"] = f"WITH {PAIRED}, k AS (SELECT location, date FROM days) {split_sql('k', TWO, True)}"
THREE = """CASE WHEN pos <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN pos <= floor(n * 0.85::DOUBLE) THEN 'val' ELSE 'test' END"""
ORACLES["split_three_way"] = f"WITH {PAIRED}, k AS (SELECT location, date FROM days) {split_sql('k', THREE, False)}"
CEIL = "CASE WHEN pos <= n - ceil(n * 0.2::DOUBLE) THEN 'train' ELSE 'test' END"
ORACLES["split_ceil_test"] = f"WITH {PAIRED}, k AS (SELECT location, date FROM days) {split_sql('k', CEIL, True)}"
ORACLES["label_by_quantile"] = f"""
WITH {FLOW}
SELECT location, date, round(river_discharge_m3s, 6) AS river_discharge_m3s,
       CAST(river_discharge_m3s >= (SELECT quantile_cont(river_discharge_m3s, 0.8) FROM flow) AS INTEGER) AS label FROM flow"""
TRAIN = f"""{PAIRED}, t AS (SELECT location, date, river_discharge_m3s,
  {z('rain_sum_mm', 'stddev_pop')} AS a, {z('rain_max_1h', 'stddev_pop')} AS b FROM days),
s AS ({sequence_sql('t', ('a', 'b'), 14, LABEL)})"""
ORACLES["training_set"] = f"WITH {TRAIN} {split_sql('s', TWO, True)}"
ORACLES["training_metadata"] = f"""
WITH {TRAIN}, c AS (SELECT count(*) AS n FROM s)
SELECT CAST(14 AS INTEGER) AS sequence_length, 'river_discharge_m3s' AS target_column, CAST(2 AS INTEGER) AS feature_count,
       (SELECT count(*) FROM days) AS rows_used, n AS total_sequences, CAST(floor(n * 0.8::DOUBLE) AS BIGINT) AS train_sequences,
       n - CAST(floor(n * 0.8::DOUBLE) AS BIGINT) AS test_sequences FROM c"""

# -- evaluation -------------------------------------------------------------

SCORES = """round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 6) AS accuracy,
  round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS "precision",
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1"""


def counts_sql(y: str, p: str) -> str:
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    return ", ".join(f"count(*) FILTER (WHERE {y} = {a} AND {p} = {b}) AS {n}" for n, (a, b) in cells.items())


ORACLES["binary_metrics"] = f"""
WITH {LABELS}, c AS (SELECT {counts_sql('label', 'predicted')} FROM p) SELECT tp, fp, fn, tn, {SCORES} FROM c"""
ORACLES["confusion"] = f"WITH {LABELS} " + " UNION ALL ".join(
    f"""SELECT CAST({a} AS INTEGER) AS actual, CAST({b} AS INTEGER) AS predicted,
    count(*) FILTER (WHERE label = {a} AND predicted = {b}) AS n FROM p""" for a in (0, 1) for b in (0, 1))
ORACLES["classification_report"] = f"""
WITH {LABELS}, k AS (SELECT unnest([0, 1]) AS c),
m AS (SELECT c, count(*) FILTER (WHERE label = c AND predicted = c)::DOUBLE AS tp,
             count(*) FILTER (WHERE predicted = c)::DOUBLE AS pr, count(*) FILTER (WHERE label = c)::DOUBLE AS ac
      FROM k CROSS JOIN p GROUP BY 1),
s AS (SELECT c, coalesce(tp / nullif(pr, 0), 0) AS "precision", coalesce(tp / nullif(ac, 0), 0) AS recall,
             coalesce(2 * tp / nullif(pr + ac, 0), 0) AS f1, ac, tp FROM m)
SELECT CAST(c AS VARCHAR) AS label, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(ac AS BIGINT) AS support FROM s
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(ac), 6), round(sum(tp) / sum(ac), 6), round(sum(tp) / sum(ac), 6),
       CAST(sum(ac) AS BIGINT) FROM s
UNION ALL SELECT 'macro avg', round(avg("precision"), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(ac) AS BIGINT) FROM s
UNION ALL SELECT 'weighted avg', round(sum("precision" * ac) / sum(ac), 6), round(sum(recall * ac) / sum(ac), 6),
       round(sum(f1 * ac) / sum(ac), 6), CAST(sum(ac) AS BIGINT) FROM s"""
NAIVE = f"""{FLOW}, m AS (SELECT *, lag(river_discharge_m3s) OVER {W} AS yesterday,
  {strict('avg', 'river_discharge_m3s', 3)} AS mean3 FROM flow),
l AS (SELECT *, lag(mean3) OVER {W} AS last_mean3 FROM m),
st AS (SELECT 'Yesterday' AS model, river_discharge_m3s AS y, yesterday AS p FROM l WHERE yesterday IS NOT NULL
  UNION ALL SELECT 'Mean of three', river_discharge_m3s, last_mean3 FROM l WHERE last_mean3 IS NOT NULL)"""
ORACLES["rmse_mae"] = f"""
WITH {NAIVE}
SELECT model, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae, count(*) AS n
FROM st GROUP BY 1"""
ORACLES["model_comparison"] = f"""
WITH {NAIVE}, j AS (SELECT model, CAST(y >= 200 AS INTEGER) AS a, CAST(p >= 200 AS INTEGER) AS b FROM st),
c AS (SELECT model, {counts_sql('a', 'b')} FROM j GROUP BY 1), s AS (SELECT model, {SCORES} FROM c)
SELECT model AS "Model", accuracy AS "Accuracy", "precision" AS "Precision", recall AS "Recall", f1 AS "F1-Score" FROM s"""

# -- payloads ---------------------------------------------------------------

ORACLES["json_props"] = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k FROM events"
VARS = (("rain", 0, 0, 1, "rain"), ("rain", 0, 1, 17, "rain"), ("temperature", 2, 0, 33, "temperature_2m"),
        ("wind", 10, 0, 49, "wind_speed_10m"))
POINTS = "points AS (" + " UNION ALL ".join(
    f"""SELECT vec_id, TIMESTAMP '2024-01-01' + (vec_id * 57600 + i * 3600) * INTERVAL 1 SECOND AS datetime,
    '{code}' AS code, '{name}' AS variable, CAST({member} AS INTEGER) AS member,
    CAST(embedding[{first} + i] AS DOUBLE) AS value
    FROM embeddings, range(16) AS g(i)""" for code, _, member, first, name in VARS) + ")"
ORACLES["payload_expand"] = f"""
WITH {POINTS} SELECT vec_id, datetime + INTERVAL 8 HOUR AS datetime, code AS variable, round(value, 6) AS value
FROM points"""
ORACLES["ensemble_expand"] = f"WITH {POINTS} SELECT vec_id, datetime, variable, member, round(value, 6) AS value FROM points"
ORACLES["ensemble_wide"] = f"""
WITH {POINTS} SELECT vec_id, datetime, round(max(value) FILTER (WHERE member = 0), 6) AS rain_member0,
       round(max(value) FILTER (WHERE member = 1), 6) AS rain_member1 FROM points WHERE variable = 'rain' GROUP BY 1, 2"""
ORACLES["ensemble_mean"] = f"""
WITH {POINTS} SELECT vec_id, datetime, round(avg(value), 6) AS rain FROM points WHERE variable = 'rain' GROUP BY 1, 2"""
ORACLES["tag_location"] = "SELECT vec_id, n_name AS location FROM embeddings JOIN nation ON label = n_nationkey"
ORACLES["newest_payload"] = """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""

# -- composed tables --------------------------------------------------------

RAIN_FEATURES = [
    "rain_sum_mm", "rain_max_1h", *[f"rain_sum_lag_{k}" for k in (1, 2, 3, 7)], *[f"rain_sum_roll{n}" for n in (3, 7, 14)],
    "rain_ema_3", "rain_ema_7", "rain_delta_1d", "rain_api_7d",
]
FEATURES = [*RAIN_FEATURES, *[f"loc_{v}" for v in PRIORITIES], "month", "is_monsoon", "heavy_rain", "runoff_ratio_7d"]


def memory_sql(source: str, order: str, target: str) -> str:
    """CTEs up to ``tab``: lags, rolls, averages, target, flags of daily rain in ``source``."""
    w = f"(PARTITION BY location ORDER BY {order})"

    def frame(n: int) -> str:
        return f"(PARTITION BY location ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    lags = ", ".join(f"lag(x, {k}) OVER {w} AS rain_sum_lag_{k}" for k in (1, 2, 3, 7))
    rolls = ", ".join(f"sum(x) OVER {frame(n)} AS rain_sum_roll{n}" for n in (3, 7, 14))
    hot = ", ".join(f"""CAST(location = '{v}' AS INTEGER) AS "loc_{v}\"""" for v in PRIORITIES)
    return f"""{ema_cte(source, 'rain_sum_mm', {'rain_ema_3': 0.5, 'rain_ema_7': 0.25, 'rain_api_7d': 0.2}, order)},
win AS (SELECT *, {lags}, {rolls}, coalesce(x - lag(x) OVER {w}, 0) AS rain_delta_1d FROM numbered),
tab AS (SELECT win.*, rain_ema_3, rain_ema_7, rain_api_7d, {target}.river_discharge_m3s, {hot.replace('location =', 'win.location =')},
  CAST(month(win.date) AS INTEGER) AS month, CAST(month(win.date) IN (10, 11, 12, 1, 2, 3) AS INTEGER) AS is_monsoon,
  CAST(rain_sum_mm > 50 AS INTEGER) AS heavy_rain,
  {target}.river_discharge_m3s / (rain_sum_roll7 + 0.000001::DOUBLE) AS runoff_ratio_7d
  FROM win JOIN ema ON ema.location = win.location AND ema.pos = win.pos
  LEFT JOIN {target} ON {target}.location = win.location AND {target}.date = win.date)"""


OBSERVED = f"""{HOURLY}, {SHIP}, {TARGET},
past AS (SELECT location, CAST(datetime AS DATE) AS date, 'historical' AS data_type, sum(rain) AS rain_sum_mm,
                max(rain) AS rain_max_1h FROM hourly GROUP BY 1, 2),
ahead AS (SELECT location, CAST(datetime AS DATE) AS date, 'forecast' AS data_type, sum(l_extendedprice / 9973.0) AS rain_sum_mm,
                 max(l_extendedprice / 9973.0) AS rain_max_1h FROM ship GROUP BY 1, 2)"""
CHOSEN = """allrain AS (SELECT * FROM past UNION ALL
  SELECT a.* FROM ahead a ANTI JOIN past p ON p.location = a.location AND p.date = a.date)"""
INT_FEATURES = {"month", "is_monsoon", "heavy_rain", *[f"loc_{v}" for v in PRIORITIES]}


def quoted(c: str) -> str:
    return f'"{c}"'


def table_sql(scale: bool) -> str:
    cells = []
    for c in FEATURES:
        q = quoted(c)
        if scale:
            dev = f"stddev_pop({q}) OVER ()"
            cells.append(f"round(({q} - avg({q}) OVER ()) / CASE WHEN {dev} = 0 THEN 1 ELSE {dev} END, 5) AS {q}")
        else:
            cells.append(q if c in INT_FEATURES else f"round({q}, 5) AS {q}")
    return f"SELECT location, date, data_type, {', '.join(cells)}, round(river_discharge_m3s, 5) AS river_discharge_m3s FROM tab"


ORACLES["feature_table"] = f"WITH RECURSIVE {OBSERVED}, {CHOSEN}, {memory_sql('allrain', 'date', 'target')} {table_sql(True)}"
ORACLES["feature_table_unscaled"] = (
    f"WITH RECURSIVE {OBSERVED}, {CHOSEN}, {memory_sql('allrain', 'date', 'target')} {table_sql(False)}")
ORACLES["feature_table_overlapping"] = f"""
WITH RECURSIVE {OBSERVED}, allrain AS (SELECT * FROM past UNION ALL SELECT * FROM ahead),
{memory_sql('allrain', 'date, data_type', 'target')} {table_sql(False)}"""
WIDE_LAGS = ", ".join(
    f"lag(rain_sum_mm, {k}) OVER {W} AS rain_sum_lag_{k}, lag(rain_max_1h, {k}) OVER {W} AS rain_max1h_lag_{k}"
    for k in (1, 2, 3, 7))
WIDE_ROLLS = ", ".join(f"sum(rain_sum_mm) OVER {over(n)} AS rain_sum_roll{n}" for n in (3, 7, 14))
WIDE_OUT = [*WIDE_COLS, "temp_diurnal_range", *[f"rain_sum_lag_{k}" for k in (1, 2, 3, 7)],
            *[f"rain_max1h_lag_{k}" for k in (1, 2, 3, 7)], *[f"rain_sum_roll{n}" for n in (3, 7, 14)], "rain_change_1d",
            "rain_ema_3", "rain_ema_7", "river_discharge_m3s"]
ORACLES["feature_table_wide"] = f"""
WITH RECURSIVE {WIDE}, {WIDE_DAYS},
goal AS (SELECT location, CAST(datetime AS DATE) AS date, round(avg(wind_speed_10m), 11) AS river_discharge_m3s FROM wide GROUP BY 1, 2),
{ema_cte('wide_days', 'rain_sum_mm', {'rain_ema_3': 0.5, 'rain_ema_7': 0.25}, 'date')},
win AS (SELECT *, temp_max - temp_min AS temp_diurnal_range, {WIDE_LAGS}, {WIDE_ROLLS},
        coalesce(rain_sum_mm - lag(rain_sum_mm) OVER {W}, 0) AS rain_change_1d FROM numbered)
SELECT win.location, win.date, {r(*WIDE_OUT)}
FROM win JOIN ema ON ema.location = win.location AND ema.pos = win.pos
JOIN goal ON goal.location = win.location AND goal.date = win.date
WHERE rain_sum_lag_7 IS NOT NULL"""


def filled(c: str) -> str:
    return f"""coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY location ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value({c} IGNORE NULLS) OVER (PARTITION BY location ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


CALENDAR = """CAST(dayofyear(date) AS INTEGER) AS dayofyear, CAST(month(date) AS INTEGER) AS month,
  CAST(isodow(date) - 1 AS INTEGER) AS weekday, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend"""
CALENDAR_NAMES = ("dayofyear", "month", "weekday", "is_weekend")
FLOW_DERIVED = [*[f"discharge_lag_{k}d" for k in (1, 3, 7)], "discharge_rolling_3d", "discharge_cum_7d", "discharge_delta_1d",
                "discharge_change_pct", "discharge_anomaly", "discharge_zscore"]


def discharge_sql(source: str, out: str) -> str:
    c = "river_discharge_m3s"
    lags = ", ".join(f"lag({c}, {k}) OVER {W} AS discharge_lag_{k}d" for k in (1, 3, 7))
    return f"""{out}_raw AS (SELECT location, date, {c}, {lags}, {strict('avg', c, 3)} AS discharge_rolling_3d,
  {strict('sum', c, 7)} AS discharge_cum_7d, {c} - lag({c}) OVER {W} AS discharge_delta_1d,
  {c} / nullif(lag({c}) OVER {W}, 0) - 1 AS discharge_change_pct, {c} - {strict('avg', c, 3)} AS discharge_anomaly,
  CAST({c} >= (SELECT quantile_cont({c}, 0.95) FROM {source}) AS INTEGER) AS is_extreme_river_discharge,
  {z(c)} AS discharge_zscore, {CALENDAR} FROM {source}),
{out} AS (SELECT location, date, {c}, {", ".join(f"{filled(n)} AS {n}" for n in FLOW_DERIVED)}, is_extreme_river_discharge,
  {", ".join(CALENDAR_NAMES)} FROM {out}_raw)"""


ORACLES["discharge_features"] = f"""
WITH {FLOW}, {discharge_sql('flow', 'd')}
SELECT location, date, {r('river_discharge_m3s', *FLOW_DERIVED, digits=5)}, is_extreme_river_discharge,
  {", ".join(CALENDAR_NAMES)} FROM d"""
WEATHER_DERIVED = [*[f"{v}_lag_{k}d" for k in (1, 3, 7) for v in ("rain", "temp")], "rain_rolling_3d", "rain_cum_7d"]
WEATHER_SCORES = {"rain_sum_mm": "rain_sum_zscore", "temperature_mean_c": "temperature_mean_zscore",
                  "wind_speed_max_mps": "wind_speed_max_zscore"}
WEATHER_FLAGS = {"rain_sum_mm": "extreme_rain", "temperature_mean_c": "extreme_temp", "wind_speed_max_mps": "extreme_wind"}


def weather_sql(out: str) -> str:
    lags = ", ".join(f"lag(rain_sum_mm, {k}) OVER {W} AS rain_lag_{k}d, lag(temperature_mean_c, {k}) OVER {W} AS temp_lag_{k}d"
                     for k in (1, 3, 7))
    flags = ", ".join(f"CAST({c} >= (SELECT quantile_cont({c}, 0.95) FROM weather) AS INTEGER) AS {n}" for c, n in WEATHER_FLAGS.items())
    scores = ", ".join(f"{z(c)} AS {n}" for c, n in WEATHER_SCORES.items())
    return f"""{out}_raw AS (SELECT *, {lags}, {strict('avg', 'rain_sum_mm', 3)} AS rain_rolling_3d,
  {strict('sum', 'rain_sum_mm', 7)} AS rain_cum_7d, {CALENDAR},
  rain_sum_mm + precipitation_sum_mm + 0.5 * wind_speed_max_mps AS atmo_index,
  temperature_mean_c * wind_speed_max_mps AS temp_wind_interaction, {flags}, {scores} FROM weather),
{out} AS (SELECT location, date, {", ".join(WEATHER_COLS)}, {", ".join(f"{filled(n)} AS {n}" for n in WEATHER_DERIVED)},
  {", ".join(CALENDAR_NAMES)}, atmo_index, temp_wind_interaction, extreme_rain, extreme_temp, extreme_wind,
  CAST(extreme_rain + extreme_temp + extreme_wind > 0 AS INTEGER) AS is_extreme_weather,
  {", ".join(WEATHER_SCORES.values())} FROM {out}_raw)"""


ORACLES["weather_features"] = f"""
WITH {WEATHER}, {weather_sql('w')}
SELECT location, date, {r(*WEATHER_COLS, *WEATHER_DERIVED, 'atmo_index', 'temp_wind_interaction', *WEATHER_SCORES.values(), digits=5)},
  {", ".join(CALENDAR_NAMES)}, extreme_rain, extreme_temp, extreme_wind, is_extreme_weather FROM w"""
ORACLES["joined_features"] = f"""
WITH {WEATHER}, {FLAG_FLOW}, {weather_sql('w')}, {discharge_sql('flag_flow', 'd')}
SELECT location, date, {r('rain_sum_mm', 'atmo_index', 'rain_lag_1d', 'rain_cum_7d', 'rain_sum_zscore', 'discharge_lag_1d',
       'discharge_cum_7d', 'discharge_zscore', 'river_discharge_m3s', digits=5)}, is_extreme_weather,
       d.dayofyear AS dayofyear_flood, w.month AS month_weather, d.weekday AS weekday_flood
FROM w JOIN d USING (location, date)"""

# -- forecasts --------------------------------------------------------------


def scored_cte(n: int) -> str:
    frame = f"(PARTITION BY location ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"""scored AS (SELECT location, date, avg(river_discharge_m3s) OVER {frame} AS predicted_discharge
      FROM flow QUALIFY count(*) OVER {frame} = {n})"""


PREDICTED_RISK = RISK.replace("river_discharge_m3s", "predicted_discharge")
ORACLES["score_forecast"] = f"""
WITH {FLOW}, {scored_cte(14)}
SELECT location, date, round(predicted_discharge, 6) AS predicted_discharge, {PREDICTED_RISK} AS flood_risk FROM scored"""
ORACLES["actual_and_forecast"] = f"""
WITH {FLOW}, {scored_cte(7)}
SELECT date, location, round(river_discharge_m3s, 6) AS value, 'actual' AS type FROM flow
UNION ALL SELECT date, location, round(predicted_discharge, 6), 'forecast' FROM scored"""
ORACLES["eligible_keys"] = """
SELECT o_custkey, o_orderkey FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey) >= 7"""
ORACLES["rejected_keys"] = "SELECT o_custkey, count(*) AS n_clean FROM orders GROUP BY 1 HAVING count(*) < 7"


def horizon_cte(n: int, until: str) -> str:
    """Steps per key over the last n days, as lists."""
    return f"""{RAIN}, tail AS (SELECT location, date, rain_sum_mm FROM rain
  QUALIFY row_number() OVER (PARTITION BY location ORDER BY date DESC) <= {n}),
l AS (SELECT location, list(rain_sum_mm ORDER BY date) AS v, max(date) AS last_day FROM tail GROUP BY 1 HAVING count(*) = {n}),
st AS (SELECT location, v, last_day, unnest(generate_series(1, date_diff('day', last_day, {until}))) AS h FROM l),
seq AS (SELECT location, CAST(last_day + h::INTEGER AS DATE) AS date, CAST(h AS INTEGER) AS step,
  list_concat(v[least(h, {n} + 1):], list_transform(range(least(h - 1, {n})), lambda i: v[{n}])) AS s FROM st)"""


FACTS = """CAST(len(s) AS INTEGER) AS n_values, round(s[1], 6) AS first_value, round(s[-1], 6) AS last_value,
       round(list_sum(s), 5) AS sum_values"""
ORACLES["horizon_windows"] = f"WITH {horizon_cte(14, "DATE '2001-12-31'")} SELECT location, date, step, {FACTS} FROM seq"
ORACLES["horizon_per_key"] = f"""
WITH {horizon_cte(5, "CAST(least(last_day + 7, DATE '2001-12-31') AS DATE)")} SELECT location, date, step, {FACTS} FROM seq"""
ORACLES["horizon_forecast"] = f"""
WITH {horizon_cte(14, "DATE '2001-12-31'")}, f AS (SELECT location, date, step, list_avg(s) AS predicted_discharge FROM seq)
SELECT location, date, step, round(predicted_discharge, 6) AS predicted_discharge, {PREDICTED_RISK} AS flood_risk FROM f"""

ORACLES["forecast_driver"] = f"""
WITH {RAIN}, {FLOW}, {scored_cte(7)}
SELECT location, date, {r('predicted_discharge', 'rain_sum_mm', 'rain_max_1h')}, {PREDICTED_RISK} AS flood_risk
FROM scored LEFT JOIN rain USING (location, date)"""
ORACLES["aligned_features"] = f"""
WITH {RAIN} SELECT location, date, {r('rain_max_1h', 'rain_sum_mm')}, CAST(0 AS DOUBLE) AS rain_mean FROM rain"""
ORACLES["filled_and_dropped"] = f"""
WITH {BOTH} SELECT location, date, {r(*SCALED)} FROM days WHERE coalesce(river_discharge_m3s, 0) > 0"""

# -- dashboard --------------------------------------------------------------

ORACLES["dashboard_overlay"] = f"""
WITH {HOURLY}, {FLOW}
SELECT CAST(h.datetime AS DATE) AS date, h.location, h.datetime, round(rain, 6) AS rain,
       coalesce(round(river_discharge_m3s, 6), 0) AS river_discharge_m3s
FROM hourly h LEFT JOIN flow f ON f.location = h.location AND f.date = CAST(h.datetime AS DATE)
WHERE h.location = '2-HIGH' AND CAST(h.datetime AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"""
ORACLES["overlay_all"] = f"""
WITH {READINGS}
SELECT location, CAST(datetime AS DATE) AS date, datetime, rain, event_id,
       max(rain) OVER (PARTITION BY location, CAST(datetime AS DATE)) AS day_max FROM readings"""
