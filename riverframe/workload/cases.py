"""More queries with their SQL side by side: rows without a key on both ways of a window, raw rows under a
DATE, keys with one prefix, a sentinel among the values, stations by distance, round trips through files,
guards, trees that SQL can check, and full runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.functions import columns as C
from riverframe.operators import select, sequences as S, stats, windows as W
from riverframe.operators.ema import alpha_of, emas
from riverframe.operators.joins import union_all
from riverframe.operators.ordered import DAILY, add_rows, positions
from riverframe.operators.quantiles import quantiles_long
from riverframe.operators.scaling import apply_scaler, fit_scaler
from riverframe.operators.settle import settle
from riverframe.plans import dashboard, evaluate, features, profile, scoring, training
from riverframe.session import checkpoint_dir
from riverframe.sources import payloads as P, tables as files
from riverframe.workload import oracles as Q
from riverframe.workload import tables as T
from riverframe.workload.queries import HORIZON_END, KEYS, PRIORITIES, REGISTRY, mean_model, query, rounded

ORACLES: dict[str, str] = {}


def case(sql: str) -> Callable:
    """Register a query and its SQL under the function's name."""

    def register(fn):
        ORACLES[fn.__name__] = sql
        return query(fn)

    return register


def scratch(spark, name: str) -> str:
    """A fresh path in the shared folder for a round trip."""
    import uuid

    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# -- rows without a key: the ordinary and the chunked way must agree ---------

SOME_KEYS = """keyed AS (
  SELECT CASE WHEN user_id % 4 = 0 THEN NULL ELSE event_type END AS location, ts AS datetime, value AS rain, event_id FROM events)"""
WAYS = {"whole": 0, "chunks": 512}


def some_keys(spark, sf: str) -> DataFrame:
    key = F.when(F.col("user_id") % 4 != 0, F.col("event_type"))
    return T.load(spark, sf, "events").select(key.alias("location"), F.col("ts").alias("datetime"), F.col("value").alias("rain"), "event_id")


def both_ways(build: Callable[[int], DataFrame]) -> DataFrame:
    return union_all(*[select.tag(build(chunk), "way", way) for way, chunk in WAYS.items()])


def both_ways_sql(head: str, body: str) -> str:
    return head + " UNION ALL ".join(f" SELECT *, '{way}' AS way FROM ({body})" for way in WAYS)


@case(both_ways_sql(f"WITH {SOME_KEYS}", f"""
SELECT location, datetime, round(rain, 6) AS rain, event_id, round(lag(rain, 2) OVER {Q.RW}, 6) AS lag2,
       round(CASE WHEN count(rain) OVER {Q.reading_frame(7)} >= 7 THEN avg(rain) OVER {Q.reading_frame(7)} END, 6) AS mean7,
       round(rain - lag(rain) OVER {Q.RW}, 6) AS change FROM keyed"""))
def windows_null_key(spark, sf):
    exprs = {"lag2": W.lag_of("rain", 2), "mean7": W.rolling_of("rain", 7, "mean"), "change": W.delta_of("rain")}
    return rounded(both_ways(lambda chunk: add_rows(some_keys(spark, sf), KEYS, "datetime", exprs, ["event_id"], chunk=chunk)))


@case(both_ways_sql(f"WITH {SOME_KEYS}", f"SELECT *, row_number() OVER {Q.RW} AS position, count(*) OVER (PARTITION BY location) AS n_key FROM keyed"))
def positions_null_key(spark, sf):
    return both_ways(lambda chunk: positions(some_keys(spark, sf), KEYS, "datetime", "position", "n_key", ["event_id"], chunk=chunk))


EMA_NULL = Q.ema_cte("named", "rain", {"ema4": 0.4, "api": 0.2}, "datetime, event_id")


@case(both_ways_sql(f"WITH RECURSIVE {SOME_KEYS}, named AS (SELECT coalesce(location, '') AS location, datetime, rain, event_id FROM keyed), {EMA_NULL}", f"""
SELECT nullif(n.location, '') AS location, datetime, event_id, {Q.r('rain', 'ema4', 'api')} FROM numbered n JOIN ema USING (location, pos)"""))
def ema_null_key(spark, sf):
    return rounded(both_ways(lambda chunk: emas(some_keys(spark, sf), KEYS, "datetime", "rain", {"ema4": 0.4, "api": 0.2}, ["event_id"], chunk=chunk)))


# Single values, whole runs of hundreds of rows, and the start of every series are missing.
GAPPY_READINGS = "gaps AS (SELECT event_type AS location, ts AS datetime, event_id, CASE WHEN event_id % 3 > 0 AND event_id % 1000 >= 400 THEN value END AS rain FROM events)"
GAP_AVERAGES = {"ema4": 0.4, "api": 0.2, "slow": 0.01, "last": 1.0}


@case(both_ways_sql(f"WITH RECURSIVE {GAPPY_READINGS}, {Q.gap_ema_cte('gaps', 'rain', GAP_AVERAGES, 'datetime, event_id')}", f"""
SELECT n.location, datetime, event_id, {Q.r('rain', *GAP_AVERAGES)} FROM numbered n JOIN ema USING (location, pos)"""))
def ema_missing(spark, sf):
    """Averages over readings with gaps, on ordinary windows and in chunks."""
    known = (F.col("event_id") % 3 > 0) & (F.col("event_id") % 1000 >= 400)
    gappy = T.readings(spark, sf).withColumn("rain", F.when(known, F.col("rain")))
    return rounded(both_ways(lambda chunk: emas(gappy, KEYS, "datetime", "rain", GAP_AVERAGES, ["event_id"], chunk=chunk)))


@case(f"""WITH RECURSIVE {Q.RAIN}, gaps AS (SELECT location, date, CASE WHEN day(date) NOT BETWEEN 8 AND 20 THEN rain_sum_mm END AS rain_sum_mm FROM rain),
{Q.gap_ema_cte('gaps', 'rain_sum_mm', {'rain_ema_3': 0.5, 'rain_ema_7': 0.25, 'rain_api_7d': 0.2}, 'date')}
SELECT n.location, date, {Q.r('rain_sum_mm', 'rain_ema_3', 'rain_ema_7', 'rain_api_7d')} FROM numbered n JOIN ema USING (location, pos)""")
def api_index_missing(spark, sf):
    """Averages and the precipitation index of days that lack a reading for half of every month."""
    days = T.rain_daily(spark, sf).select("location", "date", F.when(~F.dayofmonth("date").between(8, 20), F.col("rain_sum_mm")).alias("rain_sum_mm"))
    averages = {f"rain_ema_{s}": alpha_of(span=s) for s in (3, 7)} | {"rain_api_7d": 0.2}
    return rounded(emas(days, KEYS, "date", "rain_sum_mm", averages, chunk=DAILY))


@case(both_ways_sql(f"WITH {SOME_KEYS}, gappy AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN rain END AS filled FROM keyed)", """
SELECT location, datetime, event_id, round(rain, 6) AS rain, round(coalesce(
  last_value(filled IGNORE NULLS) OVER (PARTITION BY location ORDER BY datetime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(filled IGNORE NULLS) OVER (PARTITION BY location ORDER BY datetime, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS filled
FROM gappy"""))
def fill_null_key(spark, sf):
    gappy = some_keys(spark, sf).withColumn("filled", F.when(F.col("event_id") % 3 == 0, F.col("rain")))
    return rounded(both_ways(lambda chunk: W.fill_gaps(gappy, KEYS, "datetime", ["filled"], "both", ["event_id"], chunk=chunk)))


@case(f"""WITH {SOME_KEYS}, d AS (SELECT location, CAST(datetime AS DATE) AS date, rain, event_id FROM keyed)
SELECT location, date, event_id, round(rain, 6) AS rain, round(lag(rain) OVER (PARTITION BY location ORDER BY date, event_id), 6) AS before,
       row_number() OVER (PARTITION BY location ORDER BY date, event_id) AS position FROM d""")
def raw_rows_by_date(spark, sf):
    """A DATE column with hundreds of rows a day, in chunks: the type of the column says nothing about the grain."""
    days = some_keys(spark, sf).select("location", F.to_date("datetime").alias("date"), "rain", "event_id")
    with_lag = add_rows(days, KEYS, "date", {"before": W.lag_of("rain", 1)}, ["event_id"], chunk=256)
    return rounded(positions(with_lag, KEYS, "date", "position", None, ["event_id"], chunk=256))


# -- splits over all keys ------------------------------------------------------


def split_order(key: str) -> str:
    return f"""SELECT * EXCLUDE (pos, n), CASE WHEN pos <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM (
      SELECT *, row_number() OVER (ORDER BY {key} NULLS FIRST, o_orderkey) AS pos, count(*) OVER () AS n FROM k)"""


@case(f"WITH k AS (SELECT 'sensor-' || o_custkey AS sensor, o_orderkey FROM orders) {split_order('sensor')}")
def split_concat_shared_prefix(spark, sf):
    rows = T.load(spark, sf, "orders").select(F.concat(F.lit("sensor-"), F.col("o_custkey").cast("string")).alias("sensor"), "o_orderkey")
    return S.chrono_split(rows, ["sensor"], "o_orderkey", mode="concat", chunk=0)


@case(f"WITH k AS (SELECT CASE WHEN o_custkey % 3 > 0 THEN o_custkey END AS customer, o_orderkey FROM orders) {split_order('customer')}")
def split_concat_null_key(spark, sf):
    rows = T.load(spark, sf, "orders").select(F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")).alias("customer"), "o_orderkey")
    return S.chrono_split(rows, ["customer"], "o_orderkey", mode="concat", chunk=0)


@case(f"WITH k AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey FROM orders) {split_order('day')}")
def split_concat_date_key(spark, sf):
    rows = T.load(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderkey")
    return S.chrono_split(rows, ["day"], "o_orderkey", mode="concat", chunk=0)


# -- quantiles -------------------------------------------------------------------

PS = [0.0, 0.05, 0.5, 0.95, 1.0]


@case("""WITH v AS (SELECT l_extendedprice AS price FROM lineitem UNION ALL SELECT 9.96e36 FROM lineitem WHERE l_orderkey = (SELECT min(l_orderkey) FROM lineitem) AND l_linenumber = 1)
""" + " UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(price::DOUBLE, {p}), 6) AS q FROM v" for p in PS))
def quantile_with_sentinel(spark, sf):
    """One value far beyond all others, as a missing-value mark would be."""
    items = T.load(spark, sf, "lineitem")
    first = items.agg(F.min("l_orderkey").alias("k"))
    mark = items.join(first, items.l_orderkey == first.k).filter("l_linenumber = 1").select(F.lit(9.96e36).alias("price"))
    q = quantiles_long(items.select(F.col("l_extendedprice").alias("price")).unionAll(mark), ["price"], PS)
    pairs = F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in PS]).alias("p"), F.col("q")))
    return rounded(q.select(pairs.alias("z")).select("z.p", "z.q"))


# -- payloads ----------------------------------------------------------------------

STATION = "SELECT n_name AS location, n_nationkey * 0.01 AS lat, n_nationkey * 0.02 AS lon FROM nation"
CALL = "SELECT vec_id, label * 0.01 + (vec_id % 7 - 3) * 0.002 AS lat, label * 0.02 AS lon FROM embeddings"
KM = """2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(s.lat - c.lat) / 2), 2)
  + cos(radians(c.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - c.lon) / 2), 2))))"""


@case(f"""WITH s AS ({STATION}), c AS ({CALL}), d AS (SELECT vec_id, location, {KM} AS km FROM c, s),
near AS (SELECT vec_id, min_by(location, km) AS location, min(km) AS km FROM d WHERE km <= 0.5 GROUP BY 1)
SELECT c.vec_id, location, round(km, 6) AS distance_km FROM c LEFT JOIN near USING (vec_id)""")
def tag_location_near(spark, sf):
    """Payloads some hundred metres from their station: nearest one within half a kilometre, none lost."""
    k = F.col("n_nationkey")
    stations = T.load(spark, sf, "nation").select(F.col("n_name").alias("location"), (k * 0.01).alias("latitude"), (k * 0.02).alias("longitude"))
    away = (F.col("vec_id") % 7 - 3) * 0.002
    calls = T.load(spark, sf, "embeddings").select("vec_id", (F.col("label") * 0.01 + away).alias("latitude"), (F.col("label") * 0.02).alias("longitude"))
    return rounded(P.nearest_location(calls, stations, 0.5).select("vec_id", "location", "distance_km"))


@case(f"WITH c AS ({CALL}) SELECT vec_id % 7 AS step, count(*) AS n FROM c WHERE vec_id % 7 IN (0, 6) GROUP BY 1")
def untagged_payloads(spark, sf):
    k = F.col("n_nationkey")
    stations = T.load(spark, sf, "nation").select(F.col("n_name").alias("location"), (k * 0.01).alias("latitude"), (k * 0.02).alias("longitude"))
    away = (F.col("vec_id") % 7 - 3) * 0.002
    calls = T.load(spark, sf, "embeddings").select("vec_id", (F.col("label") * 0.01 + away).alias("latitude"), (F.col("label") * 0.02).alias("longitude"))
    return P.untagged(calls, stations, 0.5).groupBy((F.col("vec_id") % 7).alias("step")).agg(F.count("*").alias("n"))


@case("SELECT n_nationkey AS k, n_name AS name FROM nation WHERE n_nationkey < 1000")
def landed_pages(spark, sf):
    """Nations as a listing in pages of ten, landed as JSON and read again."""
    page = F.floor(F.col("n_nationkey") / 10) * 10
    pages = T.load(spark, sf, "nation").groupBy(page.alias("offset")).agg(F.collect_list(F.struct(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))).alias("results"))
    path = scratch(spark, "pages")
    pages.write.json(path)
    return P.read_pages(spark, path, "offset bigint, results array<struct<k: int, name: string>>")


@case("SELECT CAST(ceil(count(*) / 10.0) AS BIGINT) AS n_pages, CAST(floor(max(n_nationkey) / 10) * 10 AS BIGINT) AS last_offset, count(*) % 10 <> 0 AS complete FROM nation")
def pages_complete(spark, sf):
    page = F.floor(F.col("n_nationkey") / 10) * 10
    pages = T.load(spark, sf, "nation").groupBy(page.alias("offset")).agg(F.collect_list("n_name").alias("results"))
    return P.pages_complete(pages, page_size=10)


# -- files -------------------------------------------------------------------------

EVENTS_TEXT = "location string, datetime string, rain string, event_id bigint"


@case("""SELECT trim(event_type) AS location, ts AS datetime, round(value, 6) AS rain, event_id FROM events
WHERE event_id % 11 <> 0 AND event_id % 13 <> 0""")
def csv_round_trip(spark, sf):
    """Events written as CSV with padded keys, some without a stamp one can read or without a key; read by schema and cleaned."""
    stamp = F.when(F.col("event_id") % 11 == 0, F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    key = F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")))
    text = T.load(spark, sf, "events").select(key.alias("location"), stamp.alias("datetime"), F.col("value").cast("string").alias("rain"), "event_id")
    path = scratch(spark, "csv")
    files.write_table(text, path, "csv", sort_by=["event_id"])
    read = files.read_table(spark, path, EVENTS_TEXT)
    return rounded(select.normalize_keys(read.withColumn("rain", F.col("rain").cast("double")), "datetime"))


@case("""SELECT count(*) AS n_rows, count(*) FILTER (WHERE event_id % 11 = 0) AS bad_datetime,
       count(*) FILTER (WHERE event_id % 13 = 0) AS bad_location FROM events""")
def rejected_by_reason(spark, sf):
    """Rows by reason of rejection; most stamps here can be read and some cannot."""
    stamp = F.when(F.col("event_id") % 11 == 0, F.lit("2024-13-45")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    raw = T.load(spark, sf, "events").select(F.when(F.col("event_id") % 13 != 0, F.col("event_type")).alias("location"), stamp.alias("datetime"))
    return select.rejected_rows(raw, "datetime")


@case(f"WITH {Q.RAIN} SELECT location, date, {Q.r('rain_sum_mm', 'rain_max_1h')} FROM rain")
def partitioned_round_trip(spark, sf):
    """Daily rain written by year, sorted by key and day inside, and read again."""
    path = scratch(spark, "table")
    days = T.rain_daily(spark, sf).withColumn("year", F.year("date"))
    files.write_table(days, path, partition_by=["year"], sort_by=["location", "date"])
    return rounded(files.read_table(spark, path, fmt="parquet").drop("year"))


@case(f"WITH {Q.BOTH} SELECT location, date, " + ", ".join(f"round({Q.z(c, 'stddev_pop')}, 6) AS {c}" for c in Q.SCALED) + " FROM days")
def scaler_round_trip(spark, sf):
    """Statistics saved, loaded against the list they must serve, and applied."""
    days, path = T.rain_and_flow(spark, sf), scratch(spark, "scaler")
    files.save_stats(fit_scaler(days, list(Q.SCALED)), path)
    return rounded(apply_scaler(days, files.load_stats(spark, path, expect=list(Q.SCALED)), list(Q.SCALED)))


@case(f"WITH {Q.BOTH} SELECT unnest(['rain_sum_mm', 'rain_max_1h']) AS feature, (SELECT count(*) FROM days) AS rows_used")
def metadata_round_trip(spark, sf):
    days, path = T.rain_and_flow(spark, sf), scratch(spark, "metadata")
    names = select.features_except(select.rename(days, {"river_discharge_m3s": "target"}), ["location", "date", "target"])
    files.write_feature_list(spark, names, f"{path}-features")
    files.write_metadata(days.agg(F.count("*").alias("rows_used")), path)
    read = files.read_feature_list(spark, f"{path}-features")
    rows = spark.read.schema("rows_used bigint").json(path)
    return rows.select(F.explode(F.array(*[F.lit(c) for c in read])).alias("feature"), "rows_used")


@case(f"WITH {Q.BOTH} SELECT location, date, round(rain_sum_mm, 6) AS rain_total_mm, round(rain_max_1h, 6) AS rain_max_1h FROM days")
def renamed_by_pattern(spark, sf):
    days = T.rain_and_flow(spark, sf)
    kept = days.select("location", "date", *select.columns_matching(days, "^rain_"))
    return rounded(select.rename(kept, {"rain_sum_mm": "rain_total_mm"}))


@case("SELECT unnest(['columns', 'empty', 'fit']) AS guard, true AS raised, (SELECT count(*) FROM orders) AS n")
def guards(spark, sf):
    """Wrong inputs must be errors: a missing column, an empty table, statistics of another feature list."""
    orders, path = T.load(spark, sf, "orders"), scratch(spark, "scaler")
    files.save_stats(fit_scaler(orders, ["o_totalprice"]), path)
    checks = {
        "columns": lambda: select.require_columns(orders, ["o_orderkey", "no_such_column"]),
        "empty": lambda: select.require_rows(orders.filter("o_orderkey < 0")),
        "fit": lambda: files.load_stats(spark, path, expect=["another"]),
    }
    raised = []
    for name, check in checks.items():
        try:
            check()
            raised.append((name, False))
        except ValueError:
            raised.append((name, True))
    cells = F.array(*[F.struct(F.lit(n).alias("guard"), F.lit(r).alias("raised")) for n, r in raised])
    return orders.agg(F.count("*").alias("n")).select(F.explode(cells).alias("c"), "n").select("c.*", "n")


# -- trees ---------------------------------------------------------------------------

# With at most 32 different values every cut between two neighbours is tried, so that SQL can find the same one.
STUMP_FEATURES = ("l_linenumber", "tax", "discount")
STUMP = """rows AS (SELECT CAST(l_quantity >= 25 AND l_linenumber >= 3 OR l_discount > 0.08 AS INTEGER) AS label,
  CAST(l_linenumber AS DOUBLE) AS l_linenumber, round(l_tax * 100) AS tax, round(l_discount * 100) AS discount FROM lineitem)"""
STUMP_SQL = f"""WITH {STUMP}, long AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS x, label FROM rows" for c in STUMP_FEATURES)}),
sums AS (SELECT feature, x, count(*) AS n, sum(label) AS pos FROM long GROUP BY 1, 2),
cuts AS (SELECT feature, x, sum(n) OVER w AS nl, sum(pos) OVER w AS pl, sum(n) OVER (PARTITION BY feature) AS nt, sum(pos) OVER (PARTITION BY feature) AS pt
  FROM sums WINDOW w AS (PARTITION BY feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
gini AS (SELECT *, nl * 2 * (pl / nl) * (1 - pl / nl) + (nt - nl) * 2 * ((pt - pl) / (nt - nl)) * (1 - (pt - pl) / (nt - nl)) AS impurity FROM cuts WHERE nl < nt),
best AS (SELECT * FROM gini ORDER BY impurity LIMIT 1),
sides AS (SELECT nl AS n, pl AS pos FROM best UNION ALL SELECT nt - nl, pt - pl FROM best)
"""


def _stump_rows(spark, sf):
    label = ((F.col("l_quantity") >= 25) & (F.col("l_linenumber") >= 3)) | (F.col("l_discount") > 0.08)
    rows = T.load(spark, sf, "lineitem").select(
        label.cast("int").alias("label"), F.col("l_linenumber").cast("double").alias("l_linenumber"),
        F.round(F.col("l_tax") * 100).alias("tax"), F.round(F.col("l_discount") * 100).alias("discount"),
    )
    # The features as a sequence of one step, flattened the way the models take it.
    steps = rows.select("label", F.array(F.array(*STUMP_FEATURES)).alias("sequence"))
    return S.with_vector(S.flatten_sequences(steps)).select("label", "features")


def _stump_scores(spark, sf):
    from riverframe.operators import models as M

    rows = _stump_rows(spark, sf)
    return M.positive_probability(M.fit_tree(rows, depth=1, weight=None).transform(rows))


@case(STUMP_SQL + "SELECT round(pos / n, 6) AS p1, CAST(pos / n > 0.4 AS INTEGER) AS predicted, CAST(n AS BIGINT) AS n_rows, CAST(pos AS BIGINT) AS n_positive FROM sides")
def tree_stump(spark, sf):
    """A tree of one cut: its leaves and decisions follow from counts."""
    scored = _stump_scores(spark, sf).select("label", F.round("p1", 6).alias("p1"), C.decide("p1", 0.4).cast("int").alias("predicted"))
    return scored.groupBy("p1", "predicted").agg(F.count("*").alias("n_rows"), F.sum("label").cast("bigint").alias("n_positive"))


STUMP_JUDGED = """j AS (SELECT CAST(pos / n >= 0.4 AS INTEGER) AS predicted, n, pos FROM sides),
m AS (SELECT sum(pos * predicted) AS tp, sum((n - pos) * predicted) AS fp, sum(pos * (1 - predicted)) AS fn, sum((n - pos) * (1 - predicted)) AS tn FROM j)
"""


@case(STUMP_SQL.rstrip() + ", " + STUMP_JUDGED + "SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM m")
def tree_evaluated(spark, sf):
    """All tables of an evaluation at one cut; the first of them with its counts."""
    tables = evaluate.evaluate(_stump_scores(spark, sf), cut=0.4)
    m = tables["metrics"]
    return rounded(m.select(*[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")], "accuracy"))


@case(f"""WITH {Q.PAIRED}, n AS (SELECT location, greatest(count(*) - 7, 0) AS m FROM days GROUP BY 1)
SELECT CAST(sum(m - floor(m * 0.8::DOUBLE)) AS BIGINT) AS n_rows, true AS in_range, true AS decided FROM n""")
def forest_checks(spark, sf):
    """What must hold for any forest of a hundred trees: one score for every test row, in range, decided at the cut."""
    p1 = F.col("p1")
    scored = REGISTRY["forest_scores"](spark, sf)
    right = (F.abs(p1 - 0.4) < 1e-6) | (F.col("predicted") == (p1 > 0.4).cast("int"))
    return scored.agg(F.count("*").alias("n_rows"), F.every(p1.between(0, 1)).alias("in_range"), F.every(right).alias("decided"))


# -- profile -------------------------------------------------------------------------


def _profile(name: str) -> Callable:
    def run(spark, sf):
        report = profile.profile(T.rain_and_flow(spark, sf), "date", values=["rain_sum_mm", "river_discharge_m3s"], rain="rain_sum_mm")
        return report[name]

    return run


@case(f"""WITH {Q.BOTH} SELECT CASE WHEN rain_sum_mm > 0 THEN 'Rain' ELSE 'No Rain' END AS rain_label, count(*) AS n,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM days GROUP BY 1""")
def profile_rain_share(spark, sf):
    return rounded(_profile("rain_share")(spark, sf), 2)


@case(Q.ORACLES["profile_nulls"])
def profile_null_report(spark, sf):
    return rounded(_profile("nulls")(spark, sf), 4)


@case(Q.ORACLES["describe_by_key"])
def profile_describe_by_key(spark, sf):
    return rounded(_profile("describe_by_key")(spark, sf), 5)


@case(f"""WITH {Q.BOTH}, ranked AS (SELECT location, date, rain_sum_mm, row_number() OVER (ORDER BY rain_sum_mm DESC, date DESC, location DESC) AS place FROM days)
SELECT location, date, round(rain_sum_mm, 6) AS rain_sum_mm, CAST(place AS INTEGER) AS place FROM ranked WHERE place <= 25""")
def ranked_days(spark, sf):
    """The wettest days in their order."""
    days = T.rain_and_flow(spark, sf).select("location", "date", "rain_sum_mm")
    top = stats.top_k(days, ["rain_sum_mm", "date", "location"], 25)
    return rounded(top.withColumn("place", F.row_number().over(_wettest())))


def _wettest():
    from pyspark.sql import Window

    # Twenty-five rows: one task may order them.
    return Window.orderBy(F.desc("rain_sum_mm"), F.desc("date"), F.desc("location"))


# -- full runs -----------------------------------------------------------------------

NAMES = features.feature_names(PRIORITIES)


def _features(spark, sf):
    """The unscaled feature table, written once: training and scoring read it several times."""
    return settle(features.build_features(T.order_readings(spark, sf), T.rain_forecast(spark, sf), T.order_target(spark, sf), PRIORITIES, scale=None), "features")


FULL = f"WITH RECURSIVE {Q.OBSERVED}, {Q.CHOSEN}, {Q.memory_sql('allrain', 'date', 'target')}"
COMPLETE = " AND ".join(f'"{c}" IS NOT NULL' for c in NAMES)


def scaled_sql(source: str, columns: Sequence[str], keep: str) -> str:
    """Columns of ``source`` with the scaler of the rows of history that are complete."""
    cells = ", ".join(f'(t."{c}" - f."m_{c}") / CASE WHEN f."s_{c}" = 0 THEN 1 ELSE f."s_{c}" END AS "{c}"' for c in columns)
    return f"SELECT {keep}, {cells} FROM {source} t, fitted f"


FITTED = "fitted AS (SELECT " + ", ".join(f'avg("{c}") AS "m_{c}", stddev_pop("{c}") AS "s_{c}"' for c in NAMES) + f" FROM tab WHERE data_type = 'historical' AND river_discharge_m3s IS NOT NULL AND {COMPLETE})"


@case(f"""{FULL}, {FITTED}, ready AS (SELECT * FROM tab WHERE {COMPLETE}), scaled AS ({scaled_sql('ready', NAMES, 't.location, t.date, t.data_type')}),
seq AS (SELECT location, date, data_type, avg("{NAMES[0]}") OVER w AS predicted_discharge, count(*) OVER w AS n FROM scaled
  WINDOW w AS (PARTITION BY location ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
SELECT location, date, round(predicted_discharge, 5) AS predicted_discharge,
       CASE WHEN predicted_discharge > 300 THEN 'HIGH' WHEN predicted_discharge > 150 THEN 'MEDIUM' ELSE 'LOW' END AS flood_risk
FROM seq WHERE n = 14 AND data_type = 'forecast'""")
def score_forecast_full(spark, sf):
    """Feature table of history and forecast, scaler of the training rows, sequences, model and risk; forecast days alone are scored."""
    table = _features(spark, sf)
    made = training.make_training_set(table, NAMES, n=14)
    days = table.dropna(subset=list(NAMES))
    return rounded(scoring.score_forecast(days, NAMES, made.scaler, mean_model(), 14, ahead=("data_type", "forecast")), 5)


@case(f"""{FULL}, ready AS (SELECT * FROM tab WHERE data_type = 'historical' AND river_discharge_m3s IS NOT NULL AND {COMPLETE}),
n AS (SELECT location, count(*) AS n FROM ready GROUP BY 1)
SELECT location, CAST(greatest(n - 14, 0) AS BIGINT) AS n_sequences, CAST(floor(greatest(n - 14, 0) * 0.8::DOUBLE) AS BIGINT) AS n_train FROM n""")
def training_set_full(spark, sf):
    """The training set with its history filter and all features: sequences and training share per key."""
    made = training.make_training_set(_features(spark, sf), NAMES, n=14)
    parts = made.sequences.groupBy("location").agg(F.count("*").alias("n_sequences"), F.count_if(F.col("split") == "train").alias("n_train"))
    return made.counts.select("location").join(parts, "location", "left").fillna(0, ["n_sequences", "n_train"])


@case(f"""{FULL}, ready AS (SELECT * FROM tab WHERE river_discharge_m3s IS NOT NULL AND {COMPLETE}), n AS (SELECT location, count(*) AS n, max(date) AS last FROM ready GROUP BY 1)
SELECT location, CAST(greatest(date_diff('day', last, DATE '{HORIZON_END}'), 0) AS BIGINT) AS n_days FROM n WHERE n >= 14 AND last < DATE '{HORIZON_END}'""")
def horizon_forecast_full(spark, sf):
    """Days ahead that each key is scored for, with scaler, all features and a target."""
    table = _features(spark, sf)
    made = training.make_training_set(table, NAMES, n=14)
    scored, _ = scoring.forecast_horizon(table, NAMES, made.scaler, mean_model(), HORIZON_END, 14)
    return scored.groupBy("location").agg(F.count("*").alias("n_days"))


VIEW = dashboard.View(location="2-HIGH", start="1997-01-01", end="1998-12-31")
IN_VIEW = "location = '2-HIGH' AND date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"


def _slice(spark, sf):
    scored = T.flow_daily(spark, sf).withColumn("flood_risk", C.risk_class("river_discharge_m3s"))
    return dashboard.dashboard_slice(T.rain_daily(spark, sf), T.order_readings(spark, sf), T.flow_daily(spark, sf), scored, VIEW)


@case(f"WITH {Q.RAIN} SELECT location, date, {Q.r('rain_sum_mm', 'rain_max_1h')} FROM rain WHERE {IN_VIEW}")
def dashboard_slice_features(spark, sf):
    return rounded(_slice(spark, sf)["features"])


@case(f"WITH {Q.FLOW} SELECT location, date, round(river_discharge_m3s, 6) AS river_discharge_m3s, {Q.RISK} AS flood_risk FROM flow WHERE {IN_VIEW}")
def dashboard_slice_forecast(spark, sf):
    return rounded(_slice(spark, sf)["forecast"])


@case(f"""WITH {Q.FLOW}, k AS (SELECT {Q.RISK} AS risk FROM flow WHERE {IN_VIEW})
SELECT count(*) AS n_days, count(*) FILTER (WHERE risk = 'HIGH') AS n_high, count(*) FILTER (WHERE risk = 'MEDIUM') AS n_medium,
       count(*) FILTER (WHERE risk = 'LOW') AS n_low FROM k""")
def dashboard_slice_risk(spark, sf):
    return _slice(spark, sf)["risk"]
