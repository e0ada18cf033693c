"""Registered queries: every operator on the driver's tables, each next to its expected result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import bands as B
from tidewatch.functions.clock import capped_age, epoch_seconds, hours_since, round_half_up, shift
from tidewatch.functions.keys import row_id
from tidewatch.functions.keywords import LabelRule, label_kinds, matching_items
from tidewatch.operators import cohort as C
from tidewatch.operators import folds as FO
from tidewatch.operators import frames as FR
from tidewatch.operators import metrics as M
from tidewatch.operators import rolling as R
from tidewatch.operators import text as TX
from tidewatch.operators.hourly import (Covered, Events, Intervals, Latest, Seen, Total, hourly_grid, hourly_signals,
                                        hourly_state, pivot_latest)
from tidewatch.operators.onset import clean_labels, first_time_where, label_hours
from tidewatch.operators.pairs import pair_within
from tidewatch.plans import early_warning as EW
from tidewatch.plans import oracle as O
from tidewatch.plans import testbed
from tidewatch.session import configure
from tidewatch.sources import files, sinks
from tidewatch.sources.storage import fresh_path
from tidewatch.sources.tables import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # zoned columns of the given tables read as in the SQL
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Floating columns rounded, with negative zero made positive, so that two engines print the same.

    Elapsed hours get more digits: whole microseconds divided by an hour would otherwise end exactly between two."""
    return df.select(*[(F.round(c, O.digits(c)) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- shared inputs ----------------------------------------------------------------------------------------------------


def user_events(spark, d) -> DataFrame:
    return load(spark, d, "events").select("user_id", "ts", "event_type", "value", "event_id")


def user_grid(spark, d) -> DataFrame:
    return hourly_grid(C.range_by_group(load(spark, d, "events"), ["user_id"], "ts", "lo", "hi"), "lo", "hi").select(
        "user_id", "t")


def user_sources(spark, d, *kinds: str) -> dict:
    ev = user_events(spark, d)
    wanted = ev.filter(F.col("event_type").isin(*kinds)) if kinds else ev
    return {"events": Events(wanted, "ts", "value", "event_type", "event_id")}


KINDS = ("click", "purchase", "view", "error", "signup")


def user_wide(spark, d) -> DataFrame:
    return hourly_state(user_grid(spark, d), ["user_id"], user_sources(spark, d),
                        [Latest(f"v_{k}", "events", k) for k in KINDS])


def only(events: DataFrame, kind: str) -> DataFrame:
    return events.filter(F.col("event_type") == kind)


def scored_docs(spark, d) -> DataFrame:
    """Documents with a label and a deterministic score that has many ties."""
    labels = load(spark, d, "labels")
    docs = load(spark, d, "documents").select("doc_id", "n_chars", "lang")
    return docs.join(labels, "doc_id").select(
        "doc_id", "lang", F.col("toxic").alias("y"),
        (F.pmod(F.col("n_chars") * 37, F.lit(1000)) / F.lit(1000.0)).alias("p"))


DOCS = """docs AS (SELECT doc_id, lang, toxic AS y, (n_chars * 37 % 1000) / 1000.0 AS p
  FROM documents JOIN labels USING (doc_id))"""

# --- cohort, keywords, restriction ------------------------------------------------------------------------------------


@query("first_event_cohort", """
WITH f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_custkey, o_orderkey, o_orderdate, c_name, n_name, CAST(floor(c_acctbal / 100 + 0.5) AS INTEGER) AS level
FROM f JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
WHERE rn = 1 AND c_acctbal / 100 >= 18""")
def first_event_cohort(spark, d):
    first = C.first_per(load(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])
    customers = load(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    nations = load(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    full = C.attach_context(first, customers, nations, "o_custkey", "c_nationkey")
    return full.filter(F.col("c_acctbal") / 100 >= 18).select(
        "o_custkey", "o_orderkey", "o_orderdate", "c_name", "n_name",
        round_half_up(F.col("c_acctbal") / 100).alias("level"))


BORN = "TIMESTAMP '1905-01-01 00:00:00' + to_days(CAST(o_custkey * 7919 % 36000 AS INTEGER))"


@query("capped_age_years", f"""
WITH b AS (SELECT o_orderkey, o_orderdate, {BORN} AS dob FROM orders),
a AS (SELECT *, CASE WHEN o_orderdate >= dob + INTERVAL 89 YEAR THEN 90.0
    ELSE (epoch_us(o_orderdate) - epoch_us(dob)) / 1e6 / 31557600.0 END AS raw FROM b)
SELECT o_orderkey, round(raw, 9) + 0.0 AS age_years_raw, CAST(floor(raw + 0.5) AS INTEGER) AS age_years,
    year(o_orderdate)::INTEGER AS order_year FROM a WHERE raw >= 18.0""")
def capped_age_years(spark, d):
    born = F.expr("TIMESTAMP_NTZ '1905-01-01 00:00:00'") + F.make_dt_interval(
        (F.col("o_custkey") * 7919 % 36000).cast("int"))
    at = F.col("o_orderdate").cast("timestamp_ntz")
    aged = load(spark, d, "orders").select("o_orderkey", at.alias("at"), born.alias("dob")).withColumn(
        "age_years_raw", capped_age("dob", "at")).filter("age_years_raw >= 18.0")
    return rounded(aged.select("o_orderkey", "age_years_raw", round_half_up("age_years_raw").alias("age_years"),
                               F.year("at").alias("order_year")))


@query("keyword_contains", """
SELECT l_partkey, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%izm%' OR lower(p_name) LIKE '%Bolt%' GROUP BY l_partkey""")
def keyword_contains(spark, d):
    items = matching_items(load(spark, d, "part"), ("ring", "izm", "Bolt"), "p_partkey", "p_name")
    lines = load(spark, d, "lineitem").select("l_partkey")
    return C.in_list(lines, items.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"))


@query("keyword_prefix", """
SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE 're%' OR lower(p_name) LIKE 'blue b%'""")
def keyword_prefix(spark, d):
    parts = load(spark, d, "part").select("p_partkey", "p_name")
    return C.in_list(parts, matching_items(parts, ("re", "blue b"), "p_partkey", "p_name", prefix=True), "p_partkey")


@query("dictionary_kind", """
SELECT p_partkey, 'warm' AS kind FROM part WHERE lower(p_name) LIKE 'red%' OR lower(p_name) LIKE 'hot%'
UNION ALL SELECT p_partkey, 'red' FROM part WHERE lower(p_name) LIKE 'red%' AND lower(p_name) NOT LIKE '%rod%'
UNION ALL SELECT p_partkey, 'cold' FROM part WHERE lower(p_name) LIKE 'cold%' AND lower(p_type) NOT LIKE '%mall%'""")
def dictionary_kind(spark, d):
    rules = (LabelRule("warm", ("red", "hot")), LabelRule("red", ("red",), label_without="rod"),
             LabelRule("cold", ("cold",), category_without="mall"))
    return label_kinds(load(spark, d, "part"), rules, "p_partkey", "p_name", "p_type")


@query("idlist_semi", """
SELECT l_returnflag, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2)))::DOUBLE AS qty FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size % 7 = 0) GROUP BY l_returnflag""")
def idlist_semi(spark, d):
    """An id list file is written from the dictionary, read back with its checks and used as a filter."""
    path = fresh_path(spark, "ids")
    ids = load(spark, d, "part").filter("p_size % 7 = 0").select(F.col("p_partkey").cast("int").alias("itemid"))
    ids.write.option("header", True).csv(path)
    listed = files.load_idlist(spark, path, "seven").withColumnRenamed("itemid", "l_partkey")
    kept = C.in_list(load(spark, d, "lineitem"), listed, "l_partkey")
    return kept.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("qty"))


HALF = "least((day(ts) - 1) // 15, 1)"


@query("window_restrict", f"""
WITH b AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events WHERE {HALF} = 1 GROUP BY user_id)
SELECT user_id, event_id, ts, value FROM events JOIN b USING (user_id)
WHERE ts BETWEEN lo - INTERVAL 48 HOUR AND hi AND value IS NOT NULL""")
def window_restrict(spark, d):
    ev = user_events(spark, d)
    half = F.least(F.floor((F.dayofmonth("ts") - 1) / 15), F.lit(1))
    bounds = C.range_by_group(ev.filter(half == 1), ["user_id"], "ts", "lo", "hi")
    kept = C.restrict_events(ev, bounds, "user_id", "ts", "lo", "hi", before=48)
    return C.drop_null(kept, "value").select("user_id", "event_id", "ts", "value")


INTERVALS = """iv AS (SELECT user_id, event_id, ts AS s, coalesce(CASE WHEN event_id % 3 <> 0
  THEN ts + to_hours(CAST(event_id % 40 - 2 AS INTEGER)) END, ts + INTERVAL 1 HOUR) AS e FROM events
  WHERE event_type = 'signup')"""


def intervals(spark, d) -> DataFrame:
    ev = only(user_events(spark, d), "signup")
    end = F.when(F.col("event_id") % 3 != 0,
                 F.col("ts") + F.make_dt_interval(F.lit(0), (F.col("event_id") % 40 - 2).cast("int")))
    return ev.select("user_id", "event_id", F.col("ts").alias("starttime"), end.alias("endtime"))


@query("interval_restrict", f"""
WITH {INTERVALS}, b AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events WHERE {HALF} = 1 GROUP BY user_id)
SELECT user_id, event_id, s AS starttime, e AS endtime FROM iv JOIN b USING (user_id)
WHERE s <= hi AND e >= lo - INTERVAL 24 HOUR""")
def interval_restrict(spark, d):
    half = F.least(F.floor((F.dayofmonth("ts") - 1) / 15), F.lit(1))
    bounds = C.range_by_group(user_events(spark, d).filter(half == 1), ["user_id"], "ts", "lo", "hi")
    kept = C.restrict_intervals(intervals(spark, d), bounds, "user_id", "starttime", "endtime", "lo", "hi", before=24)
    return kept.select("user_id", "event_id", "starttime", "endtime")


@query("pair_within_min", """
WITH a AS (SELECT user_id, ts AS c FROM events WHERE event_type = 'error'),
b AS (SELECT user_id, ts AS x FROM events WHERE event_type = 'purchase')
SELECT user_id, min(least(c, x)) AS t_pair FROM a JOIN b USING (user_id)
WHERE x BETWEEN c AND c + INTERVAL 72 HOUR OR c BETWEEN x AND x + INTERVAL 24 HOUR GROUP BY user_id""")
def pair_within_min(spark, d):
    ev = user_events(spark, d)
    return pair_within(only(ev, "error"), only(ev, "purchase"), "user_id", "ts", "ts", after=72, before=24)


# --- hourly grid ------------------------------------------------------------------------------------------------------


@query("hourly_grid", f"WITH {O.GRID} SELECT user_id, t FROM grid")
def hourly_grid_query(spark, d):
    return user_grid(spark, d)


@query("asof_latest", f"""
WITH {O.GRID}, {O.asof('v_click', 'click')}, {O.asof('v_purchase', 'purchase', 6)}
SELECT * FROM v_click JOIN v_purchase USING (user_id, t)""")
def asof_latest(spark, d):
    return hourly_signals(user_grid(spark, d), ["user_id"], user_sources(spark, d, "click", "purchase"),
                          [Latest("v_click", "events", "click"), Latest("v_purchase", "events", "purchase", 6)])


@query("asof_pivot_wide", f"{O.WIDE} SELECT user_id, t, v_click AS click, v_purchase AS purchase, v_view AS view, "
                          "v_error AS error, v_signup AS signup FROM wide")
def asof_pivot_wide(spark, d):
    source = user_sources(spark, d)["events"]
    return pivot_latest(user_grid(spark, d), ["user_id"], source, {k: k for k in KINDS})


@query("latest_per_group", """
SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_group(spark, d):
    return C.latest_per(user_events(spark, d), ["user_id", "event_type"], "ts", "event_id").select(
        "user_id", "event_type", "event_id", "ts", "value")


def _sum_sql(w: int, name: str) -> str:
    return f"round(sum(e.value) FILTER (WHERE e.ts > g.t - INTERVAL {w} HOUR), 9) + 0.0 AS {name}"


@query("trailing_sum_24h", f"""
WITH {O.GRID} SELECT g.user_id, g.t, {_sum_sql(24, 'sum_24h')} FROM grid g LEFT JOIN events e
ON e.user_id = g.user_id AND e.ts <= g.t AND e.ts > g.t - INTERVAL 24 HOUR GROUP BY g.user_id, g.t""")
def trailing_sum_24h(spark, d):
    return rounded(hourly_signals(user_grid(spark, d), ["user_id"], user_sources(spark, d), [Total("sum_24h", "events", 24)]))


@query("trailing_sums_multi", f"""
WITH {O.GRID}, both_kinds AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT user_id, ts, value / 2 FROM events WHERE event_type = 'view')
SELECT g.user_id, g.t, {_sum_sql(6, 'sum_6h')}, {_sum_sql(12, 'sum_12h')}, {_sum_sql(24, 'sum_24h')}
FROM grid g LEFT JOIN both_kinds e ON e.user_id = g.user_id AND e.ts <= g.t AND e.ts > g.t - INTERVAL 24 HOUR
GROUP BY g.user_id, g.t""")
def trailing_sums_multi(spark, d):
    ev = user_events(spark, d)
    both = only(ev, "purchase").unionByName(only(ev, "view").withColumn("value", F.col("value") / 2))
    return rounded(hourly_signals(user_grid(spark, d), ["user_id"], {"both": Events(both, "ts")},
                                  [Total(f"sum_{w}h", "both", w) for w in (6, 12, 24)]))


@query("interval_covered", f"""
WITH {O.GRID}, {INTERVALS}
SELECT user_id, t, EXISTS (SELECT 1 FROM iv WHERE iv.user_id = grid.user_id AND s <= t AND e > t) AS covered FROM grid""")
def interval_covered(spark, d):
    filled = intervals(spark, d).withColumn("endtime", F.coalesce("endtime", shift("starttime", 1)))
    return hourly_signals(user_grid(spark, d), ["user_id"], {"iv": Intervals(filled)}, [Covered("covered", ("iv",))])


@query("exists_lookback", f"""
WITH {O.GRID}
SELECT user_id, t, EXISTS (SELECT 1 FROM events e WHERE e.user_id = grid.user_id AND e.ts <= t
  AND e.ts > t - INTERVAL 12 HOUR AND event_type IN ('error', 'signup')) AS seen FROM grid""")
def exists_lookback(spark, d):
    ev = user_events(spark, d)
    sources = {k: Events(only(ev, k), "ts", None) for k in ("error", "signup")}
    return hourly_signals(user_grid(spark, d), ["user_id"], sources, [Seen("seen", ("error", "signup"), None, 12)])


# --- scores and labels ------------------------------------------------------------------------------------------------

LADDER = """
CASE WHEN v_view > 0 AND v_click IS NOT NULL THEN v_click / (v_view / 100.0) END AS pf,
CASE WHEN v_view > 0 AND v_error IS NOT NULL THEN v_error / (v_view / 100.0) END AS sf"""
SCORE_SQL = f"""{O.WIDE}, r AS (SELECT *, {LADDER} FROM wide),
s AS (SELECT user_id, t,
  CASE WHEN pf IS NOT NULL THEN CASE WHEN pf >= 400 THEN 0 WHEN pf >= 300 THEN 1 WHEN pf >= 200 THEN 2
      WHEN pf >= 100 THEN 3 ELSE 4 END
    WHEN sf IS NOT NULL THEN CASE WHEN sf >= 235 THEN 0 WHEN sf >= 214 THEN 1 WHEN sf >= 201 THEN 2
      WHEN sf >= 150 THEN 3 ELSE 4 END END AS two_source,
  CASE WHEN v_click IS NULL THEN NULL WHEN v_click >= 150 THEN 0 WHEN v_click >= 100 THEN 1 WHEN v_click >= 50 THEN 2
    WHEN v_click >= 20 THEN 3 ELSE 4 END AS falling,
  CASE WHEN v_view IS NULL THEN NULL WHEN v_view < 1.2 THEN 0 WHEN v_view < 2 THEN 1 WHEN v_view < 6 THEN 2
    WHEN v_view < 12 THEN 3 ELSE 4 END AS rising,
  CASE WHEN v_error IS NOT NULL THEN CASE WHEN v_error < 1.2 THEN 0 WHEN v_error < 2 THEN 1 WHEN v_error < 3.5 THEN 2
      WHEN v_error < 5 THEN 3 ELSE 4 END
    WHEN v_signup IS NOT NULL THEN CASE WHEN v_signup >= 500 THEN 0 WHEN v_signup >= 200 THEN 3 ELSE 4 END END AS fallback,
  CASE WHEN v_purchase >= 50 THEN 3 WHEN v_purchase < 50 AND v_signup IS NOT NULL
    THEN CASE WHEN v_signup >= 70 THEN 0 ELSE 1 END END AS gated FROM r)"""


def ladders(spark, d) -> DataFrame:
    wide = user_wide(spark, d).withColumns({
        "pf": B.guarded_ratio("v_click", "v_view"), "sf": B.guarded_ratio("v_error", "v_view"),
        "flag": F.col("v_purchase") >= 50})
    return wide.select(
        "user_id", "t", B.two_source_bands("pf", "sf", EW.OXYGEN_CUTS, EW.SATURATION_CUTS).alias("two_source"),
        B.bands("v_click", EW.PLATELET_CUTS, "down").alias("falling"),
        B.bands("v_view", EW.BILIRUBIN_CUTS, "up").alias("rising"),
        B.bands_with_fallback("v_error", EW.CREATININE_CUTS, "v_signup", EW.URINE_CUTS, EW.URINE_POINTS).alias("fallback"),
        B.gated_score("flag", "v_signup", EW.PRESSURE_CUT).alias("gated"))


@query("score_ladder", SCORE_SQL + " SELECT * FROM s")
def score_ladder(spark, d):
    return ladders(spark, d)


TOTAL = " + ".join(f"coalesce({c}, 0)" for c in ("two_source", "falling", "rising", "fallback", "gated"))


@query("score_total", SCORE_SQL + f" SELECT user_id, t, CAST({TOTAL} AS INTEGER) AS total FROM s")
def score_total(spark, d):
    return ladders(spark, d).select("user_id", "t", B.null_safe_total(
        "two_source", "falling", "rising", "fallback", "gated").alias("total"))


@query("unit_normalise", """
WITH n AS (SELECT event_id, CASE WHEN value / 100 BETWEEN 0.15 AND 1.5 THEN value / 100 * 100.0
    WHEN value / 100 BETWEEN 15 AND 100 THEN value / 100 END AS fio2,
  CASE WHEN value BETWEEN 50 AND 100 THEN value END AS spo2 FROM events)
SELECT event_id, round(fio2, 9) + 0.0 AS fio2, round(spo2, 9) + 0.0 AS spo2,
  round(CASE WHEN spo2 BETWEEN 50 AND 100 AND fio2 BETWEEN 15 AND 100 THEN spo2 / (fio2 / 100.0) END, 9) + 0.0 AS ratio
FROM n""")
def unit_normalise(spark, d):
    ev = load(spark, d, "events").withColumn("low", F.col("value") / 100)
    clean = ev.select("event_id", B.unit_normalise("low").alias("fio2"), B.range_clean("value", 50, 100).alias("spo2"))
    return rounded(clean.withColumn("ratio", B.clean_ratio("spo2", "fio2")))


ANCHORS = "anchors AS (SELECT user_id, min(ts) AS q FROM events WHERE event_type = 'purchase' GROUP BY user_id)"
ONSET_SQL = f"""{O.WIDE}, {ANCHORS},
onset AS (SELECT w.user_id, min(w.t) FILTER (WHERE w.v_error >= 40 AND w.t BETWEEN q - INTERVAL 48 HOUR
  AND q + INTERVAL 120 HOUR) AS t_onset FROM wide w LEFT JOIN anchors USING (user_id) GROUP BY w.user_id)"""


def anchors(spark, d) -> DataFrame:
    return C.min_by_group(only(user_events(spark, d), "purchase"), ["user_id"], "ts", "q")


def user_onset(spark, d) -> DataFrame:
    errors = hourly_signals(user_grid(spark, d), ["user_id"], user_sources(spark, d, "error"),
                            [Latest("v_error", "events", "error")])
    return first_time_where(errors, ["user_id"], "t", F.col("v_error") >= 40, anchors(spark, d), "user_id", "q", 48, 120)


@query("onset_min_filter", ONSET_SQL + " SELECT * FROM onset")
def onset_min_filter(spark, d):
    return user_onset(spark, d)


LABEL_SQL = f"""{ONSET_SQL}, labelled AS (SELECT user_id, t, t_onset, CASE WHEN t < t_onset
  AND t_onset < t + INTERVAL 6 HOUR THEN 1 WHEN t_onset IS NULL OR t + INTERVAL 6 HOUR <= t_onset THEN 0 END AS label6h
  FROM grid JOIN onset USING (user_id))"""


@query("horizon_label", LABEL_SQL + " SELECT * FROM labelled WHERE label6h IS NOT NULL")
def horizon_label(spark, d):
    labelled = label_hours(user_grid(spark, d), user_onset(spark, d), ["user_id"], "t", 6)
    clean_labels(labelled, view="labels6h_clean")
    return spark.table("labels6h_clean").select("user_id", "t", "t_onset", "label6h")


@query("elapsed_hours", f"""
WITH {O.GRID}, {ANCHORS} SELECT g.user_id, g.t, round((epoch_us(t) - epoch_us(lo)) / 3.6e9, 11) + 0.0 AS since_start,
  round((epoch_us(t) - epoch_us(q)) / 3.6e9, 11) + 0.0 AS since_anchor
FROM grid g JOIN bounds USING (user_id) LEFT JOIN anchors ON anchors.user_id = g.user_id""")
def elapsed_hours(spark, d):
    starts = C.range_by_group(load(spark, d, "events"), ["user_id"], "ts", "lo", "hi")
    # times are attached to users, not to their hours, so that no join sorts the grid; rows without a user have no start to join
    grid = hourly_grid(C.attach_optional(starts, anchors(spark, d), "user_id"), "lo", "hi")
    since_start = F.when(F.col("user_id").isNotNull(), hours_since("t", "lo"))
    return rounded(grid.select("user_id", "t", since_start.alias("since_start"), hours_since("t", "q").alias("since_anchor")))


# --- windows ----------------------------------------------------------------------------------------------------------

PAIR = {"click": "v_click", "view": "v_view"}


@query("lag_diff", f"""{O.WIDE}, l AS (SELECT user_id, t, v_click, v_view,
  lag(v_click, 1) OVER w AS click_lag1, lag(v_click, 2) OVER w AS click_lag2,
  lag(v_view, 1) OVER w AS view_lag1, lag(v_view, 2) OVER w AS view_lag2
  FROM wide WINDOW w AS (PARTITION BY user_id ORDER BY t))
SELECT user_id, t, click_lag1, click_lag2, view_lag1, view_lag2,
  round(v_click - click_lag1, 9) + 0.0 AS click_diff1, round(click_lag1 - click_lag2, 9) + 0.0 AS click_diff2,
  round(v_view - view_lag1, 9) + 0.0 AS view_diff1, round(view_lag1 - view_lag2, 9) + 0.0 AS view_diff2 FROM l""")
def lag_diff(spark, d):
    w = R.grid_window(["user_id"], "_h")
    lagged = user_wide(spark, d).select("*", *R.lags(w, PAIR)).select("*", *R.diffs(PAIR))
    names = [f"{p}_{s}{k}" for p in PAIR for s in ("lag", "diff") for k in (1, 2)]
    return rounded(lagged.select("user_id", "t", *names))


@query("rolling_stats", f"""{O.WIDE} SELECT user_id, t, round(avg(v_click) OVER w6, 9) + 0.0 AS click_mean_6h,
  round(stddev_samp(v_click) OVER w6, 9) + 0.0 AS click_std_6h, min(v_click) OVER w6 AS click_min_6h,
  max(v_click) OVER w6 AS click_max_6h, round(avg(v_click) OVER w12, 9) + 0.0 AS click_mean_12h,
  min(v_click) OVER w12 AS click_min_12h, CASE WHEN count(v_click) OVER w6 = 0 THEN 1 ELSE 0 END AS click_miss_6h
FROM wide WINDOW w6 AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN 5 PRECEDING AND CURRENT ROW),
  w12 AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def rolling_stats(spark, d):
    w = R.grid_window(["user_id"], "_h")
    return rounded(user_wide(spark, d).select(
        "user_id", "t", *R.rolling(w, "click", "v_click", ("mean", "std", "min", "max"), 6),
        *R.rolling(w, "click", "v_click", ("mean", "min"), 12), R.all_missing_flag(w, "click", "v_click")))


@query("rolling_slope", f"""{O.WIDE}, s AS (SELECT user_id, t, {O._slope('click', 'v_click', 'user_id')} FROM wide)
SELECT user_id, t, round(click_slope_6h, 9) + 0.0 AS click_slope_6h FROM s""")
def rolling_slope(spark, d):
    w = R.grid_window(["user_id"], "_h")
    timed = user_wide(spark, d).withColumn("_s", epoch_seconds("t"))
    return rounded(timed.select("user_id", "t", R.rolling_slope(w, "click", "v_click", "_s")))


# --- the feature job and its stages -----------------------------------------------------------------------------------

SETTINGS = EW.Settings(last_train_year=testbed.LAST_TRAIN_YEAR)


@query("cohort_context", O.job(O.COHORT) + """ SELECT subject_id, hadm_id, icustay_id, dbsource, intime, outtime, admittime,
  dischtime, dob, round(age_years_raw, 9) + 0.0 AS age_years_raw, age_years FROM cohort""")
def cohort_context(spark, d):
    return rounded(EW.cohort(testbed.reference_tables(spark, d)))


@query("suspicion_times", O.job(O.ANCHOR) + " SELECT hadm_id, tsusp FROM suspicion")
def suspicion_times(spark, d):
    return EW.suspicion(testbed.reference_tables(spark, d))


def job_hours(spark, d) -> DataFrame:
    tables = testbed.reference_tables(spark, d)
    return EW.scored_hours(tables, testbed.reference_ids(tables), SETTINGS)


SCORES_SQL = "subject_id, hadm_id, icustay_id, t, " + ", ".join(EW.SCORES)


@query("score_hours", O.job(O.COHORT, O.ANCHOR, O.HOURS, O.SCORED)
       + f" SELECT {SCORES_SQL}, CAST(sofa_total AS INTEGER) AS sofa_total FROM sofa")
def score_hours(spark, d):
    return EW.sofa_hourly(job_hours(spark, d))


@query("onset_times", O.job(O.COHORT, O.ANCHOR, O.HOURS, O.SCORED) + " SELECT * FROM onset")
def onset_times(spark, d):
    return EW.onsets(job_hours(spark, d))


@query("label_hours", O.job(O.COHORT, O.ANCHOR, O.HOURS, O.SCORED)
       + " SELECT subject_id, hadm_id, icustay_id, t, t_onset, label6h FROM labelled")
def label_hours_query(spark, d):
    return EW.labels(job_hours(spark, d), SETTINGS).select(*EW.KEYS, "t", "t_onset", "label6h")


WHOLE = {*EW.KEYS, "t", "label6h", *EW.SCORES, "sofa_total", "pressor_on", "vent_flag", "dialysis_flag", "age_years",
         "sex", "dbsource", "map_miss_6h", "hr_miss_6h", "rr_miss_6h", "split"}


def wide(spark, d) -> DataFrame:
    tables = testbed.reference_tables(spark, d)
    return EW.features(tables, testbed.reference_ids(tables), SETTINGS)


@query("wide_features", O.job(O.COHORT, O.ANCHOR, O.HOURS, O.SCORED, O.FEATURES) + " SELECT "
       + O.rounded(EW.COLUMNS, set(EW.COLUMNS) - WHOLE).replace("sofa_total,", "CAST(sofa_total AS INTEGER) AS sofa_total,")
       + " FROM features")
def wide_features(spark, d):
    return rounded(wide(spark, d))


@query("split_counts", """
SELECT CASE WHEN year(o_orderdate) <= 1999 THEN 'train' WHEN o_orderdate IS NOT NULL THEN 'test' END AS split,
  count(*) AS n FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def split_counts(spark, d):
    orders = load(spark, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    lines = load(spark, d, "lineitem").select("l_orderkey")
    dated = C.add_from(lines, orders, "l_orderkey", split=B.split_by_year("o_orderdate", 1999))
    return M.count_by(dated, "split")


# --- keys, folds, sets ------------------------------------------------------------------------------------------------

ORDER_ID = "md5(o_custkey || '|' || o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'))"


def keyed_orders(spark, d) -> DataFrame:
    return load(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("t"),
        row_id(["o_custkey", "o_orderkey"], "o_orderdate").alias("row_id"))


@query("row_id", f"SELECT o_orderkey, {ORDER_ID} AS row_id FROM orders")
def row_id_query(spark, d):
    return keyed_orders(spark, d).select("o_orderkey", "row_id")


CHUNKS = f"""chunks AS (SELECT o_orderkey, o_custkey, o_orderdate AS t, CAST(ntile(5) OVER (ORDER BY o_orderdate, {ORDER_ID})
  - 1 AS INTEGER) AS chunk FROM orders)"""


def chunked_orders(spark, d) -> DataFrame:
    return FO.time_chunks(keyed_orders(spark, d), "t", "row_id")


@query("time_chunks", f"WITH {CHUNKS} SELECT o_orderkey, chunk FROM chunks")
def time_chunks(spark, d):
    return chunked_orders(spark, d).select("o_orderkey", "chunk")


@query("group_chunks", """
WITH f AS (SELECT o_custkey, min(o_orderdate) AS first_t FROM orders GROUP BY o_custkey)
SELECT o_custkey, first_t, CAST(ntile(5) OVER (ORDER BY first_t, md5(CAST(o_custkey AS VARCHAR))) - 1 AS INTEGER) AS chunk
FROM f""")
def group_chunks(spark, d):
    return FO.group_time_chunks(keyed_orders(spark, d), "o_custkey", "t").withColumn(
        "first_t", F.col("first_t").cast("timestamp_ntz"))


@query("disjoint_train", f"""
WITH {CHUNKS} SELECT o_orderkey, chunk FROM chunks
WHERE chunk < 1 AND o_custkey NOT IN (SELECT o_custkey FROM chunks WHERE chunk = 1)""")
def disjoint_train(spark, d):
    rows = chunked_orders(spark, d)
    return FO.disjoint_train(rows.filter("chunk < 1"), rows.filter("chunk = 1"), "o_custkey").select("o_orderkey", "chunk")


@query("fold_train_sets", f"""
WITH {CHUNKS}, k AS (SELECT unnest([1, 2, 3, 4]) AS fold)
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n FROM chunks c, k WHERE c.chunk < fold AND NOT EXISTS
  (SELECT 1 FROM chunks v WHERE v.chunk = fold AND v.o_custkey = c.o_custkey) GROUP BY fold""")
def fold_train_sets(spark, d):
    rows = FO.with_group_chunks(chunked_orders(spark, d), "o_custkey")
    folds = F.expr("filter(sequence(1, 4), k -> chunk < k AND (_seen & shiftleft(1L, k)) = 0)")
    return rows.select(F.explode(folds).alias("fold")).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("membership", """
SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def membership(spark, d):
    building = load(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").withColumnRenamed("c_custkey", "o_custkey")
    return FO.members(load(spark, d, "orders"), building, "o_custkey").select("o_orderkey")


@query("overlap", """
SELECT o_custkey FROM orders WHERE year(o_orderdate) <= 1999 INTERSECT
SELECT o_custkey FROM orders WHERE year(o_orderdate) > 1999""")
def overlap(spark, d):
    orders = load(spark, d, "orders")
    return FO.overlap(orders.filter("year(o_orderdate) <= 1999"), orders.filter("year(o_orderdate) > 1999"), "o_custkey")


# --- metrics ----------------------------------------------------------------------------------------------------------


@query("class_weights", f"""
WITH {DOCS}, b AS (SELECT count(*) AS n, sum(y) AS k FROM docs)
SELECT round(k / n, 9) AS rate, round((1 - k / n) / greatest(k / n, 1e-12), 9) AS ratio_pos,
  round(n / (2.0 * (n - k)), 9) AS balanced_neg, round(n / (2.0 * k), 9) AS balanced_pos FROM b""")
def class_weights(spark, d):
    docs = scored_docs(spark, d)
    ratio = M.class_weights(docs, "y").select("rate", F.col("w_pos").alias("ratio_pos"))
    balanced = M.class_weights(docs, "y", "balanced").select(
        "rate", F.col("w_neg").alias("balanced_neg"), F.col("w_pos").alias("balanced_pos"))
    return rounded(ratio.join(balanced, "rate"))


@query("coverage", f"""
WITH {DOCS} SELECT count(*) FILTER (WHERE lang = 'en') AS used, count(*) AS total FROM docs""")
def coverage(spark, d):
    return M.coverage(scored_docs(spark, d).withColumn("p", F.when(F.col("lang") == "en", F.col("p"))), "p")


@query("run_metadata", """
WITH rows AS (SELECT toxic AS y, lang = 'en' AS train FROM documents JOIN labels USING (doc_id) WHERE lang IS NOT NULL)
SELECT count(*) FILTER (WHERE train) AS rows_train, count(*) FILTER (WHERE NOT train) AS rows_test, round(avg(y) FILTER (WHERE train), 9) AS rate_train,
  round(avg(y) FILTER (WHERE NOT train), 9) AS rate_test, (SELECT 1 + count(*) FROM (DESCRIBE documents) WHERE column_name <> 'doc_id' AND column_type
  IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE')) AS n_features FROM rows""")
def run_metadata(spark, d):
    """Counts and rates of both parts of the feature table as written, once; features are those that selection finds."""
    docs = load(spark, d, "documents").drop("text").join(load(spark, d, "labels").select("doc_id", F.col("toxic").alias("y")), "doc_id")
    table = docs.where("lang is not null").withColumn("train", F.expr("lang = 'en'"))
    features = FR.select_features(table, table, ["doc_id", "y"], ["source"])
    part = {"train": F.col("train"), "test": ~F.col("train")}
    measures = {f"rows_{k}": F.count_if(c) for k, c in part.items()} | {f"rate_{k}": F.avg(F.when(c, F.col("y"))) for k, c in part.items()}
    _, seen = sinks.persist_measured(table, fresh_path(spark, "features"), **measures)
    names = "rows_train long, rows_test long, rate_train double, rate_test double, n_features int"
    return rounded(spark.createDataFrame([seen | {"n_features": len(features)}], names))


RANKED = f"""WITH {DOCS}, c AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM docs GROUP BY p),
r AS (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp,
  sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM c)"""


@query("auroc_exact", RANKED + " SELECT round(sum(pos * (nn - fp + neg / 2.0)) / (max(np) * max(nn)), 9) AS auroc FROM r")
def auroc_exact(spark, d):
    return rounded(M.auroc(scored_docs(spark, d), "p", "y"))


@query("average_precision",
       RANKED + " SELECT round(sum(pos / np * (tp / (tp + fp))), 9) AS average_precision FROM r")
def average_precision(spark, d):
    return rounded(M.average_precision(scored_docs(spark, d), "p", "y"))


def _sweep_sql(steps: int, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""WITH {DOCS}, g AS (SELECT unnest(range(1, {steps})) / {steps}.0::DOUBLE AS threshold),
c AS (SELECT {lead}threshold, sum(CASE WHEN p >= threshold THEN y ELSE 0 END)::BIGINT AS tp,
  sum(CASE WHEN p >= threshold THEN 1 - y ELSE 0 END)::BIGINT AS fp,
  sum(CASE WHEN p < threshold THEN y ELSE 0 END)::BIGINT AS fn,
  sum(CASE WHEN p < threshold THEN 1 - y ELSE 0 END)::BIGINT AS tn FROM docs, g GROUP BY {lead}threshold),
s AS (SELECT *, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 9) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 9) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 9) AS f1 FROM c)"""


@query("threshold_sweep", _sweep_sql(20) + " SELECT * FROM s")
def threshold_sweep(spark, d):
    return rounded(M.threshold_sweep(scored_docs(spark, d), "p", "y"))


@query("sweep_by_split", _sweep_sql(10, "lang") + " SELECT * FROM s")
def sweep_by_split(spark, d):
    return rounded(M.threshold_sweep(scored_docs(spark, d), "p", "y", M.SWEEP_9, ["lang"]))


@query("best_threshold", _sweep_sql(20) + " SELECT * FROM s ORDER BY f1 DESC, recall DESC, precision DESC, threshold LIMIT 1")
def best_threshold(spark, d):
    return rounded(M.best_threshold(M.threshold_sweep(scored_docs(spark, d), "p", "y")))


@query("confusion", f"""
WITH {DOCS} SELECT count(*) FILTER (WHERE y = 0 AND p < 0.35) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 0.35) AS fp,
  count(*) FILTER (WHERE y = 1 AND p < 0.35) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 0.35) AS tp,
  round(sum(CASE WHEN p >= 0.35 THEN y END) / count(*) FILTER (WHERE p >= 0.35), 9) AS precision,
  round(count(*) FILTER (WHERE y = 1 AND p >= 0.35) / sum(y), 9) AS recall,
  round(2 * count(*) FILTER (WHERE y = 1 AND p >= 0.35) / (sum(y) + count(*) FILTER (WHERE p >= 0.35)), 9) AS f1
FROM docs""")
def confusion(spark, d):
    return rounded(M.confusion(M.apply_threshold(scored_docs(spark, d), "p", 0.35), "y"))


# --- frames -----------------------------------------------------------------------------------------------------------


@query("clean_numeric", """
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS ratio, coalesce(CASE WHEN event_id % 7 <> 0
  THEN event_type END, 'nan') AS kind FROM events""")
def clean_numeric(spark, d):
    odd = load(spark, d, "events").select(
        "event_id", "user_id", F.when(F.col("event_id") % 5 == 0, F.lit(float("inf"))).otherwise(F.col("value")).alias("ratio"),
        F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"))
    clean = FR.stringify(FR.inf_to_null(odd), ["event_type"])
    features = FR.select_features(clean, clean, ["event_id", "user_id"], ["event_type"])
    return FR.prune(clean, ["event_id", *features], {"event_type": "kind"})


@query("impute_flag_join", f"""
WITH {DOCS}, other AS (SELECT doc_id, p AS p_text FROM docs WHERE lang = 'en')
SELECT doc_id, p AS p_tab, round(coalesce(p_text, (SELECT avg(y) FROM docs)), 9) AS p_text,
  CASE WHEN p_text IS NOT NULL THEN 1 ELSE 0 END AS has_text FROM docs LEFT JOIN other USING (doc_id)""")
def impute_flag_join(spark, d):
    docs = scored_docs(spark, d)
    other = docs.filter("lang = 'en'").select("doc_id", F.col("p").alias("p_text"))
    prior = M.class_weights(docs, "y").first()["rate"]
    joined = FR.align_predictions(docs.select("doc_id", F.col("p").alias("p_tab")), other, "p_text", "doc_id")
    return rounded(FR.impute_with_flag(joined, "p_text", prior))


# --- text -------------------------------------------------------------------------------------------------------------


@query("text_lag_concat", """
SELECT conv_id, turn, coalesce(lag(text, 2) OVER w, '') || ' [SEP] ' || coalesce(lag(text, 1) OVER w, '') || ' [SEP] '
  || text AS notes_combo FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def text_lag_concat(spark, d):
    notes = load(spark, d, "conversations").select("conv_id", "turn", "text")
    bucket = F.floor(F.col("turn") / 4096).cast("long")
    return TX.text_lags(notes, ["conv_id"], "turn", "text", bucket).select("conv_id", "turn", "notes_combo")


@query("truncate_tokens", r"""
SELECT doc_id, array_to_string(list_slice(regexp_split_to_array(text, '[ \t\n\f\r\x0B]+'), 1, 256), ' ') AS head
FROM documents""")
def truncate_tokens(spark, d):
    return load(spark, d, "documents").select("doc_id", TX.truncate_tokens("text").alias("head"))


@query("tfidf_exact", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]{2,}') AS w FROM documents),
grams AS (SELECT doc_id, unnest(w) AS term FROM w UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
c AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
i AS (SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1.0 AS idf FROM c GROUP BY term),
r AS (SELECT doc_id, term, (1.0 + ln(tf)) * idf AS x FROM c JOIN i USING (term)),
n AS (SELECT doc_id, sqrt(sum(x * x)) AS norm FROM r GROUP BY doc_id)
SELECT doc_id, term, round(x / norm, 9) AS weight FROM r JOIN n USING (doc_id)""")
def tfidf_exact(spark, d):
    return rounded(TX.tfidf_texts(load(spark, d, "documents"), "doc_id", "text"))


def _length_model() -> Callable:
    import numpy as np

    def predict(texts):
        return 1.0 / (1.0 + np.exp((100.0 - texts.str.len().astype("float64")) / 400.0))

    return predict


@query("batch_text_score", """
SELECT doc_id, round(1 / (1 + exp((100.0 - length(text)) / 400.0)), 9) AS p_text FROM documents""")
def batch_text_score(spark, d):
    return rounded(TX.batch_text_score(load(spark, d, "documents"), "text", ["doc_id"], _length_model))


# --- sources and sinks ------------------------------------------------------------------------------------------------


@query("csv_roundtrip", "SELECT event_id, ts AS t, CASE WHEN event_id % 5 <> 0 THEN value END AS value, props AS notes_24h, "
                        "user_id AS subject_id FROM events")
def csv_roundtrip(spark, d):
    path = fresh_path(spark, "events-csv")
    rows = load(spark, d, "events").select(
        "event_id", F.col("ts").alias("t"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"),
        F.col("props").alias("notes_24h"), F.col("user_id").alias("subject_id"))
    sinks.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query("notes_contract", """
SELECT doc_id AS subject_id, doc_id AS hadm_id, doc_id AS icustay_id, TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id AS INTEGER))
  AS t, CASE WHEN doc_id % 4 = 0 THEN '' ELSE text END AS notes_24h, toxic AS label6h FROM documents JOIN labels USING (doc_id)""")
def notes_contract(spark, d):
    path = fresh_path(spark, "notes-csv")
    t = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.col("doc_id").cast("int"))
    docs = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id")
    notes = docs.select(F.col("doc_id").alias("subject_id"), F.col("doc_id").alias("hadm_id"),
                        F.col("doc_id").alias("icustay_id"), t.alias("t"),
                        F.when(F.col("doc_id") % 4 != 0, F.col("text")).alias("notes_24h"), F.col("toxic").alias("label6h"))
    sinks.write_csv(notes, path)
    return files.read_notes(spark, path, notes.schema)


@query("split_export", """
SELECT o_orderkey, o_totalprice, CASE WHEN year(o_orderdate) <= 1999 THEN 'train' ELSE 'test' END AS split FROM orders""")
def split_export(spark, d):
    path = fresh_path(spark, "split")
    rows = load(spark, d, "orders").select("o_orderkey", "o_totalprice", B.split_by_year("o_orderdate", 1999).alias("split"))
    sinks.export_split(rows, path)
    train, test = [files.read_csv(spark, sinks.split_path(path, s), rows.schema) for s in ("train", "test")]
    return train.unionByName(test)


@query("table_roundtrip", "SELECT o_custkey, count(*) AS n, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey")
def table_roundtrip(spark, d):
    orders = load(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first_order"))
    return sinks.persist(orders, fresh_path(spark, "orders"))


@query("prediction_sink", f"""
WITH {DOCS} SELECT md5(doc_id || '|2024-01-01 00:00:00') AS row_id, p FROM docs WHERE lang = 'en'""")
def prediction_sink(spark, d):
    path = fresh_path(spark, "predictions")
    docs = scored_docs(spark, d).withColumn("t", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"))
    rows = docs.select(row_id(["doc_id"], "t").alias("row_id"), F.when(F.col("lang") == "en", F.col("p")).alias("p"))
    sinks.write_predictions(rows, path, "p")
    return files.read_csv(spark, path, rows.schema)


@query("summary_json", _sweep_sql(20) + ", b AS (SELECT * FROM s ORDER BY f1 DESC, recall DESC, precision DESC, threshold "
       "LIMIT 1) SELECT threshold AS best_threshold, f1 AS oof_f1, precision AS oof_precision, recall AS oof_recall FROM b")
def summary_json(spark, d):
    path = fresh_path(spark, "summary")
    best = M.best_threshold(M.threshold_sweep(scored_docs(spark, d), "p", "y")).first()
    sinks.write_summary(spark, path, {"best_threshold": best["threshold"], "oof_precision": best["precision"],
                                      "oof_recall": best["recall"], "oof_f1": best["f1"]})
    return rounded(spark.read.json(path))


PROFILED = ["doc_id", "text", "lang", "source", "n_chars"]
SPARK_TYPES = "CASE typeof(any_value({c})) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(typeof(any_value({c}))) END"


def _profile_sql(c: str) -> str:
    kind = SPARK_TYPES.format(c=c)
    return f"""SELECT '{c}' AS "column", {kind} AS dtype, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(*) FILTER (WHERE
  typeof({c}) <> 'VARCHAR' AND isnan(try_cast({c} AS DOUBLE))) AS n_nan, CASE WHEN {kind} <> 'string' THEN min(try_cast({c} AS DOUBLE)) END AS smallest, CASE WHEN {kind} <> 'string'
  THEN max(try_cast({c} AS DOUBLE)) END AS largest, CASE WHEN {kind} = 'string' THEN min(CAST({c} AS VARCHAR)) END AS first_text,
  CASE WHEN {kind} = 'string' THEN max(CAST({c} AS VARCHAR)) END AS last_text FROM docs"""


@query("feature_schema", "WITH docs AS (SELECT * REPLACE (CASE WHEN doc_id % 7 <> 0 THEN n_chars END AS n_chars) FROM documents) "
       + " UNION ALL ".join(map(_profile_sql, PROFILED)))
def feature_schema(spark, d):
    """The exact part of the profile of every row; sketches are tested against exact values."""
    docs = load(spark, d, "documents").withColumn("n_chars", F.when(F.col("doc_id") % 7 != 0, F.col("n_chars")))
    return rounded(FR.column_profile(docs, PROFILED).drop("approx_distinct", "approx_median"))


from tidewatch.plans import model_queries  # noqa: E402,F401  registers the fitted models
