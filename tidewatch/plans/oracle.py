"""DuckDB SQL that states the expected result of each query, written from the operator definitions.

It shares nothing with the Spark side: as-of values come from ASOF joins, sums and marks from range joins and EXISTS.
"""

from __future__ import annotations

GRID = """
bounds AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY user_id),
grid AS (SELECT user_id, unnest(generate_series(date_trunc('hour', lo), date_trunc('hour', hi), INTERVAL 1 HOUR)) AS t
         FROM bounds)"""


def asof(name: str, kind: str, hours: int = 24) -> str:
    return f"""{name} AS (
  SELECT g.user_id, g.t, CASE WHEN e.ts > g.t - INTERVAL {hours} HOUR THEN e.value END AS {name}
  FROM grid g ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = '{kind}') e
    ON g.user_id = e.user_id AND g.t >= e.ts)"""


SIGNALS = ",".join(["", *[asof(f"v_{k}", k) for k in ("click", "purchase", "view", "error", "signup")]])
WIDE = f"""
WITH {GRID}{SIGNALS},
wide AS (SELECT * FROM grid JOIN v_click USING (user_id, t) JOIN v_purchase USING (user_id, t)
  JOIN v_view USING (user_id, t) JOIN v_error USING (user_id, t) JOIN v_signup USING (user_id, t))"""

# --- the feature job --------------------------------------------------------------------------------------------------

TABLES = """
ev AS (SELECT event_id, ts, event_type, value, user_id AS subject_id, user_id * 2 + h + 1000000 AS hadm_id,
              user_id * 2 + h + 2000000 AS icustay_id
       FROM (SELECT *, least((day(ts) - 1) // 15, 1) AS h FROM events)),
items_n AS (SELECT max(p_partkey) + 1 AS n FROM part),
icustays AS (SELECT subject_id, hadm_id, icustay_id, min(ts) AS intime, max(ts) AS outtime,
                    CASE WHEN subject_id % 2 = 0 THEN 'metavision' ELSE 'carevue' END AS dbsource
             FROM ev GROUP BY subject_id, hadm_id, icustay_id),
admissions AS (SELECT hadm_id, CASE WHEN subject_id % 5 < 4 THEN intime - INTERVAL 400 DAY
                                    ELSE intime - INTERVAL 3 HOUR END AS admittime,
                      outtime - INTERVAL 12 HOUR AS dischtime FROM icustays),
patients AS (SELECT c_custkey AS subject_id,
                    TIMESTAMP '1920-01-01 00:00:00' + to_days(CAST(c_custkey * 7919 % 36000 AS INTEGER)) AS dob,
                    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'F' ELSE 'M' END AS gender FROM customer),
d_items AS (SELECT p_partkey AS itemid,
    CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'MAP mean' WHEN 'blue' THEN 'SpO2' WHEN 'cold' THEN 'FiO2 set'
      WHEN 'hot' THEN 'GCS Total' WHEN 'large' THEN 'Heart Rate' WHEN 'small' THEN 'Respiratory Rate Set'
      WHEN 'new' THEN 'Norepinephrine' WHEN 'old' THEN 'CRRT PEEP' END || ' ' || p_name AS label,
    CASE WHEN p_type = 'SMALL' THEN 'Respiratory' WHEN p_type <> 'ECONOMY' THEN p_type END AS category FROM part),
d_labitems AS (SELECT p_partkey AS itemid,
    CASE split_part(p_name, ' ', 2) WHEN 'anvil' THEN 'Platelet Count' WHEN 'gear' THEN 'Creatinine'
      WHEN 'gizmo' THEN 'pO2' WHEN 'plate' THEN 'WBC Count' WHEN 'ring' THEN 'Lactate'
      WHEN 'bolt' THEN CASE WHEN p_type = 'PROMO' THEN 'Bilirubin, Direct' ELSE 'Bilirubin, Total' END
      WHEN 'rod' THEN CASE WHEN p_size % 2 = 0 THEN 'Sodium' ELSE 'Potassium' END
      ELSE CASE p_size % 3 WHEN 0 THEN 'Glucose' WHEN 1 THEN 'Chloride' ELSE 'Bicarbonate' END END AS label FROM part),
ev3 AS (SELECT ev.*, j, event_id * 3 + j AS serial FROM ev, (SELECT unnest([0, 1, 2]) AS j)),
chartevents AS (SELECT icustay_id, ts + to_hours(j * 7) AS charttime, serial * 31 % n AS itemid,
    CASE WHEN event_id % 17 <> 0 THEN CASE WHEN event_id % 3 = 0 THEN value / 100 ELSE value END END AS valuenum
    FROM ev3, items_n),
labevents AS (SELECT hadm_id, ts + to_hours(j * 5 - 2) AS charttime, serial * 17 % n AS itemid,
    CASE WHEN event_id % 19 <> 0 THEN CASE WHEN j = 0 THEN value ELSE value / 10 END END AS valuenum FROM ev3, items_n),
outputevents AS (SELECT icustay_id, ts AS charttime, CASE WHEN event_id % 13 <> 0 THEN value * 10 END AS value
    FROM ev WHERE event_type IN ('view', 'click')),
inputevents_mv AS (SELECT icustay_id, ts AS starttime,
    CASE WHEN event_id % 4 <> 0 THEN ts + to_hours(CAST(event_id % 30 - 1 AS INTEGER)) END AS endtime,
    event_id * 7 % n AS itemid, CASE WHEN event_id % 11 <> 0 THEN value END AS amount
    FROM ev, items_n WHERE event_type IN ('signup', 'purchase')),
inputevents_cv AS (SELECT icustay_id, ts AS charttime, event_id * 13 % n AS itemid,
    CASE WHEN event_id % 11 <> 0 THEN value END AS amount FROM ev, items_n WHERE event_type = 'error'),
prescriptions AS (SELECT CASE WHEN event_id % 19 <> 0 THEN hadm_id END AS hadm_id, CAST(ts AS DATE) AS startdate,
    CASE event_id % 6 WHEN 0 THEN 'Cefepime' WHEN 1 THEN 'Vancomycin HCl' WHEN 2 THEN 'Aspirin'
      WHEN 3 THEN 'LevoFLOXacin' WHEN 4 THEN 'Heparin' ELSE 'Bactrim DS' END AS drug FROM ev WHERE event_type = 'purchase'),
microbiologyevents AS (SELECT hadm_id, CASE WHEN event_id % 23 <> 0 THEN ts END AS charttime
    FROM ev WHERE event_type = 'error')"""

COHORT = """
first_stay AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY intime, icustay_id) AS rn
    FROM icustays) WHERE rn = 1),
aged AS (SELECT f.*, a.admittime, a.dischtime, p.dob, p.gender,
    CASE WHEN a.admittime >= p.dob + INTERVAL 89 YEAR THEN 90.0
         ELSE (epoch_us(a.admittime) - epoch_us(p.dob)) / 1e6 / 31557600.0 END AS age_years_raw
    FROM first_stay f JOIN admissions a USING (hadm_id) JOIN patients p USING (subject_id)),
cohort AS (SELECT *, CAST(floor(age_years_raw + 0.5) AS INTEGER) AS age_years FROM aged WHERE age_years_raw >= 18.0)"""

ANCHOR = """
abx AS (SELECT hadm_id, CAST(startdate AS TIMESTAMP) AS a FROM prescriptions
    WHERE hadm_id IS NOT NULL AND regexp_matches(lower(drug), 'cef|vancomycin|levofloxacin|bactrim')),
cult AS (SELECT hadm_id, charttime AS c FROM microbiologyevents WHERE hadm_id IS NOT NULL),
suspicion AS (SELECT hadm_id, min(least(a, c)) AS tsusp FROM abx JOIN cult USING (hadm_id)
    WHERE a BETWEEN c AND c + INTERVAL 72 HOUR OR c BETWEEN a AND a + INTERVAL 24 HOUR GROUP BY hadm_id)"""

HOURS = """
hours AS (SELECT subject_id, hadm_id, icustay_id,
    unnest(generate_series(date_trunc('hour', intime), date_trunc('hour', outtime), INTERVAL 1 HOUR)) AS t FROM cohort),
chart AS (SELECT icustay_id, charttime AS ts, valuenum AS v, lower(label) AS label, lower(category) AS category, itemid
    FROM chartevents JOIN d_items USING (itemid)),
lab AS (SELECT c.icustay_id, l.charttime AS ts, l.valuenum AS v, lower(label) AS label, c.admittime
    FROM labevents l JOIN d_labitems USING (itemid) JOIN cohort c USING (hadm_id)
    WHERE l.charttime BETWEEN c.admittime - INTERVAL 48 HOUR AND c.dischtime),
drips AS (SELECT icustay_id, starttime AS s, coalesce(endtime, starttime + INTERVAL 1 HOUR) AS e
      FROM inputevents_mv JOIN d_items USING (itemid) WHERE lower(label) LIKE 'norepinephrine%'
    UNION ALL SELECT icustay_id, charttime, charttime + INTERVAL 1 HOUR
      FROM inputevents_cv JOIN d_items USING (itemid) WHERE lower(label) LIKE 'norepinephrine%'),
fluid AS (SELECT icustay_id, starttime AS ts, amount AS v, itemid FROM inputevents_mv
    UNION ALL SELECT icustay_id, charttime, amount, itemid FROM inputevents_cv),
urine AS (SELECT icustay_id, charttime AS ts, value AS v FROM outputevents)"""

_LATE = "AND ts >= admittime - INTERVAL 24 HOUR"
LATEST = {
    "s_fio2": "chart WHERE label LIKE 'fio2%'", "s_spo2": "chart WHERE label LIKE 'spo2%'",
    "s_map": "chart WHERE label LIKE 'map%' AND category NOT LIKE '%resp%'", "s_gcs": "chart WHERE label LIKE 'gcs total%'",
    "s_plt": "lab WHERE label LIKE 'platelet%'", "s_bili": "lab WHERE label LIKE 'bilirubin%' AND label NOT LIKE '%direct%'",
    "s_creat": "lab WHERE label LIKE 'creatinine%'", "s_pao2": "lab WHERE label LIKE 'po2%'",
    "map_mmhg": "chart WHERE itemid % 2 = 0 AND label LIKE 'map%'", "hr": "chart WHERE itemid % 2 = 0 AND label LIKE 'heart rate%'",
    "rr": "chart WHERE itemid % 2 = 0 AND label LIKE 'respiratory rate%'",
    "r_spo2": "chart WHERE itemid % 2 = 0 AND label LIKE 'spo2%'", "r_fio2": "chart WHERE itemid % 2 = 0 AND label LIKE 'fio2%'",
    "wbc": f"lab WHERE label LIKE 'wbc%' {_LATE}", "lactate": f"lab WHERE label LIKE 'lactate%' {_LATE}",
    "creat_mgdl": f"lab WHERE label LIKE 'creatinine%' {_LATE}",
    "bili_mgdl": f"lab WHERE label LIKE 'bilirubin%' AND label NOT LIKE '%direct%' {_LATE}",
    "platelets": f"lab WHERE label LIKE 'platelet%' {_LATE}", "na": f"lab WHERE label LIKE 'sodium%' {_LATE}",
    "k": f"lab WHERE label LIKE 'potassium%' {_LATE}", "hco3": f"lab WHERE label LIKE 'bicarbonate%' {_LATE}",
    "cl": f"lab WHERE label LIKE 'chloride%' {_LATE}", "glucose": f"lab WHERE label LIKE 'glucose%' {_LATE}",
}


def _latest(name: str, source: str) -> str:
    return f"""q_{name} AS (SELECT h.icustay_id, h.t, CASE WHEN e.ts > h.t - INTERVAL 24 HOUR THEN e.v END AS {name}
  FROM hours h ASOF LEFT JOIN (SELECT icustay_id, ts, v FROM {source} AND v IS NOT NULL) e
    ON h.icustay_id = e.icustay_id AND h.t >= e.ts)"""


def _sums(name: str, source: str) -> str:
    parts = ", ".join(
        f"sum(e.v) FILTER (WHERE e.ts > h.t - INTERVAL {w} HOUR) AS {name}_{w}h_ml"
        for w in (6, 12, 24))
    return f"""q_{name} AS (SELECT h.icustay_id, h.t, {parts} FROM hours h LEFT JOIN {source} e
  ON e.icustay_id = h.icustay_id AND e.ts <= h.t AND e.ts > h.t - INTERVAL 24 HOUR GROUP BY h.icustay_id, h.t)"""


def _seen(name: str, source: str) -> str:
    return f"""q_{name} AS (SELECT h.icustay_id, h.t, EXISTS (SELECT 1 FROM ({source}) e
  WHERE e.icustay_id = h.icustay_id AND e.ts <= h.t AND e.ts > h.t - INTERVAL 24 HOUR) AS {name} FROM hours h)"""


_MARKS = [
    _sums("urine", "urine"), _sums("fluids", "fluid"),
    _seen("vent", "SELECT icustay_id, ts FROM chart WHERE label LIKE '%respiratory rate set%'"),
    _seen("dialysis", "SELECT icustay_id, ts FROM fluid JOIN d_items USING (itemid) WHERE lower(label) LIKE '%crrt%'"),
    """q_pressor AS (SELECT h.icustay_id, h.t, EXISTS (SELECT 1 FROM drips d WHERE d.icustay_id = h.icustay_id
  AND d.s <= h.t AND d.e > h.t) AS pressor FROM hours h)""",
]
_JOINED = " ".join(f"JOIN q_{n} USING (icustay_id, t)" for n in [*LATEST, "urine", "fluids", "vent", "dialysis", "pressor"])
SCORED = ",\n".join([*[_latest(n, s) for n, s in LATEST.items()], *_MARKS]) + f""",
signals AS (SELECT *, CASE WHEN s_fio2 > 0 THEN s_pao2 / (s_fio2 / 100.0) END AS pf,
    CASE WHEN s_fio2 > 0 THEN s_spo2 / (s_fio2 / 100.0) END AS sf FROM hours {_JOINED}),
scored AS (SELECT *,
    CASE WHEN pf IS NOT NULL THEN
        CASE WHEN pf >= 400 THEN 0 WHEN pf >= 300 THEN 1 WHEN pf >= 200 THEN 2 WHEN pf >= 100 THEN 3 ELSE 4 END
      WHEN sf IS NOT NULL THEN
        CASE WHEN sf >= 235 THEN 0 WHEN sf >= 214 THEN 1 WHEN sf >= 201 THEN 2 WHEN sf >= 150 THEN 3 ELSE 4 END
      END AS sofa_resp,
    CASE WHEN s_plt IS NOT NULL THEN CASE WHEN s_plt >= 150 THEN 0 WHEN s_plt >= 100 THEN 1 WHEN s_plt >= 50 THEN 2
      WHEN s_plt >= 20 THEN 3 ELSE 4 END END AS sofa_coag,
    CASE WHEN s_bili IS NOT NULL THEN CASE WHEN s_bili < 1.2 THEN 0 WHEN s_bili < 2 THEN 1 WHEN s_bili < 6 THEN 2
      WHEN s_bili < 12 THEN 3 ELSE 4 END END AS sofa_liver,
    CASE WHEN s_gcs IS NOT NULL THEN CASE WHEN s_gcs >= 15 THEN 0 WHEN s_gcs >= 13 THEN 1 WHEN s_gcs >= 10 THEN 2
      WHEN s_gcs >= 6 THEN 3 ELSE 4 END END AS sofa_cns,
    CASE WHEN s_creat IS NOT NULL THEN CASE WHEN s_creat < 1.2 THEN 0 WHEN s_creat < 2 THEN 1 WHEN s_creat < 3.5 THEN 2
        WHEN s_creat < 5 THEN 3 ELSE 4 END
      WHEN urine_24h_ml IS NOT NULL THEN CASE WHEN urine_24h_ml >= 500 THEN 0 WHEN urine_24h_ml >= 200 THEN 3 ELSE 4 END
      END AS sofa_renal,
    CASE WHEN pressor THEN 3 WHEN s_map IS NOT NULL THEN CASE WHEN s_map >= 70 THEN 0 ELSE 1 END END AS sofa_cardio
    FROM signals),
sofa AS (SELECT *, coalesce(sofa_resp, 0) + coalesce(sofa_coag, 0) + coalesce(sofa_liver, 0) + coalesce(sofa_cns, 0)
    + coalesce(sofa_renal, 0) + coalesce(sofa_cardio, 0) AS sofa_total FROM scored),
onset AS (SELECT s.subject_id, s.hadm_id, s.icustay_id, min(s.t) FILTER (WHERE s.sofa_total >= 2
    AND s.t BETWEEN q.tsusp - INTERVAL 48 HOUR AND q.tsusp + INTERVAL 24 HOUR) AS t_onset
    FROM sofa s LEFT JOIN suspicion q USING (hadm_id) GROUP BY s.subject_id, s.hadm_id, s.icustay_id),
labelled AS (SELECT * FROM (SELECT h.*, o.t_onset,
    CASE WHEN t < t_onset AND t_onset < t + INTERVAL 6 HOUR THEN 1
         WHEN t_onset IS NULL OR t + INTERVAL 6 HOUR <= t_onset THEN 0 END AS label6h
    FROM hours h LEFT JOIN onset o USING (subject_id, hadm_id, icustay_id)) WHERE label6h IS NOT NULL)"""

_LAGGED = {"map": "map_mmhg", "hr": "hr", "rr": "rr", "sfratio": "sfratio", "wbc": "wbc", "lactate": "lactate"}
_LAGS = ", ".join(f"lag({c}, {k}) OVER w AS {p}_lag{k}" for p, c in _LAGGED.items() for k in (1, 2))
_DIFFS = ", ".join(f"{c} - {p}_lag1 AS {p}_diff1, {p}_lag1 - {p}_lag2 AS {p}_diff2" for p, c in _LAGGED.items())


def _slope(p: str, c: str, key: str, order: str = "t") -> str:
    frame = f"OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
    return (f"CASE WHEN count({c}) {frame} >= 2 THEN "
            f"regr_slope({c}, epoch_us({order}) / 1e6 - 1704067200) {frame} END AS {p}_slope_6h")


_ROLL = f"""avg(map_mmhg) OVER w6 AS map_mean_6h, stddev_samp(map_mmhg) OVER w6 AS map_std_6h,
    min(map_mmhg) OVER w6 AS map_min_6h, max(map_mmhg) OVER w6 AS map_max_6h,
    avg(map_mmhg) OVER w12 AS map_mean_12h, min(map_mmhg) OVER w12 AS map_min_12h,
    avg(hr) OVER w6 AS hr_mean_6h, stddev_samp(hr) OVER w6 AS hr_std_6h,
    avg(rr) OVER w6 AS rr_mean_6h, stddev_samp(rr) OVER w6 AS rr_std_6h,
    {_slope('map', 'map_mmhg', 'icustay_id')}, {_slope('hr', 'hr', 'icustay_id')}, {_slope('rr', 'rr', 'icustay_id')},
    CASE WHEN count(map_mmhg) OVER w6 = 0 THEN 1 ELSE 0 END AS map_miss_6h,
    CASE WHEN count(hr) OVER w6 = 0 THEN 1 ELSE 0 END AS hr_miss_6h,
    CASE WHEN count(rr) OVER w6 = 0 THEN 1 ELSE 0 END AS rr_miss_6h"""
_W6 = "w6 AS (PARTITION BY icustay_id ORDER BY t ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
_W12 = "w12 AS (PARTITION BY icustay_id ORDER BY t ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
FEATURES = f"""
rx AS (SELECT s.* EXCLUDE (pf, sf), l.label6h, CASE WHEN r_spo2 BETWEEN 50 AND 100 THEN r_spo2 END AS spo2_pct,
    CASE WHEN r_fio2 BETWEEN 0.15 AND 1.5 THEN r_fio2 * 100.0 WHEN r_fio2 BETWEEN 15 AND 100 THEN r_fio2 END AS fio2_pct
    FROM sofa s JOIN labelled l USING (subject_id, hadm_id, icustay_id, t)),
rx2 AS (SELECT *, CASE WHEN spo2_pct BETWEEN 50 AND 100 AND fio2_pct BETWEEN 15 AND 100
    THEN spo2_pct / (fio2_pct / 100.0) END AS sfratio FROM rx),
lagged AS (SELECT *, {_LAGS} FROM rx2 WINDOW w AS (PARTITION BY icustay_id ORDER BY t)),
rolled AS (SELECT *, {_DIFFS}, {_ROLL} FROM lagged WINDOW {_W6}, {_W12}),
features AS (SELECT r.*, CAST(pressor AS INTEGER) AS pressor_on, CAST(vent AS INTEGER) AS vent_flag,
    CAST(dialysis AS INTEGER) AS dialysis_flag, c.age_years, c.gender AS sex, c.dbsource,
    (epoch_us(r.t) - epoch_us(c.intime)) / 3.6e9 AS hours_since_icu,
    (epoch_us(r.t) - epoch_us(q.tsusp)) / 3.6e9 AS hours_since_si,
    CASE WHEN year(c.admittime) <= 2023 THEN 'train' ELSE 'test' END AS split
    FROM rolled r JOIN cohort c USING (subject_id, hadm_id, icustay_id) LEFT JOIN suspicion q ON q.hadm_id = r.hadm_id)"""


def job(*parts: str) -> str:
    return "WITH " + ",\n".join([TABLES, *parts])


def digits(column: str) -> int:
    return 11 if "since" in column else 9


def rounded(columns, doubles) -> str:
    return ", ".join(f"round({c}, {digits(c)}) + 0.0 AS {c}" if c in doubles else c for c in columns)
