"""The feature job: raw event tables to one wide hourly table with a forward-looking label.

Twelve input tables, named as in `TABLES`; 83 output columns, see `COLUMNS`.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import bands as B
from tidewatch.functions.clock import (between_offsets, capped_age, default_end, epoch_seconds, hours_since,
                                       round_half_up, shift)
from tidewatch.functions.keywords import LabelRule, contains_any, label_kinds, matching_items
from tidewatch.operators import rolling as R
from tidewatch.operators.cohort import attach_context, first_per, restrict_events, restrict_intervals
from tidewatch.operators.hourly import (Covered, Events, Intervals, Latest, Seen, Total, hourly_grid, hourly_state)
from tidewatch.operators.onset import clean_labels, min_where
from tidewatch.operators.pairs import pair_within
from tidewatch.session import configure
from tidewatch.sources.storage import stage

# --- fixed values -----------------------------------------------------------------------------------------------------

TABLES = ("icustays", "admissions", "patients", "prescriptions", "microbiologyevents", "d_labitems", "d_items",
          "chartevents", "labevents", "outputevents", "inputevents_mv", "inputevents_cv")

ANTIBIOTICS = (
    "cef", "ceph", "ceftriaxone", "ceftazidime", "cefepime", "ampicillin", "amoxicillin", "piperacillin", "tazobactam",
    "vancomycin", "meropenem", "imipenem", "ertapenem", "aztreonam", "linezolid", "daptomycin", "levofloxacin",
    "ciprofloxacin", "moxifloxacin", "gentamicin", "tobramycin", "amikacin", "metronidazole", "clindamycin",
    "trimethoprim", "sulfamethoxazole", "bactrim",
)
PRESSORS = ("norepinephrine", "noradrenaline", "epinephrine", "adrenaline", "dopamine", "dobutamine", "vasopressin")
# The two capitalised words are compared with lower-cased labels and so never match; kept for equal results.
VENTILATION = ("ventilator", "vent mode", "assist-control", "SIMV", "PEEP", "tidal volume", "respiratory rate set")
DIALYSIS = ("dialysis", "cvvh", "cvvhd", "cvvhdf", "hemodialysis", "crrt")

SCORE_LABS = (
    LabelRule("platelet", ("platelet",)),
    LabelRule("bili_total", ("bilirubin",), label_without="direct"),
    LabelRule("creat", ("creatinine",)),
    LabelRule("pao2", ("po2",)),
)
SCORE_CHARTS = (
    LabelRule("fio2", ("fio2",)),
    LabelRule("spo2", ("spo2", "o2 saturation")),
    LabelRule("map", ("map",), category_without="resp"),
    LabelRule("gcs", ("gcs total",)),
)
FEATURE_LABS = (
    LabelRule("wbc", ("wbc",)),
    LabelRule("lact", ("lactate",)),
    LabelRule("creat", ("creatinine",)),
    LabelRule("bili", ("bilirubin",), label_without="direct"),
    LabelRule("plt", ("platelet",)),
    LabelRule("na", ("sodium",)),
    LabelRule("k", ("potassium",)),
    LabelRule("hco3", ("bicarbonate", "hco3")),
    LabelRule("cl", ("chloride",)),
    LabelRule("glu", ("glucose",)),
)
LAB_COLUMNS = {"wbc": "wbc", "lact": "lactate", "creat": "creat_mgdl", "bili": "bili_mgdl", "plt": "platelets",
               "na": "na", "k": "k", "hco3": "hco3", "cl": "cl", "glu": "glucose"}
ID_LISTS = ("map", "spo2", "fio2", "hr", "rr")

OXYGEN_CUTS, SATURATION_CUTS = (400, 300, 200, 100), (235, 214, 201, 150)
PLATELET_CUTS, BILIRUBIN_CUTS, COMA_CUTS = (150, 100, 50, 20), (1.2, 2.0, 6.0, 12.0), (15, 13, 10, 6)
CREATININE_CUTS, URINE_CUTS, URINE_POINTS, PRESSURE_CUT = (1.2, 2.0, 3.5, 5.0), (500, 200), (0, 3, 4), 70

LAGGED = {"map": "map_mmhg", "hr": "hr", "rr": "rr", "sfratio": "sfratio", "wbc": "wbc", "lactate": "lactate"}

KEYS = ("subject_id", "hadm_id", "icustay_id")
SCORES = ("sofa_resp", "sofa_coag", "sofa_liver", "sofa_cns", "sofa_renal", "sofa_cardio")
COLUMNS = (
    *KEYS, "t", "label6h", *SCORES, "sofa_total",
    "map_mmhg", "hr", "rr", "spo2_pct", "fio2_pct", *LAB_COLUMNS.values(),
    "urine_6h_ml", "urine_12h_ml", "urine_24h_ml", "fluids_6h_ml", "fluids_12h_ml", "fluids_24h_ml",
    "pressor_on", "vent_flag", "dialysis_flag", "age_years", "sex", "dbsource", "hours_since_icu", "hours_since_si",
    "sfratio",
    *[f"{p}_lag{k}" for p in LAGGED for k in (1, 2)], *[f"{p}_diff{k}" for p in LAGGED for k in (1, 2)],
    "map_mean_6h", "map_std_6h", "map_min_6h", "map_max_6h", "map_mean_12h", "map_min_12h",
    "hr_mean_6h", "hr_std_6h", "rr_mean_6h", "rr_std_6h", "map_slope_6h", "hr_slope_6h", "rr_slope_6h",
    "map_miss_6h", "hr_miss_6h", "rr_miss_6h", "split",
)


@dataclass(frozen=True)
class Settings:
    min_age: float = 18.0
    lookback: int = 24
    horizon: int = 6
    onset_score: int = 2
    last_train_year: int = 2176


# --- cohort and anchor ------------------------------------------------------------------------------------------------


def cohort(tables: Mapping[str, DataFrame], min_age: float = 18.0) -> DataFrame:
    """Adults with their first stay, admission times and age."""
    stays = first_per(tables["icustays"], "subject_id", ["intime", "icustay_id"])
    admissions = tables["admissions"].select("hadm_id", "admittime", "dischtime")
    patients = tables["patients"].select("subject_id", "dob")
    context = attach_context(stays, admissions, patients).withColumn("age_years_raw", capped_age("dob", "admittime"))
    return context.filter(F.col("age_years_raw") >= min_age).select(
        *KEYS, "dbsource", "intime", "outtime", "admittime", "dischtime", "dob", "age_years_raw",
        round_half_up("age_years_raw").alias("age_years"))


def suspicion(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Earliest culture/antibiotic pair per admission: antibiotic up to 72 h after, or culture up to 24 h after."""
    drugs = tables["prescriptions"].filter(F.col("hadm_id").isNotNull() & contains_any("drug", ANTIBIOTICS))
    abx = drugs.select("hadm_id", F.col("startdate").cast("timestamp_ntz").alias("abx_time"))
    cultures = tables["microbiologyevents"].filter(F.col("hadm_id").isNotNull())
    cult = cultures.select("hadm_id", F.col("charttime").cast("timestamp_ntz").alias("cult_time"))
    return pair_within(cult, abx, "hadm_id", "cult_time", "abx_time", after=72, before=24, name="tsusp")


# --- signals ----------------------------------------------------------------------------------------------------------


def _prefixed(kinds: DataFrame, prefix: str) -> DataFrame:
    return kinds.withColumn("kind", F.concat(F.lit(prefix + ":"), "kind"))


def _tagged(items: DataFrame, kind: str) -> DataFrame:
    return items.withColumn("kind", F.lit(kind))


def id_lists(lists: Mapping[str, DataFrame]) -> DataFrame:
    """One (itemid, kind) table from the one-column id lists."""
    frames = [_tagged(lists[name].select("itemid"), name) for name in ID_LISTS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def sources(tables: Mapping[str, DataFrame], stays: DataFrame, ids: DataFrame) -> dict[str, Events | Intervals]:
    """Event feeds of the cohort. Each event table is read once per feed, with all its kinds in one dictionary join.

    Time bounds only save work, except the discharge bound on lab values, which drops later results on purpose.
    """
    items, labs = tables["d_items"], tables["d_labitems"]
    bounds = stays.select(*KEYS, "intime", "outtime")

    chart_kinds = (
        _prefixed(label_kinds(items, SCORE_CHARTS, category="category"), "score")
        .unionByName(_prefixed(ids, "feature"))
        .unionByName(_tagged(matching_items(items, VENTILATION), "vent"))
    )
    chart = restrict_events(
        tables["chartevents"].select("icustay_id", "itemid", "charttime", "valuenum"),
        bounds, "icustay_id", "charttime", "intime", "outtime", before=48, ids=chart_kinds)

    lab_kinds = _prefixed(label_kinds(labs, SCORE_LABS), "score").unionByName(
        _prefixed(label_kinds(labs, FEATURE_LABS), "feature"))
    lab = restrict_events(
        tables["labevents"].select("hadm_id", "itemid", "charttime", "valuenum"),
        stays.select(*KEYS, "admittime", "dischtime"), "hadm_id", "charttime", "admittime", "dischtime", before=48,
        ids=lab_kinds)
    lab = lab.filter(F.col("kind").startswith("score:") | (F.col("charttime") >= shift("admittime", -24)))

    urine = restrict_events(tables["outputevents"].select("icustay_id", "charttime", "value"), bounds, "icustay_id",
                            "charttime", "intime", "outtime", before=48)

    dialysis_items = _tagged(matching_items(items, DIALYSIS), "dialysis")
    pressor_items = matching_items(items, PRESSORS, prefix=True)
    mv, cv = tables["inputevents_mv"], tables["inputevents_cv"]

    def inputs(table: DataFrame, ts: str) -> DataFrame:
        rows = restrict_events(table.select("icustay_id", "itemid", ts, "amount"), bounds, "icustay_id", ts, "intime",
                               "outtime", before=48)
        return rows.join(dialysis_items, "itemid", "left")

    drips = restrict_intervals(
        mv.join(pressor_items, "itemid", "left_semi").select("icustay_id", "starttime", "endtime"),
        bounds, "icustay_id", "starttime", "endtime", "intime", "outtime", before=24)
    doses = restrict_events(
        cv.join(pressor_items, "itemid", "left_semi").select("icustay_id", "charttime"),
        bounds, "icustay_id", "charttime", "intime", "outtime", before=24)
    doses = doses.withColumn("endtime", default_end("charttime", F.lit(None).cast("timestamp_ntz")))
    given = inputs(mv, "starttime").withColumnRenamed("starttime", "charttime").unionByName(inputs(cv, "charttime"))

    return {
        "chart": Events(chart, value="valuenum", kind="kind"),
        "lab": Events(lab, value="valuenum", kind="kind"),
        "urine": Events(urine),
        "input": Events(given, value="amount", kind="kind"),
        "drip": Intervals(drips),
        "dose": Intervals(doses, start="charttime"),
    }


def signals(hours: int = 24) -> list:
    score = [Latest(f"score_{r.kind}", src, f"score:{r.kind}", hours)
             for src, rules in (("chart", SCORE_CHARTS), ("lab", SCORE_LABS)) for r in rules]
    vitals = [Latest(f"vital_{k}", "chart", f"feature:{k}", hours) for k in ID_LISTS]
    chem = [Latest(name, "lab", f"feature:{kind}", hours) for kind, name in LAB_COLUMNS.items()]
    sums = [Total(f"{p}_{w}h_ml", src, w) for p, src in (("urine", "urine"), ("fluids", "input")) for w in (6, 12, 24)]
    marks = [Covered("pressor", ("drip", "dose")), Seen("vent", ("chart",), "vent", hours),
             Seen("dialysis", ("input",), "dialysis", hours)]
    return score + vitals + chem + sums + marks


# --- score, onset, label ----------------------------------------------------------------------------------------------


def with_scores(df: DataFrame) -> DataFrame:
    """Six part scores and their total from the raw score signals."""
    ratios = df.withColumns({"pf_ratio": B.guarded_ratio("score_pao2", "score_fio2"),
                             "sf_ratio": B.guarded_ratio("score_spo2", "score_fio2")})
    parts = {
        "sofa_resp": B.two_source_bands("pf_ratio", "sf_ratio", OXYGEN_CUTS, SATURATION_CUTS),
        "sofa_coag": B.bands("score_platelet", PLATELET_CUTS, "down"),
        "sofa_liver": B.bands("score_bili_total", BILIRUBIN_CUTS, "up"),
        "sofa_cns": B.bands("score_gcs", COMA_CUTS, "down"),
        "sofa_renal": B.bands_with_fallback("score_creat", CREATININE_CUTS, "urine_24h_ml", URINE_CUTS, URINE_POINTS),
        "sofa_cardio": B.gated_score("pressor", "score_map", PRESSURE_CUT),
    }
    return ratios.withColumns(parts).withColumn("sofa_total", B.null_safe_total(*SCORES))


def with_trends(df: DataFrame) -> DataFrame:
    """Lags, differences, rolling statistics, slopes and missing flags, all on one window."""
    w = R.grid_window(KEYS, "_h")
    lagged = df.select("*", epoch_seconds("t").alias("_s"), *R.lags(w, LAGGED))
    return lagged.select(
        "*", *R.diffs(LAGGED),
        *R.rolling(w, "map", "map_mmhg", ("mean", "std", "min", "max"), 6),
        *R.rolling(w, "map", "map_mmhg", ("mean", "min"), 12),
        *R.rolling(w, "hr", "hr", ("mean", "std"), 6), *R.rolling(w, "rr", "rr", ("mean", "std"), 6),
        *[R.rolling_slope(w, p, LAGGED[p], "_s") for p in ("map", "hr", "rr")],
        *[R.all_missing_flag(w, p, LAGGED[p]) for p in ("map", "hr", "rr")],
    )


def onset_hours(tables: Mapping[str, DataFrame], ids: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Every grid hour of the cohort with signals, scores, anchor and onset, and the cohort attributes to be joined to it.

    The cohort and the anchors are written once, as every feed joins them; their file size also tells Spark whether a
    broadcast is safe. Two exchanges carry the rest: events and grid by (entity, hour), then the cells by entity. The anchors (one
    per entity, so that no hour comes twice) and the cohort attributes join on the same keys, and the onset is a minimum over the
    same partitions, so nothing is computed twice.
    """
    stays = stage(cohort(tables, settings.min_age), "cohort")
    grid = hourly_grid(stays.select(*KEYS, "intime", "outtime"), "intime", "outtime")
    anchors = stage(suspicion(tables), "suspicion")
    state = hourly_state(grid, KEYS, sources(tables, stays, ids), signals(settings.lookback))
    clean = state.withColumns({
        "map_mmhg": F.col("vital_map"), "hr": F.col("vital_hr"), "rr": F.col("vital_rr"),
        "spo2_pct": B.range_clean("vital_spo2", 50, 100), "fio2_pct": B.unit_normalise("vital_fio2"),
    }).withColumn("sfratio", B.clean_ratio("spo2_pct", "fio2_pct"))
    suspected = stays.select(*KEYS).distinct().join(anchors, "hadm_id", "left")
    scored = with_scores(clean).join(suspected, list(KEYS))
    hit = (F.col("sofa_total") >= settings.onset_score) & between_offsets("t", "tsusp", "tsusp", 48, 24)
    sex = tables["patients"].select("subject_id", F.col("gender").alias("sex"))
    context = stays.select(*KEYS, "dbsource", "intime", "admittime", "age_years").join(sex, "subject_id")
    return scored.withColumn("t_onset", min_where("t", hit).over(Window.partitionBy(*KEYS))), context


def scored_hours(tables: Mapping[str, DataFrame], ids: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """`onset_hours` with the cohort attributes."""
    hours, context = onset_hours(tables, ids, settings)
    return hours.join(context, list(KEYS))


def sofa_hourly(hours: DataFrame) -> DataFrame:
    return hours.select(*KEYS, "t", *SCORES, "sofa_total")


def onsets(hours: DataFrame) -> DataFrame:
    return hours.groupBy(*KEYS).agg(F.min("t_onset").alias("t_onset"))


def labels(hours: DataFrame, settings: Settings = Settings()) -> DataFrame:
    labelled = hours.withColumn("label6h", B.horizon_label("t", "t_onset", settings.horizon))
    return clean_labels(labelled, "label6h")


def features(tables: Mapping[str, DataFrame], ids: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The wide feature table. Rows at or after the onset are dropped; they form the tail of a stay, so trends that
    only look back are the same before and after, and are made after, and before
    the attributes join, of which an entity may have several. Sets joins and code generation of the session up first."""
    for table in tables.values():
        configure(table.sparkSession)
    kept, context = onset_hours(tables, ids, settings)
    hours = with_trends(labels(kept, settings)).join(context, list(KEYS))
    split = B.split_by_year("admittime", settings.last_train_year)
    derived = hours.withColumns({
        "pressor_on": B.flag_to_int("pressor"), "vent_flag": B.flag_to_int("vent"),
        "dialysis_flag": B.flag_to_int("dialysis"),
        "hours_since_icu": hours_since("t", "intime"), "hours_since_si": hours_since("t", "tsusp"),
        "split": split,
    })
    return derived.select(*COLUMNS)
