"""Reference-shaped input tables derived from the driver's tables, so that the whole job runs on them.

A user's events of one half-month form a stay and an admission; parts play the item dictionaries; events feed the
measurement, input, output, prescription and culture tables. Missing values, open ends, odd units and label variants are
worked in so that every branch of the job is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.clock import shift
from tidewatch.functions.keywords import LabelRule, label_kinds
from tidewatch.sources.tables import load

CHART_LABELS = {"red": "MAP mean", "blue": "SpO2", "cold": "FiO2 set", "hot": "GCS Total", "large": "Heart Rate",
                "small": "Respiratory Rate Set", "new": "Norepinephrine", "old": "CRRT PEEP"}
LAB_LABELS = {"anvil": "Platelet Count", "gear": "Creatinine", "gizmo": "pO2", "plate": "WBC Count", "ring": "Lactate"}
ID_RULES = (LabelRule("map", ("map",)), LabelRule("spo2", ("spo2",)), LabelRule("fio2", ("fio2",)),
            LabelRule("hr", ("heart rate",)), LabelRule("rr", ("respiratory rate",)))
DRUGS = ("Cefepime", "Vancomycin HCl", "Aspirin", "LevoFLOXacin", "Heparin", "Bactrim DS")
LAST_TRAIN_YEAR = 2023


def _pick(key: Column, options: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for word, label in options.items():
        out = F.when(key == word, F.lit(label)).otherwise(out)
    return out


def _null_every(c: Column, n: int) -> Column:
    return F.when(F.col("event_id") % n != 0, c)


def events_with_stay(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.floor((F.dayofmonth("ts") - 1) / 15).cast("long")
    half = F.least(half, F.lit(1).cast("long"))
    return (
        load(spark, sf_dir, "events").withColumn("_half", half)
        .select("event_id", "ts", "event_type", "value", F.col("user_id").alias("subject_id"),
                (F.col("user_id") * 2 + F.col("_half") + 1_000_000).alias("hadm_id"),
                (F.col("user_id") * 2 + F.col("_half") + 2_000_000).alias("icustay_id"))
    )


def reference_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ev = events_with_stay(spark, sf_dir)
    parts = load(spark, sf_dir, "part")
    n_items = parts.agg(F.max("p_partkey") + 1).scalar()
    kind = F.col("event_type")

    stays = ev.groupBy("subject_id", "hadm_id", "icustay_id").agg(
        F.min("ts").alias("intime"), F.max("ts").alias("outtime"))
    early = F.col("subject_id") % 5 < 4
    admissions = stays.select(
        "hadm_id", F.when(early, shift("intime", -400 * 24)).otherwise(shift("intime", -3)).alias("admittime"),
        shift("outtime", -12).alias("dischtime"))
    born = F.make_timestamp_ntz(F.lit(1920), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    patients = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("subject_id"),
        (born + F.make_dt_interval((F.col("c_custkey") * 7919 % 36000).cast("int"))).alias("dob"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "F").otherwise("M").alias("gender"))

    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    items = parts.select(
        F.col("p_partkey").alias("itemid"), F.concat(_pick(first, CHART_LABELS), F.lit(" "), "p_name").alias("label"),
        F.when(F.col("p_type") == "SMALL", "Respiratory").when(F.col("p_type") != "ECONOMY", F.col("p_type"))
        .alias("category"))
    size = F.col("p_size")
    lab_label = F.coalesce(
        _pick(second, LAB_LABELS),
        F.when(second == "bolt", F.when(F.col("p_type") == "PROMO", "Bilirubin, Direct").otherwise("Bilirubin, Total")),
        F.when(second == "rod", F.when(size % 2 == 0, "Sodium").otherwise("Potassium")),
        F.when(size % 3 == 0, "Glucose").when(size % 3 == 1, "Chloride").otherwise("Bicarbonate"))
    lab_items = parts.select(F.col("p_partkey").alias("itemid"), lab_label.alias("label"))

    copy = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j")
    thrice = ev.select("*", copy)
    serial, value = F.col("event_id") * 3 + F.col("j"), F.col("value")
    chart = thrice.select(
        "icustay_id", (F.col("ts") + F.make_dt_interval(F.lit(0), F.col("j") * 7)).alias("charttime"),
        (serial * 31 % n_items).alias("itemid"),
        _null_every(F.when(F.col("event_id") % 3 == 0, value / 100).otherwise(value), 17).alias("valuenum"))
    lab = thrice.select(
        "hadm_id", (F.col("ts") + F.make_dt_interval(F.lit(0), F.col("j") * 5 - 2)).alias("charttime"),
        (serial * 17 % n_items).alias("itemid"),
        _null_every(F.when(F.col("j") == 0, value).otherwise(value / 10), 19).alias("valuenum"))
    out = ev.filter(kind.isin("view", "click")).select(
        "icustay_id", F.col("ts").alias("charttime"), _null_every(value * 10, 13).alias("value"))
    held = F.make_dt_interval(F.lit(0), (F.col("event_id") % 30 - 1).cast("int"))
    mv = ev.filter(kind.isin("signup", "purchase")).select(
        "icustay_id", F.col("ts").alias("starttime"), _null_every(F.col("ts") + held, 4).alias("endtime"),
        (F.col("event_id") * 7 % n_items).alias("itemid"), _null_every(value, 11).alias("amount"))
    cv = ev.filter(kind == "error").select(
        "icustay_id", F.col("ts").alias("charttime"), (F.col("event_id") * 13 % n_items).alias("itemid"),
        _null_every(value, 11).alias("amount"))
    drug = F.element_at(F.array(*[F.lit(d) for d in DRUGS]), (F.col("event_id") % 6 + 1).cast("int"))
    scripts = ev.filter(kind == "purchase").select(
        _null_every(F.col("hadm_id"), 19).alias("hadm_id"), F.to_date("ts").alias("startdate"), drug.alias("drug"))
    cultures = ev.filter(kind == "error").select(
        "hadm_id", _null_every(F.col("ts"), 23).alias("charttime"))
    source = F.when(F.col("subject_id") % 2 == 0, "metavision").otherwise("carevue")
    return {
        "icustays": stays.withColumn("dbsource", source), "admissions": admissions, "patients": patients,
        "prescriptions": scripts, "microbiologyevents": cultures, "d_labitems": lab_items, "d_items": items,
        "chartevents": chart, "labevents": lab, "outputevents": out, "inputevents_mv": mv, "inputevents_cv": cv,
    }


def reference_ids(tables: dict[str, DataFrame]) -> DataFrame:
    """Stand-in for the five id-list files: items of even id whose label names the vital sign."""
    return label_kinds(tables["d_items"].filter(F.col("itemid") % 2 == 0), ID_RULES)
