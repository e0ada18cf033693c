import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import bands as B
from tidewatch.functions.clock import (between_offsets, capped_age, default_end, hour_ceil, hour_floor, hours_since,
                                       round_half_up, trunc_hour)
from tidewatch.functions.keys import parse_ts_or_null, row_id
from tidewatch.functions.keywords import LabelRule, contains_any, label_kinds, matching_items

D = dt.datetime
NAN = None


def col_of(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def doubles(spark, **cols):
    names = list(cols)
    return spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{n} double" for n in names))


def test_falling_and_rising_bands(spark):
    df = doubles(spark, x=[150.0, 149.9, 100.0, 50.0, 20.0, 19.9, None])
    assert col_of(df, B.bands("x", (150, 100, 50, 20), "down")) == [0, 1, 1, 2, 3, 4, None]
    df = doubles(spark, x=[1.1, 1.2, 2.0, 6.0, 12.0, None])
    assert col_of(df, B.bands("x", (1.2, 2.0, 6.0, 12.0), "up")) == [0, 1, 2, 3, 4, None]


def test_two_source_prefers_primary(spark):
    df = doubles(spark, p=[400.0, 99.0, None, None, None, 350.0], f=[1.0, 235.0, 235.0, 149.0, None, None])
    got = col_of(df, B.two_source_bands("p", "f", (400, 300, 200, 100), (235, 214, 201, 150)))
    assert got == [0, 4, 0, 4, None, 1]


def test_fallback_gate_and_total(spark):
    df = doubles(spark, x=[1.0, None, None, None, None], alt=[0.0, 500.0, 200.0, 199.0, None])
    assert col_of(df, B.bands_with_fallback("x", (1.2, 2.0, 3.5, 5.0), "alt", (500, 200), (0, 3, 4))) == [0, 0, 3, 4, None]
    df = spark.createDataFrame([(True, None), (False, 70.0), (False, 69.0), (False, None), (None, 80.0)],
                               "f boolean, x double")
    assert col_of(df, B.gated_score("f", "x", 70)) == [3, 0, 1, None, None]
    assert col_of(doubles(spark, a=[1.0, None], b=[None, None]), B.null_safe_total("a", "b")) == [1.0, 0.0]


def test_ratio_guards(spark):
    df = doubles(spark, n=[90.0, 90.0, None, 90.0], d=[30.0, 0.0, 30.0, None])
    assert col_of(df, B.guarded_ratio("n", "d")) == [300.0, None, None, None]


def test_unit_and_range_cleaning(spark):
    df = doubles(spark, x=[0.14, 0.15, 1.5, 10.0, 15.0, 100.0, 101.0, None])
    assert col_of(df, B.unit_normalise("x")) == [None, 15.0, 150.0, None, 15.0, 100.0, None, None]
    df = doubles(spark, s=[49.0, 50.0, 100.0, 101.0, 90.0], f=[30.0, 50.0, 100.0, 50.0, 150.0])
    assert col_of(df, B.range_clean("s", 50, 100)) == [None, 50.0, 100.0, None, 90.0]
    assert col_of(df, B.clean_ratio("s", "f")) == [None, 100.0, 100.0, None, None]


def test_label_is_null_iff_at_or_after_onset(spark):
    t = D(2100, 1, 1, 6)
    onsets = [None, t, t + dt.timedelta(hours=1), t + dt.timedelta(hours=5, minutes=59), t + dt.timedelta(hours=6),
              t - dt.timedelta(hours=1)]
    df = spark.createDataFrame([(t, o) for o in onsets], "t timestamp_ntz, onset timestamp_ntz")
    assert col_of(df, B.horizon_label("t", "onset", 6)) == [0, None, 1, 1, 0, None]


def test_split_by_year(spark):
    df = spark.createDataFrame([(D(2176, 12, 31, 23),), (D(2177, 1, 1),), (None,)], "a timestamp_ntz")
    assert col_of(df, B.split_by_year("a", 2176)) == ["train", "test", None]


def test_age_cap_and_rounding(spark):
    rows = [(D(2000, 1, 1), D(2018, 1, 1)), (D(2000, 1, 2), D(2089, 1, 1)), (D(2000, 1, 1), D(2089, 1, 1)),
            (D(2000, 2, 29), D(2089, 2, 28))]
    df = spark.createDataFrame(rows, "b timestamp_ntz, a timestamp_ntz")
    ages = col_of(df, capped_age("b", "a"))
    assert ages[0] == pytest.approx(6575 / 365.25) and ages[2:] == [90.0, 90.0] and ages[1] < 89.01
    assert col_of(doubles(spark, x=[17.5, 17.49, 18.0]), round_half_up("x")) == [18, 17, 18]


def test_hours(spark):
    df = spark.createDataFrame([(D(2150, 1, 1, 5, 0, 0, 1),), (D(2150, 1, 1, 5),), (D(1960, 1, 1, 5, 30),)], "t timestamp_ntz")
    assert col_of(df, trunc_hour("t")) == [D(2150, 1, 1, 5), D(2150, 1, 1, 5), D(1960, 1, 1, 5)]
    assert col_of(df, hour_ceil("t") - hour_floor("t")) == [1, 0, 1]
    two = spark.createDataFrame([(D(2150, 1, 1, 5), D(2150, 1, 1, 5, 30)), (D(2150, 1, 1, 5), None)],
                                "t timestamp_ntz, a timestamp_ntz")
    assert col_of(two, hours_since("t", "a")) == [-0.5, None]
    assert col_of(two, default_end("t", "a")) == [D(2150, 1, 1, 5, 30), D(2150, 1, 1, 6)]
    assert col_of(two, between_offsets("t", "a", "a", 1, 0)) == [True, None]


def test_keyword_rules(spark):
    items = spark.createDataFrame(
        [(1, "Bilirubin, Direct", "x"), (2, "BILIRUBIN, Total", None), (3, "MAP", None), (4, "map mean", "Resp"),
         (5, "Map low", "Vitals"), (6, "PEEP set", "Vent")], "itemid int, label string, category string")
    rules = (LabelRule("bili", ("bilirubin",), label_without="direct"), LabelRule("map", ("map",), category_without="resp"),
             LabelRule("any", ("map",)))
    got = sorted((r.itemid, r.kind) for r in label_kinds(items, rules, category="category").collect())
    assert got == [(2, "bili"), (3, "any"), (4, "any"), (5, "any"), (5, "map")]
    assert matching_items(items, ("PEEP",)).count() == 0
    assert matching_items(items, ("PEEP",), fold_patterns=True).count() == 1
    assert items.filter(contains_any("label", ("it's", "back\\slash", "total"))).count() == 1


def test_row_id_matches_hashlib(spark):
    import hashlib
    df = spark.createDataFrame([(16777217, 2, 3, D(2150, 1, 1))], "s long, h long, i long, t timestamp_ntz")
    want = hashlib.md5(b"16777217|2|3|2150-01-01 00:00:00").hexdigest()
    assert col_of(df, row_id(["s", "h", "i"], "t")) == [want]
    texts = spark.createDataFrame([("2024-01-01 10:00:00",), ("no date",)], "x string")
    assert col_of(texts, parse_ts_or_null("x")) == [D(2024, 1, 1, 10), None]
