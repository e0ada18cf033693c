import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.frames import column_profile
from tidewatch.sources import files, sinks
from tidewatch.sources.storage import fresh_path, shared_dir


def test_id_list_rejects_repeats(spark, tmp_path):
    good, bad, empty = tmp_path / "good.csv", tmp_path / "bad.csv", tmp_path / "empty.csv"
    good.write_text("itemid\n1\n2\n")
    bad.write_text("itemid\n1\n1\n")
    empty.write_text('itemid\n1\n""\n')
    got = sorted((r.itemid, r.kind) for r in files.load_idlist(spark, str(good), "hr").collect())
    assert got == [(1, "hr"), (2, "hr")]
    for path in (bad, empty):
        with pytest.raises(ValueError):
            files.load_idlist(spark, str(path), "hr")


def test_notes_contract(spark, tmp_path):
    path = tmp_path / "notes.csv"
    path.write_text('subject_id,hadm_id,icustay_id,t,notes_24h,label6h\n'
                    '1,2,3,2150-01-01 05:00:00,"two\nlines, ""quoted""",1\n1,2,3,2150-01-01 06:00:00,NULL,0\n')
    schema = "subject_id long, hadm_id long, icustay_id long, t timestamp_ntz, notes_24h string, label6h int"
    rows = files.read_notes(spark, str(path), schema).orderBy("t").collect()
    assert [r.notes_24h for r in rows] == ['two\nlines, "quoted"', ""]
    assert rows[0].t == dt.datetime(2150, 1, 1, 5)
    with pytest.raises(ValueError):
        files.read_notes(spark, str(path), schema.replace("label6h", "other"))


class Session:
    """The two members `shared_dir` reads."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_comes_from_the_session(tmp_path):
    assert fresh_path(Session("yarn", str(tmp_path)), "x").startswith(f"{tmp_path}/x-")
    assert shared_dir(Session("local[2]", "s3a://b/c/")) == "s3a://b/c"
    with pytest.raises(RuntimeError):
        shared_dir(Session("yarn"))


def test_summary_is_one_record(spark, tmp_path):
    path = str(tmp_path / "summary")
    sinks.write_summary(spark, path, {"best_threshold": 0.5, "rows": 3})
    assert [r.asDict() for r in spark.read.json(path).collect()] == [{"best_threshold": 0.5, "rows": 3}]


def test_profile_of_all_columns(spark):
    rows = [(i, None if i % 4 == 0 else float(i % 50), f"w{i % 30}", [i], float("nan") if i % 5 == 0 else -1.5) for i in range(1000)]
    df = spark.createDataFrame(rows, "a.b long, x double, s string, l array<long>, f double".replace("a.b", "`a.b`")).repartition(6)
    got = {r.column: r for r in column_profile(df).collect()}
    assert list(got) == ["a.b", "x", "s", "l", "f"] and all(r.n_rows == 1000 for r in got.values())
    assert (got["x"].n_null, got["x"].smallest, got["x"].largest) == (250, min(r[1] for r in rows if r[1] is not None), 49.0)
    assert (got["f"].n_nan, got["f"].smallest, got["f"].largest, got["f"].approx_distinct) == (200, -1.5, -1.5, 1)
    assert (got["s"].first_text, got["s"].last_text, got["s"].approx_distinct, got["s"].smallest) == ("w0", "w9", 30, None)
    assert abs(got["a.b"].approx_distinct - 1000) < 80 and abs(got["a.b"].approx_median - 499.5) <= 2
    assert got["l"].approx_distinct is None and got["l"].n_null == 0
    none = column_profile(df.limit(0), ["x", "s"]).collect()
    assert [(r.n_rows, r.smallest, r.first_text) for r in none] == [(0, None, None)] * 2


def test_counts_of_a_written_table(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "k long, v double")
    table, seen = sinks.persist_measured(df, str(tmp_path / "t"), n=F.count(F.lit(1)), used=F.count("v"))
    assert seen == {"n": 2, "used": 1} and table.count() == 2
