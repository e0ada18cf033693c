"""Every registered query with SQL equals it on the smallest tables; the fitted models keep their contracts."""

import pytest

import __spark_entry__ as entry
from tests.checker import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_feature_table_shape(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 83 and len(set(df.columns)) == 83


def test_stacked_predictions_cover_both_parts(spark):
    rows = entry.queries()["fusion_lr"](spark, SF).collect()
    assert {r.part for r in rows} == {"oof", "test"}
    assert len({r.row_id for r in rows}) == len(rows) and all(0.0 <= r.p_fused <= 1.0 for r in rows)


def test_reloaded_model_scores_alike(spark):
    rows = entry.queries()["model_roundtrip"](spark, SF).collect()
    assert rows and all(r.p == r.p_again for r in rows)
