"""A sample of registered queries against their DuckDB oracle on the smallest scale factor,
and the driver contract of __spark_entry__."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from cohortlab.sources.tables import TABLES
from tools.oracle_check import _rows

SF = "/root/testdata/sf0.001"
SAMPLE = ["g1_profile", "g4_key_validation", "g6_group_stats", "j1_validated_merge", "j2_merge_audit",
          "m3_stratified_holdout", "m4_subject_split", "m8_stratified_kfold", "s5_report_parse",
          "i3_regional_features", "g15_roi_stats", "e3_roc_auc", "e4_classification_report", "w4_leaderboard",
          "s4_session_manifest", "x5_patient_view", "c7_naive_bayes", "c6_knn"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_contract():
    q, o = entry.queries(), entry.oracle_sql()
    assert q and set(o) <= set(q)
    assert all(k == k.lower() and ("_" in k or k == "pipeline") for k in q)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns


@pytest.mark.parametrize("name", SAMPLE)
def test_against_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(srows, sdf.columns, 0) == _rows(drows, dcols, 0)
