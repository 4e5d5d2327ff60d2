"""Golden reuse: the reference's committed results as INPUT, its committed derived numbers as expectation.

Values are copied by hand from the reference's result files (confusion
matrix and metrics of one model; the ablation table; a run comparison).
"""

import pytest
from pyspark.sql import functions as F

from cohortlab.operators import merge, metrics, runs


def test_metrics_from_confusion_matrix(spark):
    # [[TN, FP], [FN, TP]] = [[57, 7], [4, 16]]
    conf = spark.createDataFrame([(57, 7, 4, 16)], "tn long, fp long, fn long, tp long")
    m = metrics.binary_metrics(conf).first()
    assert m.accuracy == pytest.approx(0.8690476190476191)
    assert m.precision == pytest.approx(0.6956521739130435)
    assert m.recall == pytest.approx(0.8)
    assert m.f1_score == pytest.approx(0.7441860465116279)


ABLATION = [
    ("Baseline (All Features)", "random_forest", 0.8452380952380952),
    ("Baseline (All Features)", "xgboost", 0.8690476190476191),
    ("Baseline (All Features)", "logistic_regression", 0.8928571428571429),
    ("Without MMSE", "random_forest", 0.8095238095238095),
    ("Without MMSE", "xgboost", 0.7976190476190477),
    ("Without MMSE", "logistic_regression", 0.8214285714285714),
    ("Without Global Brain Metrics", "random_forest", 0.8214285714285714),
    ("Without Global Brain Metrics", "xgboost", 0.8214285714285714),
    ("Without Global Brain Metrics", "logistic_regression", 0.8452380952380952),
    ("Without MMSE + Global", "random_forest", 0.7738095238095238),
    ("Without MMSE + Global", "xgboost", 0.7976190476190477),
    ("Without MMSE + Global", "logistic_regression", 0.7261904761904762),
    ("Only Demographics", "random_forest", 0.7738095238095238),
    ("Only Demographics", "xgboost", 0.7976190476190477),
    ("Only Demographics", "logistic_regression", 0.7261904761904762),
    ("Only MMSE", "random_forest", 0.8690476190476191),
    ("Only MMSE", "xgboost", 0.8690476190476191),
    ("Only MMSE", "logistic_regression", 0.8690476190476191),
    ("Only Global Brain", "random_forest", 0.8214285714285714),
    ("Only Global Brain", "xgboost", 0.7857142857142857),
    ("Only Global Brain", "logistic_regression", 0.8333333333333334),
]


def test_ablation_summary_matches_report(spark):
    df = spark.createDataFrame(ABLATION, "scenario string, model string, accuracy double")
    s = {r.scenario: r for r in runs.scenario_summary(df).collect()}
    expect = {  # (average accuracy, drop, drop %) as printed in the interpretation report
        "Without MMSE": (0.8095, 0.0595, 6.8),
        "Without Global Brain Metrics": (0.8294, 0.0397, 4.6),
        "Without MMSE + Global": (0.7659, 0.1032, 11.9),
        "Only Demographics": (0.7659, 0.1032, 11.9),
        "Only MMSE": (0.8690, 0.0000, 0.0),
        "Only Global Brain": (0.8135, 0.0556, 6.4),
    }
    for name, (avg, drop, pct) in expect.items():
        r = s[name]
        assert round(r.avg_accuracy, 4) == avg and round(r.drop, 4) == drop and round(r.drop_pct, 1) == pct
    assert s["Without MMSE + Global"].flag == "WARNING"
    assert all(s[n].flag is None for n in expect if n != "Without MMSE + Global")


PHASES = [  # model, accuracy, f1, auc (phase 1) | (phase 2)
    ("logistic_regression", 0.8809523809523809, 0.75, 0.93828125, 0.8690476190476191, 0.7441860465116279, 0.94453125),
    ("xgboost", 0.8690476190476191, 0.7317073170731706, 0.9359375, 0.9047619047619048, 0.8000000000000002, 0.9375),
    ("knn", 0.8095238095238095, 0.5789473684210527, 0.889453125, 0.7976190476190477, 0.6382978723404256,
     0.8667968749999999),
]
DELTAS = {"logistic_regression": (-0.011904761904761862, -0.005813953488372103, 0.006250000000000089),
          "xgboost": (0.0357142857142857, 0.06829268292682955, 0.0015625000000000222),
          "knn": (-0.011904761904761862, 0.05935050391937291, -0.022656250000000044)}


def test_run_comparison_deltas(spark):
    a = spark.createDataFrame([(m, x, f, u) for m, x, f, u, *_ in PHASES],
                              "model string, accuracy double, f1_score double, roc_auc double")
    b = spark.createDataFrame([(m, x, f, u) for m, _, _, _, x, f, u in PHASES],
                              "model string, accuracy double, f1_score double, roc_auc double")
    c = {r.model: r for r in merge.compare_runs(a, b).collect()}
    for m, (da, df_, du) in DELTAS.items():
        assert c[m].acc_delta == pytest.approx(da, abs=1e-15)
        assert c[m].f1_delta == pytest.approx(df_, abs=1e-15)
        assert c[m].auc_delta == pytest.approx(du, abs=1e-15)
    best = runs.best_per_group(b.withColumn("scenario", F.lit("full"))).first()
    assert best.best_model == "xgboost"
