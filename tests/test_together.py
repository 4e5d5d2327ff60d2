"""Trees of many rows that several models, scenarios or folds need are grown together, once a query."""

import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from cohortlab.models import classifiers as C
from cohortlab.models import suite
from cohortlab.plans import q_models, q_sources

TREES = ("random_forest", "xgboost", "gradient_boosting")


@pytest.fixture
def calls(monkeypatch):
    def never(*_):
        raise AssertionError("trees are not grown one fit after the other")
    for est in (GBTClassifier, RandomForestClassifier):
        monkeypatch.setattr(est, "_fit", never)
    for name in ("FOREST_BLOCKS_FROM", "BOOST_TOGETHER_FROM"):
        monkeypatch.setattr(C, name, 100)
    for params, few in ((C.RF_PARAMS, "numTrees"), (C.XGB_PARAMS, "maxIter"), (C.GB_PARAMS, "maxIter")):
        monkeypatch.setitem(params, few, 2)
        monkeypatch.setitem(params, "maxDepth", 3)
    seen = []
    for name in ("fit_forests", "fit_boosted_together"):
        whole = getattr(C, name)
        monkeypatch.setattr(C, name, lambda *a, whole=whole, name=name: seen.append((name, len(a[3] if name != "fit_forests" else a[4]))) or whole(*a))
    return seen


@pytest.fixture
def data(spark):
    n = F.col("id")
    return spark.range(0, 400, 1, 2).select(
        n.alias("session_id"), F.when(n % 4 == 0, "test").otherwise("train").alias("split"), ((n * 7 % 13 + n % 5) > 8).cast("int").alias("target"),
        *[(n * 7 % (i + 11) + F.lit(0.5) * (n % 5)).cast("double").alias(c) for i, c in enumerate(q_models.FEATS)])


def test_suite(data, calls):
    models = ("gradient_boosting", "naive_bayes", "random_forest", "xgboost")
    res, imp, _, fitted = suite.run_suite(data, q_models.FEATS, "session_id", models)
    got = res.toPandas()
    assert list(got.model) == list(models) and got.error.isna().all() and (got[["tn", "fp", "fn", "tp"]].sum(axis=1) == 100).all()
    assert sorted(calls) == [("fit_boosted_together", 2), ("fit_forests", 1)]
    assert {k: f.model_type for k, f in fitted.items()} == {k: k for k in models}
    assert imp.where("model = 'xgboost'").count() == len(q_models.FEATS)


def test_a_failing_group_is_an_error_in_each_row(data, calls):
    bad = data.withColumn(q_models.FEATS[0], F.when(F.col("session_id") != 5, F.col(q_models.FEATS[0])))
    got = suite.run_suite(bad, q_models.FEATS, "session_id", TREES)[0].toPandas()
    assert list(got.model) == list(TREES) and got.error.str.contains("missing").all()


def test_ablation(data, calls):
    got = suite.ablation_grid(data, q_models.FEATS, "session_id", q_models.FIXTURE_SCENARIOS, ("random_forest", "xgboost")).toPandas()
    names = [s[0] for s in q_models.FIXTURE_SCENARIOS]
    assert list(got.scenario) == [n for n in names for _ in range(2)] and got.error.isna().all() and got.accuracy.notna().all()
    assert sorted(calls) == [("fit_boosted_together", 7), ("fit_forests", 7)]


def test_cross_validation(data, calls):
    folds = data.withColumn("fold", (F.col("session_id") % 2).cast("int"))
    got = suite.cross_validate(folds, q_models.FEATS, "session_id", 2, ("xgboost", "naive_bayes", "random_forest")).toPandas()
    assert len(got) == 15 and (got.fold_values.map(len) == 2).all()
    assert sorted(calls) == [("fit_boosted_together", 2), ("fit_forests", 2)]


def test_models_roundtrip(spark, data, calls, monkeypatch):
    monkeypatch.setattr(q_models, "prepared", lambda *_: data)
    monkeypatch.setattr(q_sources, "SAVED_KINDS", TREES)
    got = {r.model: (r.n_test, r.n_changed) for r in q_sources.s12_models_roundtrip(spark, "").collect()}
    assert got == {k: (100, 0) for k in TREES}
    assert sorted(calls) == [("fit_boosted_together", 2), ("fit_forests", 1)]
