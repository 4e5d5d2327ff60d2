"""Random forests from histograms against Spark's own trainer."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from cohortlab.models import classifiers as C
from cohortlab.models import forest, suite

FEATS = ["a", "b", "c d", "one"]
SCHEMA = "id int, a double, b double, `c d` double, one double, target int, fold int"


def rows(n):
    rng = np.random.default_rng(5)
    x = np.stack([np.round(rng.normal(size=n), 2), rng.integers(-2, 4, n), rng.exponential(size=n), np.ones(n)], axis=1)
    y = ((x[:, 0] + 0.4 * x[:, 1] + rng.normal(size=n) > 0.5) ^ (rng.random(n) < 0.1)).astype(int)
    return [(i, *map(float, r), int(v), i % 3) for i, (r, v) in enumerate(zip(x, y))]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(forest, "PACK_ROWS", 200)
    monkeypatch.setattr(forest, "CHUNK_ROWS", 300)
    monkeypatch.setattr(forest, "PIECE_NODES", 3)
    monkeypatch.setattr(forest, "PASS_CELLS", 20_000)


def estimator(**params):
    return RandomForestClassifier(featuresCol=C.VEC, labelCol="target", minInstancesPerNode=2, seed=42, **params)


def scores(model, feats, df):
    return C.spark_ml_fitted("random_forest", model, feats).transform(df).select("id", "p1").toPandas().set_index("id").p1.sort_index()


@pytest.mark.parametrize("depth, bins", [(3, 16), (5, 256)])
def test_without_draws_the_trees_are_those_of_spark(spark, small_blocks, depth, bins):
    df = spark.createDataFrame(rows(1500), SCHEMA).repartition(3)
    est = estimator(numTrees=2, maxDepth=depth, maxBins=bins, featureSubsetStrategy="all", bootstrap=False)
    fits = [(FEATS, None), (["b", "c d"], 1)]
    for (feats, held), got in zip(fits, forest.fit_forests(df, FEATS, "target", est, fits, "fold")):
        train = df if held is None else df.where(F.col("fold") != held)
        want = est.fit(C.assemble(train, feats))
        assert got.numFeatures == len(feats) and got.numClasses == 2 and got.getNumTrees == 2 and got.getMaxDepth() == depth
        assert [t.toDebugString.split("\n", 1)[1] for t in got.trees] == [t.toDebugString.split("\n", 1)[1] for t in want.trees]
        assert np.abs(scores(want, feats, df) - scores(got, feats, df)).max() < 1e-12
        assert np.allclose(want.featureImportances.toArray(), got.featureImportances.toArray(), atol=1e-9)


def test_drawn_rows_and_features(spark):
    df = spark.createDataFrame(rows(1500), SCHEMA).repartition(3)
    est = estimator(numTrees=40, maxDepth=4, maxBins=32, featureSubsetStrategy="sqrt")
    want, got = est.fit(C.assemble(df, FEATS)), forest.fit_forests(df, FEATS, "target", est, [(FEATS, None)])[0]
    a, b = scores(want, FEATS, df), scores(got, FEATS, df)
    assert np.abs(a - b).mean() < 0.03 and np.abs(a - b).max() < 0.2  # other draws, the same distribution
    assert np.abs(want.featureImportances.toArray() - got.featureImportances.toArray()).max() < 0.1
    roots = [t.toDebugString.split("feature ")[1].split(" ")[0] for t in got.trees]
    assert len(set(roots)) > 1 and len({t.toDebugString.split("\n", 1)[1] for t in got.trees}) == 40  # each tree has its draws
    taken = forest.drawn(42, 0, [(0, 100_000)], 1.0)
    assert abs(taken.mean() - 1) < 0.02 and abs(taken.var() - 1) < 0.03 and (taken == forest.drawn(42, 0, [(0, 100_000)], 1.0)).all()


def test_large_forests_come_from_blocks(spark, monkeypatch):
    called = []
    monkeypatch.setattr(C, "FOREST_BLOCKS_FROM", 1_000)
    monkeypatch.setattr(C, "RF_PARAMS", dict(C.RF_PARAMS, numTrees=4, maxDepth=3))
    monkeypatch.setattr(C, "fit_forests", lambda *a, **k: called.append(a[0].count()) or forest.fit_forests(*a, **k))
    df = spark.createDataFrame(rows(1200), SCHEMA)
    f = C.fit("random_forest", df, FEATS)
    assert called == [1200] and len(f.spark_model.trees) == 4 and f.transform(df).where("p1 BETWEEN 0 AND 1").count() == 1200
    C.fit("random_forest", df.where("id < 900"), FEATS)
    assert called == [1200]


def test_bad_rows_are_errors(spark):
    est = estimator(numTrees=2, maxDepth=2)
    for bad in ((1, None, 0.0, 0.0, 1.0, 1, 0), (1, float("inf"), 0.0, 0.0, 1.0, 1, 0), (1, 0.0, 0.0, 0.0, 1.0, 2, 0)):
        with pytest.raises(ValueError, match="a forest needs rows"):
            forest.fit_forests(spark.createDataFrame([(0, 1.0, 1.0, 1.0, 1.0, 0, 0), bad], SCHEMA), FEATS, "target", est, [(FEATS, None)])


def test_the_forests_of_a_cross_validation_grow_together(spark, monkeypatch):
    called = []

    def large(*a, **k):
        called.append(a[2])
        return C.large_forests(*a, **k)

    monkeypatch.setattr(C, "FOREST_BLOCKS_FROM", 200)
    monkeypatch.setattr(C, "RF_PARAMS", dict(C.RF_PARAMS, numTrees=4, maxDepth=3))
    monkeypatch.setattr(suite, "large_forests", large)
    df = spark.createDataFrame(rows(600), SCHEMA)
    got = {r.metric: r for r in suite.cross_validate(df, FEATS, "id", 3, models=("random_forest",)).collect()}
    assert called == [[(FEATS, f) for f in range(3)]]
    assert len(got["roc_auc"].fold_values) == 3 and all(0.6 < v < 1 for v in got["roc_auc"].fold_values)
