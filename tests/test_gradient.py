"""Boosted trees from histograms against Spark's own trainer, and the rule for candidate borders."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier

from cohortlab.models import classifiers as C
from cohortlab.models import gradient

FEATS = ["a", "b", "c d", "one"]
SCHEMA = "id int, a double, b double, `c d` double, one double, target int"


def rows(n):
    rng = np.random.default_rng(5)
    x = np.stack([np.round(rng.normal(size=n), 2), rng.integers(-2, 4, n), rng.exponential(size=n), np.ones(n)], axis=1)
    y = ((x[:, 0] + 0.4 * x[:, 1] + rng.normal(size=n) > 0.5) ^ (rng.random(n) < 0.1)).astype(int)
    return [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]


@pytest.mark.parametrize("rounds, depth, bins", [(22, 3, 16), (4, 4, 256)])
def test_trees_are_those_of_spark(spark, monkeypatch, rounds, depth, bins):
    monkeypatch.setattr(gradient, "PACK_ROWS", 200)
    monkeypatch.setattr(gradient, "BLOCK_ROWS", 400)
    monkeypatch.setattr(gradient, "COLLECTED_PARTS", 2)
    df = spark.createDataFrame(rows(1500), SCHEMA).repartition(3)
    est = GBTClassifier(featuresCol=C.VEC, labelCol="target", maxIter=rounds, maxDepth=depth, maxBins=bins, stepSize=0.1, seed=42)
    vectors = C.assemble(df, FEATS)
    want, got = est.fit(vectors), gradient.fit_boosted(df, FEATS, "target", est)
    assert got.treeWeights == want.treeWeights and got.numFeatures == 4 and got.getMaxDepth() == depth
    p = [C.spark_ml_fitted("gradient_boosting", m, FEATS).transform(df).select("id", "p1").toPandas().set_index("id").p1.sort_index() for m in (want, got)]
    assert np.abs(p[0] - p[1]).max() < 1e-9
    assert np.allclose(want.featureImportances.toArray(), got.featureImportances.toArray(), atol=1e-6)
    for t, u in zip(want.trees, got.trees):
        assert (t.depth, t.numNodes) == (u.depth, u.numNodes)


def test_many_rows_are_grown_from_histograms(spark, monkeypatch):
    def never(*_):
        raise AssertionError("rows are not trained on one by one")
    monkeypatch.setattr(GBTClassifier, "_fit", never)
    monkeypatch.setattr(C, "BOOST_BLOCKS_FROM", 300)
    monkeypatch.setitem(C.XGB_PARAMS, "maxIter", 2)
    monkeypatch.setitem(C.GB_PARAMS, "maxIter", 2)
    df = spark.createDataFrame(rows(300), SCHEMA)
    for kind, params in (("xgboost", C.XGB_PARAMS), ("gradient_boosting", C.GB_PARAMS)):
        f = C.fit(kind, df, FEATS)
        assert f.spark_model.getNumTrees == 2 and max(t.depth for t in f.spark_model.trees) <= params["maxDepth"]
        assert abs(sum(x for _, x in f.importances) - 1) < 1e-9


def test_one_class_and_bad_rows(spark):
    est = GBTClassifier(featuresCol=C.VEC, labelCol="target", maxIter=2, maxDepth=2, seed=1)
    one = spark.createDataFrame([(i, float(i), 0.0, 0.0, 1.0, 0) for i in range(5)], SCHEMA)
    assert [t.numNodes for t in gradient.fit_boosted(one, FEATS, "target", est).trees] == [1, 1]
    for bad in ((9, None, 0.0, 0.0, 1.0, 0), (9, float("nan"), 0.0, 0.0, 1.0, 0), (9, 1.0, 0.0, 0.0, 1.0, 2), (9, 1.0, 0.0, 0.0, 1.0, None)):
        with pytest.raises(ValueError):
            gradient.fit_boosted(spark.createDataFrame([bad], SCHEMA), FEATS, "target", est)
    with pytest.raises(ValueError):
        gradient.fit_boosted(one.limit(0), FEATS, "target", est)


def test_candidate_borders():
    found = lambda v, c, n, k: gradient.candidate_borders(np.array(v, float), np.array(c), n, n, k).tolist()
    assert found([1, 2, 4], [1, 1, 1], 3, 5) == [1.5, 3.0]
    assert found([-1, 2], [2, 2], 6, 5) == [-0.5, 1.0]                    # two rows are zeros
    assert found([1, 2, 3, 4], [1, 1, 1, 1], 4, 1) == [2.5]
    assert found([], [], 4, 5) == []


def test_fits_side_by_side_are_those_alone(spark, monkeypatch):
    monkeypatch.setattr(gradient, "PACK_ROWS", 200)
    monkeypatch.setattr(gradient, "BLOCK_ROWS", 400)
    df = spark.createDataFrame([(*r, r[0] % 3) for r in rows(900)], SCHEMA + ", part int").repartition(3)
    deep, flat = (GBTClassifier(featuresCol=C.VEC, labelCol="target", maxIter=m, maxDepth=d, maxBins=16, stepSize=0.1, seed=42) for m, d in ((4, 4), (3, 2)))
    fits = [(FEATS, None, deep), (["c d", "a"], 1, flat), (["b"], None, deep), (["one"], None, flat), (["c d", "a"], 2, deep)]
    for (names, held, est), got in zip(fits, gradient.fit_boosted_together(df, FEATS, "target", fits, "part")):
        seen = df if held is None else df.where(df.part != held)
        want = gradient.fit_boosted(seen, names, "target", est)
        assert got.treeWeights == want.treeWeights and [t.numNodes for t in got.trees] == [t.numNodes for t in want.trees]
        p = [C.spark_ml_fitted("xgboost", m, names).transform(df).select("id", "p1").toPandas().set_index("id").p1.sort_index() for m in (want, got)]
        assert np.abs(p[0] - p[1]).max() < 1e-9
    with pytest.raises(ValueError):
        gradient.fit_boosted_together(df, FEATS, "target", [(FEATS, None, deep), (FEATS, None, deep.copy().setMaxBins(8))])
    with pytest.raises(ValueError):
        gradient.fit_boosted_together(df.where("part = 1"), FEATS, "target", [(FEATS, 1, deep)], "part")
