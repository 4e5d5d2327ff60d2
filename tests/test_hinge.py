"""The SVM of many rows: LinearSVC's problem, solved over packed rows, without a copy of the random features."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortlab.models import classifiers as C
from cohortlab.models import hinge
from cohortlab.plans import q_models, q_sources

FEATS = ["a b", "c"]
SCHEMA = "id int, `a b` double, c double, target int"


def rows(n):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 2))
    y = ((x[:, 0] ** 2 + x[:, 1] + 0.7 * rng.normal(size=n)) > 0.8).astype(int)
    return [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]


def objective(x, y, made, reg, coefficients, intercept):
    z = made(x) * made.scale
    short = 1 - (2 * y - 1) * (z @ coefficients + intercept)
    return np.maximum(short, 0).mean() + reg / 2 * ((coefficients * z.std(axis=0, ddof=1)) ** 2).sum()


def test_loss_is_not_above_that_of_spark(spark, monkeypatch):
    monkeypatch.setattr(hinge, "PACK_ROWS", 150)
    monkeypatch.setattr(hinge, "CHUNK_ROWS", 64)
    data = rows(900)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    x, y = np.array([r[1:3] for r in data]), np.array([r[3] for r in data])
    rng = np.random.default_rng(1)
    w, b = rng.normal(size=(12, 2)), rng.uniform(0, 2 * math.pi, 12)
    made = hinge.Features(w, b)
    est = LinearSVC(featuresCol=C.VEC, labelCol="target", regParam=1 / 900, maxIter=200)
    want = est.fit(df.select(array_to_vector(C._rff_udf(w, b)(F.array("`a b`", "c"))).alias(C.VEC), "target"))
    got, history = hinge.fit_hinge(df, FEATS, "target", made, est)
    there, here = (objective(x, y, made, 1 / 900, m.coefficients.toArray(), m.intercept) for m in (want, got))
    assert here <= there + 1e-6 and abs(here - there) < 2e-3 * there
    assert abs(min(history) - here) < 1e-9 and len(history) < 60
    assert (got.getMaxIter(), got.getRegParam(), got.numFeatures, got.numClasses) == (200, 1 / 900, 12, 2)


def test_cosines():
    x = np.random.default_rng(2).normal(size=(500, 2)) * 9
    w, b = np.random.default_rng(3).normal(size=(40, 2)), np.linspace(0, 6.28, 40)
    made = hinge.Features(w, b)
    assert np.abs(made(x) - np.cos(x @ w.T + b)).max() < 1e-12
    assert made.margins(np.zeros((0, 2)), np.ones(40), 1.0).shape == (0,)


def test_many_rows_keep_no_random_features(spark, monkeypatch):
    def never(*_):
        raise AssertionError("LinearSVC keeps the features of all rows")
    monkeypatch.setattr(LinearSVC, "_fit", never)
    monkeypatch.setattr(C, "SVM_BLOCKS_FROM", 300)
    df = spark.createDataFrame(rows(300), SCHEMA)
    f = C.fit("svm", df, FEATS)
    scored = f.transform(df).select("p1", "pred", "target").toPandas()
    assert scored.p1.between(0, 1).all() and ((scored.p1 > 0.5) == (scored.pred == 1)).all() and (scored.pred == scored.target).mean() > 0.8
    assert f.extra["a"] > 0
    odd = f.transform(spark.createDataFrame([(1, None, 0.0, 0), (2, 1.0, 0.0, 1)], SCHEMA)).orderBy("id").collect()
    assert math.isnan(odd[0].p1) and 0 <= odd[1].p1 <= 1
    for bad in ((9, None, 0.0, 0), (9, float("inf"), 0.0, 1), (9, 1.0, 0.0, 2), (9, 1.0, 0.0, None)):
        est = LinearSVC(featuresCol=C.VEC, labelCol="target", regParam=1.0)
        with pytest.raises(ValueError):
            hinge.fit_hinge(spark.createDataFrame([bad], SCHEMA), FEATS, "target", hinge.Features(np.ones((3, 2)), np.zeros(3)), est)


def test_one_class_and_constant_features(spark):
    est = LinearSVC(featuresCol=C.VEC, labelCol="target", regParam=0.01, maxIter=40)
    made = hinge.Features(np.array([[1.0, 0.0], [0.0, 0.0]]), np.array([0.3, 0.7]))
    for target in (0, 1):
        one = spark.createDataFrame([(i, float(i), 2.0, target) for i in range(20)], SCHEMA)
        m, history = hinge.fit_hinge(one, FEATS, "target", made, est)
        assert min(history) < 1e-4 and m.coefficients[1] == 0 and (m.intercept > 0) == bool(target)


def prepared(spark):
    n = F.col("id")
    return spark.range(0, 400, 1, 2).select(
        n.alias("session_id"), F.when(n % 4 == 0, "test").otherwise("train").alias("split"), ((n * 7 % 13 + n % 5) > 8).cast("int").alias("target"),
        *[(n * 7 % (i + 11) + F.lit(0.5) * (n % 5)).cast("double").alias(c) for i, c in enumerate(q_models.FEATS)])


def test_calibration(spark, monkeypatch):
    def never(*_):
        raise AssertionError("LinearSVC keeps the features of all rows")
    monkeypatch.setattr(LinearSVC, "_fit", never)
    monkeypatch.setattr(C, "SVM_BLOCKS_FROM", 100)
    monkeypatch.setattr(q_models, "prepared", lambda spark, _: prepared(spark))
    share = prepared(spark).where("split = 'train'").agg(F.round(F.avg("target"), 3)).first()[0]
    assert [tuple(r) for r in q_models.c3_calibration_optimality(spark, "").collect()] == [(300, share, True, True)]


def test_saved_and_loaded(spark, monkeypatch):
    monkeypatch.setattr(C, "SVM_BLOCKS_FROM", 100)
    monkeypatch.setattr(q_models, "prepared", lambda spark, _: prepared(spark))
    monkeypatch.setattr(q_sources, "SAVED_KINDS", ("svm",))
    assert [(r.model, r.n_test, r.n_changed) for r in q_sources.s12_models_roundtrip(spark, "").collect()] == [("svm", 100, 0)]
