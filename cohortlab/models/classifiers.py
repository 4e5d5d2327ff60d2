"""Classifier suite on Spark (C1-C5, C7-C9) with one interface.

``fit(model_type, train, features)`` returns a :class:`Fitted` whose
``transform(df)`` appends ``p1`` (probability of class 1) and ``pred``.

* random_forest, xgboost*, gradient_boosting, logistic_regression: Spark ML
  estimators on an assembled vector (hyper-parameters of the reference;
  *xgboost is substituted by Spark's GBT with the same rounds/depth/rate).
  From 1,000,000 rows on, boosted trees are grown by the same method from
  histograms over packed blocks (see :mod:`cohortlab.models.gradient`), from
  200,000 rows on forests too (see :mod:`cohortlab.models.forest`).
* naive_bayes: exact Gaussian NB as column expressions — class means and
  population variances from ONE grouped aggregation, smoothing 1e-9 x the
  largest feature variance, log-likelihood and softmax per row.
* adaboost: discrete SAMME with depth-1 trees on every threshold (see
  :mod:`cohortlab.models.boosting`).
* svm: RBF kernel approximated by random Fourier features (gamma = 1 / (d var X),
  seeded, Arrow-batched pandas UDF), LinearSVC, then Platt scaling. From 200,000
  rows on the same problem is solved over packed blocks (see :mod:`cohortlab.models.hinge`).
* knn lives in :mod:`cohortlab.models.knn` (exact, blocked).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.functions.columns import q
from cohortlab.models.boosting import fit_stumps
from cohortlab.models.forest import fit_forests
from cohortlab.models.gradient import fit_boosted, fit_boosted_together
from cohortlab.models.hinge import Features, fit_hinge

MODEL_TYPES = ("random_forest", "logistic_regression", "svm", "xgboost", "gradient_boosting", "knn",
               "naive_bayes", "adaboost")

# Hyper-parameters of the reference suite.
RF_PARAMS = dict(numTrees=100, maxDepth=10, minInstancesPerNode=2, featureSubsetStrategy="sqrt", maxBins=256)
XGB_PARAMS = dict(maxIter=100, maxDepth=6, stepSize=0.1, maxBins=256)
GB_PARAMS = dict(maxIter=100, maxDepth=5, stepSize=0.1, maxBins=256)
BOOST_BLOCKS_FROM = 1_000_000   # rows; with fewer, Spark's own trainer is as fast
BOOST_TOGETHER_FROM = 200_000   # rows; as many are enough where several fits share the passes
FOREST_BLOCKS_FROM = 200_000    # rows; with fewer, Spark's own trainer grows the forest
SVM_BLOCKS_FROM = 200_000       # rows; with fewer, LinearSVC keeps their random features
LR_C, LR_MAX_ITER = 1.0, 1000
SVM_C = 1.0
SVM_MAX_ITER = 500   # LinearSVC stops earlier at its tolerance
KNN_K = 5
NB_VAR_SMOOTHING = 1e-9
ADA_ROUNDS, ADA_RATE = 100, 1.0

VEC = "__features"


@dataclass
class Fitted:
    model_type: str
    features: list[str]
    predict_fn: object
    importances: list[tuple[str, float]] | None = None
    coefficients: list[tuple[str, float]] | None = None
    spark_model: object = None
    extra: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.predict_fn(df)


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=VEC, handleInvalid="keep").transform(df)


def _spark_ml(model_type: str, est, train: DataFrame, features: list[str], label: str) -> Fitted:
    # iterative optimisers scan the input many times: materialise the assembled
    # (vector, label) pairs once instead of re-running the upstream plan per pass
    tr = assemble(train, features).select(VEC, F.col(q(label)).cast("double").alias(label))
    tr = tr.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = est.fit(tr)
    finally:
        tr.unpersist()

    return spark_ml_fitted(model_type, model, features)


def spark_ml_fitted(model_type: str, model, features: list[str]) -> Fitted:
    """A fitted or loaded Spark ML classification model behind the common interface."""
    def predict(df: DataFrame) -> DataFrame:
        out = model.transform(assemble(df, features))
        p1 = vector_to_array(F.col(model.getProbabilityCol()))[1]
        return (out.withColumn("p1", p1)
                .drop(VEC, model.getRawPredictionCol(), model.getProbabilityCol(), model.getPredictionCol())
                .withColumn("pred", (F.col("p1") > 0.5).cast("int")))

    imp = coef = None
    if hasattr(model, "featureImportances"):
        imp = list(zip(features, model.featureImportances.toArray().tolist()))
    if hasattr(model, "coefficients"):
        coef = list(zip(features, model.coefficients.toArray().tolist()))
    return Fitted(model_type, features, predict, imp, coef, model)


def fit(model_type: str, train: DataFrame, features: list[str], label: str = "target", seed: int = 42) -> Fitted:
    if model_type not in MODEL_TYPES:
        raise ValueError(f"no model is called {model_type!r}; there are {MODEL_TYPES}")
    common = dict(featuresCol=VEC, labelCol=label)
    if model_type == "random_forest":
        if train.count() < FOREST_BLOCKS_FROM:
            return _spark_ml(model_type, RandomForestClassifier(seed=seed, **common, **RF_PARAMS), train, features, label)
        return large_forests(train, features, [(features, None)], label=label, seed=seed)[0]
    if model_type in ("xgboost", "gradient_boosting"):
        est = boosted_estimator(model_type, label, seed)
        if train.count() < BOOST_BLOCKS_FROM:
            return _spark_ml(model_type, est, train, features, label)
        return spark_ml_fitted(model_type, fit_boosted(train, features, label, est), features)
    if model_type == "logistic_regression":
        n = train.count()
        est = LogisticRegression(regParam=1.0 / (LR_C * n), elasticNetParam=0.0, standardization=False,
                                 maxIter=LR_MAX_ITER, tol=1e-8, **common)
        return _spark_ml(model_type, est, train, features, label)
    if model_type == "naive_bayes":
        return fit_naive_bayes(train, features, label)
    if model_type == "adaboost":
        return fit_adaboost(train, features, label)
    if model_type == "svm":
        return fit_svm(train, features, label, seed=seed)
    from cohortlab.models.knn import fit_knn
    return fit_knn(train, features, label)


def large_forests(train: DataFrame, features: list[str], fits: list[tuple[list[str], int | None]], fold: str | None = None,
                  label: str = "target", seed: int = 42) -> list[Fitted]:
    """Random forests of many rows, side by side: each with its features and without the rows of its fold (None: with all)."""
    est = RandomForestClassifier(seed=seed, featuresCol=VEC, labelCol=label, **RF_PARAMS)
    return [spark_ml_fitted("random_forest", m, names) for m, (names, _) in zip(fit_forests(train, features, label, est, fits, fold), fits)]


def boosted_estimator(model_type: str, label: str, seed: int) -> GBTClassifier:
    return GBTClassifier(seed=seed, featuresCol=VEC, labelCol=label, **(XGB_PARAMS if model_type == "xgboost" else GB_PARAMS))


def large_boosted(train: DataFrame, features: list[str], fits: list[tuple[str, list[str], int | None]], fold: str | None = None,
                  label: str = "target", seed: int = 42) -> list[Fitted]:
    """Boosted trees of many rows, side by side: each with its kind and features and without the rows of its fold (None: with all)."""
    models = fit_boosted_together(train, features, label, [(names, held, boosted_estimator(kind, label, seed)) for kind, names, held in fits], fold)
    return [spark_ml_fitted(kind, m, names) for m, (kind, names, _) in zip(models, fits)]


# ---------------------------------------------------------------------------
# C7 Gaussian naive Bayes (exact)
# ---------------------------------------------------------------------------

def naive_bayes_params(train: DataFrame, features: list[str], label: str = "target",
                       var_smoothing: float = NB_VAR_SMOOTHING) -> DataFrame:
    """(class, n, prior, <f>__mean, <f>__var) with var = var_pop + epsilon, one grouped aggregation."""
    xs = [F.col(q(c)).cast("double") for c in features]
    eps = F.lit(var_smoothing) * F.greatest(*[F.var_pop(x) for x in xs]) if len(xs) > 1 else \
        F.lit(var_smoothing) * F.var_pop(xs[0])
    eps_v = train.select(eps.alias("e")).scalar()
    n_all = train.select(F.count(F.lit(1))).scalar()
    g = train.groupBy(F.col(q(label)).alias("cls")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"{c}__mean") for c, x in zip(features, xs)],
        *[F.var_pop(x).alias(f"{c}__v") for c, x in zip(features, xs)])
    return g.select("cls", "n", (F.col("n") / n_all).alias("prior"),
                    *[F.col(f"{c}__mean") for c in features],
                    *[(F.col(f"{c}__v") + eps_v).alias(f"{c}__var") for c in features])


def naive_bayes_scores(df: DataFrame, params_rows: list, features: list[str]) -> DataFrame:
    """Joint log-likelihood per class → p1, pred (ties to the smaller class)."""
    jll = {}
    for r in params_rows:
        s = F.lit(math.log(r["prior"]))
        for c in features:
            var = r[f"{c}__var"]
            s = s - F.lit(0.5 * math.log(2.0 * math.pi * var)) - \
                (F.col(q(c)).cast("double") - F.lit(r[f"{c}__mean"])) ** 2 / F.lit(2.0 * var)
        jll[r["cls"]] = s
    classes = sorted(jll)
    if len(classes) == 1:
        only = classes[0]
        return df.select("*", F.lit(1.0 if only == 1 else 0.0).alias("p1"), F.lit(int(only)).alias("pred"))
    j0, j1 = jll[classes[0]], jll[classes[1]]
    # p1 = 1 / (1 + exp(j0 - j1)), computed stably
    d = j1 - j0
    p1 = F.when(d >= 0, 1.0 / (1.0 + F.exp(-d))).otherwise(F.exp(d) / (1.0 + F.exp(d)))
    return df.select("*", p1.alias("p1"), F.when(d > 0, F.lit(classes[1])).otherwise(F.lit(classes[0])).cast("int")
                     .alias("pred"))


def fit_naive_bayes(train: DataFrame, features: list[str], label: str = "target") -> Fitted:
    rows = naive_bayes_params(train, features, label).collect()  # classes x features: bounded
    return Fitted("naive_bayes", features, lambda df: naive_bayes_scores(df, rows, features),
                  extra={"params": rows})


# ---------------------------------------------------------------------------
# C8 AdaBoost (discrete SAMME, depth-1 trees)
# ---------------------------------------------------------------------------

def fit_adaboost(train: DataFrame, features: list[str], label: str = "target", rounds: int = ADA_ROUNDS,
                 rate: float = ADA_RATE) -> Fitted:
    """Discrete SAMME over depth-1 trees on every threshold (see :mod:`cohortlab.models.boosting`)."""
    return adaboost_fitted(features, *fit_stumps(train, features, label, rounds, rate))


def adaboost_fitted(features: list[str], stumps: list, alphas: list[float]) -> Fitted:
    """The weighted vote of stumps (feature, threshold, left class, right class)."""
    total, d = sum(alphas), len(features)

    def stump_pred(s):
        f, thr, left, right = s
        if f is None:
            return F.lit(left)
        return F.when(F.col(q(features[f])).cast("double") <= F.lit(thr), F.lit(left)).otherwise(F.lit(right))

    def predict(df: DataFrame) -> DataFrame:
        dec = F.lit(0.0)
        for s, a in zip(stumps, alphas):
            dec = dec + F.lit(a) * (2 * stump_pred(s) - 1)
        dec = dec / F.lit(total)
        return df.select("*", (1.0 / (1.0 + F.exp(-dec))).alias("p1"), (dec > 0).cast("int").alias("pred"))

    imp = np.zeros(d)
    for (f, *_), a in zip(stumps, alphas):
        if f is not None:
            imp[f] += a
    if imp.sum() > 0:
        imp = imp / imp.sum()
    return Fitted("adaboost", features, predict, list(zip(features, imp.tolist())),
                  extra={"alphas": alphas, "stumps": stumps})


# ---------------------------------------------------------------------------
# C3 SVM: random Fourier features + LinearSVC + Platt scaling
# ---------------------------------------------------------------------------

def _rff_udf(w: np.ndarray, b: np.ndarray):
    scale = math.sqrt(2.0 / w.shape[0])

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def rff(x: pd.Series) -> pd.Series:
        m = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, w.shape[1]))
        z = scale * np.cos(m @ w.T + b)
        return pd.Series(list(z))

    return rff


def _margin_udf(made: Features, coefficients: np.ndarray, intercept: float):
    """Decision values; the features of a few rows at a time are made and forgotten."""
    @F.pandas_udf(T.DoubleType())
    def margin(x: pd.Series) -> pd.Series:
        return pd.Series(made.margins(np.vstack(x.to_numpy()).astype(float), coefficients, intercept) if len(x) else np.zeros(0))

    return margin


def fit_svm(train: DataFrame, features: list[str], label: str = "target", n_components: int = 256,
            seed: int = 42, C: float = SVM_C) -> Fitted:
    xs = F.array(*[F.col(q(c)).cast("double") for c in features])
    # gamma = 1 / (n_features * Var(X)) over all entries of the training matrix
    cells = train.select(F.explode(xs).alias("v"))
    var = cells.select(F.var_pop("v")).first()[0] or 1.0
    gamma = 1.0 / (len(features) * var) if var > 0 else 1.0
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, len(features)))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    made = Features(w, b)

    # LinearSVC keeps its own blocks of the n_components features while it iterates, 2 KB a row: a second copy of them is
    # never cached, only the rows that they come from and the margins (a few numbers a row); of many rows there is no copy at all
    rows = train.select(*[F.col(q(c)) for c in features], F.col(q(label)).cast("double").alias("__y")).persist(StorageLevel.MEMORY_AND_DISK)
    margins = None
    try:
        n = rows.count()
        est = LinearSVC(featuresCol=VEC, labelCol="__y", regParam=1.0 / (C * n), maxIter=SVM_MAX_ITER)
        if n < SVM_BLOCKS_FROM:
            svc = est.fit(rows.select(array_to_vector(_rff_udf(w, b)(xs)).alias(VEC), "__y"))
        else:
            svc, _ = fit_hinge(rows, features, "__y", made, est)
        margin = _margin_udf(made, svc.coefficients.toArray(), svc.intercept)
        margins = rows.select(margin(xs).alias("m"), "__y").persist(StorageLevel.MEMORY_AND_DISK)
        platt = LogisticRegression(featuresCol="mv", labelCol="__y", regParam=0.0).fit(
            margins.select(array_to_vector(F.array("m")).alias("mv"), "__y"))
    finally:
        for kept in (rows, margins):
            if kept is not None:
                kept.unpersist()
    return svm_fitted(features, svc, w, b, float(platt.coefficients[0]), float(platt.intercept), gamma)


def svm_fitted(features: list[str], svc, w: np.ndarray, b: np.ndarray, a: float, c0: float, gamma: float) -> Fitted:
    """A linear SVM over random Fourier features (w, b) with Platt's probabilities (a, c0)."""
    margin = _margin_udf(Features(w, b), svc.coefficients.toArray(), svc.intercept)

    def predict(df: DataFrame) -> DataFrame:
        m = F.coalesce(margin(F.array(*[F.col(q(c)).cast("double") for c in features])), F.lit(float("nan")))
        p1 = 1.0 / (1.0 + F.exp(-(F.lit(a) * m + F.lit(c0))))
        return df.withColumn("p1", p1).withColumn("pred", (F.col("p1") > 0.5).cast("int"))

    return Fitted("svm", features, predict, spark_model=svc,
                  extra={"gamma": gamma, "w": w.tolist(), "b": b.tolist(), "a": a, "c0": c0})


def importance_table(spark, fitted: Fitted) -> DataFrame | None:
    """(feature, importance) for trees / boosting, (feature, coefficient, abs_coefficient) for linear."""
    if fitted.importances is not None:
        return spark.createDataFrame(fitted.importances, "feature string, importance double")
    if fitted.coefficients is not None:
        rows = [(f, c, abs(c)) for f, c in fitted.coefficients]
        return spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")
    return None
