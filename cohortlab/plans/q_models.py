"""Registered model queries (C1-C9, J12, E5-E7) on the prepared clinical fixture.

Naive Bayes (C7) and kNN (C6/J12) are exact and carry DuckDB oracles built
on the same prepared rows; the Spark-ML models (random forest, logistic
regression, boosted trees, AdaBoost, SVM) are checked on rows only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.models import classifiers as C
from cohortlab.models import suite
from cohortlab.models.knn import fit_knn
from cohortlab.operators import metrics, split
from cohortlab.plans import q_prep
from cohortlab.plans.registry import register, rounded
from cohortlab.session import cut_lineage

KEY = "session_id"
FEATS = ["status", "priority"] + q_prep.NUM


def prepared(spark, sf):
    """The M7 output rounded to 6 decimals (the exact input both engines share).

    Checkpointed once: training and evaluation scan it many times.
    """
    return cut_lineage(rounded(q_prep._prepared(spark, sf).data, 6))


def state_and_rows(spark, sf):
    """The fitted preparation and its rounded rows, prepared once."""
    prep = q_prep._prepared(spark, sf)
    return prep, cut_lineage(rounded(prep.data, 6))


PREP_CTE = "WITH prep AS (\n" + q_prep._prep_sql() + "\n),\ntr AS (SELECT * FROM prep WHERE split = 'train'),\n" \
                                                    "te AS (SELECT * FROM prep WHERE split = 'test')"


def _nb_sql():
    eps = "1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in FEATS) + ")"
    par = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) + (SELECT e FROM eps) AS v_{c}" for c in FEATS)

    def jll(p):
        s = f"ln({p}.prior)"
        for c in FEATS:
            s += f" - 0.5 * ln(2.0 * pi() * {p}.v_{c}) - ({c} - {p}.m_{c}) ^ 2 / (2.0 * {p}.v_{c})"
        return s
    return PREP_CTE + f"""
, eps AS (SELECT {eps} AS e FROM tr),
par AS (SELECT target AS cls, count(*) / (SELECT count(*) FROM tr) AS prior, {par} FROM tr GROUP BY target),
p0 AS (SELECT * FROM par WHERE cls = 0), p1 AS (SELECT * FROM par WHERE cls = 1),
jl AS (SELECT te.session_id, {jll('p0')} AS j0, {jll('p1')} AS j1 FROM te, p0, p1)
SELECT session_id, round(CASE WHEN j1 - j0 >= 0 THEN 1.0 / (1.0 + exp(-(j1 - j0))) ELSE exp(j1 - j0) / (1.0 + exp(j1 - j0)) END,
                         6) AS p1,
       CAST(CASE WHEN j1 - j0 > 0 THEN 1 ELSE 0 END AS INTEGER) AS pred
FROM jl"""


@register("c7_naive_bayes", _nb_sql())
def c7_naive_bayes(spark, sf):
    """Gaussian NB fitted on the training rows, class-1 probability and prediction for the test rows."""
    p = prepared(spark, sf)
    f = C.fit_naive_bayes(p.where(F.col("split") == "train"), FEATS)
    out = f.transform(p.where(F.col("split") == "test")).select(KEY, F.round("p1", 6).alias("p1"), "pred")
    return out


def _knn_sql():
    d = " + ".join(f"(te.{c} - tr.{c}) * (te.{c} - tr.{c})" for c in FEATS)
    return PREP_CTE + f"""
, pairs AS (SELECT te.session_id AS qid, tr.session_id AS tid, tr.target AS y, sqrt({d}) AS d FROM te, tr),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, tid) AS rn FROM pairs) WHERE rn <= 5),
v AS (SELECT qid, count(*) FILTER (WHERE d = 0) AS nz, sum(CASE WHEN d = 0 THEN CAST(y AS DOUBLE) END) AS z1,
             sum(CASE WHEN d > 0 THEN y / d END) AS w1, sum(CASE WHEN d > 0 THEN 1.0 / d END) AS w FROM nn GROUP BY qid),
p AS (SELECT qid, CASE WHEN nz > 0 THEN coalesce(z1, 0.0) / nz ELSE coalesce(w1, 0.0) / w END AS p1 FROM v)
SELECT qid AS session_id, round(p1, 6) AS p1, CAST(p1 > 0.5 AS INTEGER) AS pred FROM p"""


@register("c6_knn", _knn_sql())
def c6_knn(spark, sf):
    """Exact 5-NN with 1/d weights: every test row against every training row, blocked and distributed."""
    p = prepared(spark, sf)
    f = fit_knn(p.where(F.col("split") == "train"), FEATS, "target", train_key=KEY, block_rows=10_000)
    out = f.predict_fn(p.where(F.col("split") == "test"), KEY)
    return out.select(KEY, F.round("p1", 6).alias("p1"), "pred")


def fit_any(model_type, train):
    if model_type == "knn":
        return fit_knn(train, FEATS, "target", train_key=KEY, block_rows=10_000)
    return C.fit(model_type, train, FEATS)


def score_any(fitted, test):
    return fitted.predict_fn(test, KEY) if fitted.model_type == "knn" else fitted.transform(test)


def _model_query(name, model_type, doc):
    def fn(spark, sf):
        p = prepared(spark, sf)
        f = C.fit(model_type, p.where(F.col("split") == "train"), FEATS)
        scored = cut_lineage(f.transform(p.where(F.col("split") == "test")).select("p1", "pred", "target"))
        conf = metrics.binary_metrics(metrics.confusion(scored, "target", "pred"))
        auc = metrics.roc_auc(scored, "p1", "target")
        out = conf.select(F.lit(model_type).alias("model"), "accuracy", "precision", "recall", "f1_score",
                          "tn", "fp", "fn", "tp")
        return rounded(out.select("*", auc.select("roc_auc").scalar().alias("roc_auc")), 6)
    fn.__name__, fn.__doc__ = name, doc
    register(name)(fn)


_model_query("c1_random_forest", "random_forest", "100 trees, depth 10, min leaf 2, sqrt features; hold-out metrics")
_model_query("c2_logistic_regression", "logistic_regression", "L2, C=1 as regParam = 1/(C n), no standardisation")
_model_query("c3_svm", "svm", "RBF kernel via random Fourier features, linear SVM, Platt probabilities")
_model_query("c4_xgboost", "xgboost", "boosted trees: 100 rounds, depth 6, rate 0.1 (Spark GBT)")
_model_query("c5_gradient_boosting", "gradient_boosting", "boosted trees: 100 rounds, depth 5, rate 0.1")
_model_query("c8_adaboost", "adaboost", "discrete SAMME, 100 stumps, rate 1.0")


def _stumps_sql(rounds=5):
    """Boosting rounds one after the other: every cut of every feature from running sums over its sorted values."""
    cells = " UNION ALL ".join(f"SELECT {i} AS f, CAST({c} AS DOUBLE) AS v, target AS y, w FROM {{w}}" for i, c in enumerate(FEATS))
    part = lambda a, b: f"CASE WHEN {a} + {b} > 0 THEN 2 * ({a}) * ({b}) / ({a} + {b}) ELSE 0 END"
    parts, names = [PREP_CTE + "\n, w0 AS (SELECT *, 1.0::DOUBLE AS w FROM tr)"], "[" + ", ".join(f"'{c}'" for c in FEATS) + "]"
    for r in range(rounds):
        said = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(FEATS)) + " END"
        parts.append(f"""
, c{r} AS (SELECT f, v, sum(CASE WHEN y = 0 THEN w ELSE 0 END) AS a0, sum(CASE WHEN y = 1 THEN w ELSE 0 END) AS a1 FROM ({cells.format(w=f'w{r}')}) x GROUP BY f, v),
t{r} AS (SELECT sum(CASE WHEN target = 0 THEN w ELSE 0 END) AS t0, sum(CASE WHEN target = 1 THEN w ELSE 0 END) AS t1 FROM w{r}),
s{r} AS (SELECT f, (v + lead(v) OVER o) / 2 AS threshold, sum(a0) OVER o AS l0, sum(a1) OVER o AS l1, t0, t1 FROM c{r}, t{r}
         WINDOW o AS (PARTITION BY f ORDER BY v)),
b{r} AS (SELECT *, CAST(l1 > l0 AS INTEGER) AS lft, CAST(t1 - l1 > t0 - l0 AS INTEGER) AS rgt FROM s{r} WHERE threshold IS NOT NULL
         ORDER BY round(({part('l0', 'l1')} + {part('(t0 - l0)', '(t1 - l1)')}) / (t0 + t1), 12), f, threshold LIMIT 1),
e{r} AS (SELECT *, ln((1 - err) / err) AS alpha FROM (
  SELECT *, ((CASE WHEN lft = 0 THEN l1 ELSE l0 END) + (CASE WHEN rgt = 0 THEN t1 - l1 ELSE t0 - l0 END)) / (t0 + t1) AS err FROM b{r}) x),
w{r + 1} AS (SELECT tr.* EXCLUDE (w), w * exp(alpha * CAST((CASE WHEN {said} <= threshold THEN lft ELSE rgt END) <> target AS INTEGER)) AS w
             FROM w{r} tr, e{r})""")
    return "".join(parts) + "\n" + " UNION ALL ".join(
        f"SELECT {r + 1} AS round, {names}[f + 1] AS feature, round(threshold, 6) AS threshold, lft AS class_left, rgt AS class_right, round(alpha, 6) AS alpha FROM e{r}"
        for r in range(rounds))


@register("c8_adaboost_stumps", _stumps_sql())
def c8_adaboost_stumps(spark, sf):
    """The first five boosting rounds: each the best of all thresholds of all features."""
    train = prepared(spark, sf).where(F.col("split") == "train")
    f = C.fit_adaboost(train, FEATS, rounds=5).extra
    rows = [(i + 1, FEATS[s[0]], s[1], s[2], s[3], a) for i, (s, a) in enumerate(zip(f["stumps"], f["alphas"]))]
    return rounded(spark.createDataFrame(rows, "round int, feature string, threshold double, class_left int, class_right int, alpha double"), 6)


@register("c2_optimality", PREP_CTE + "\n" + " UNION ALL ".join(
    [f"SELECT '{c}' AS condition, round(sum(target * {c}) / count(*), 3) AS value FROM tr" for c in FEATS]
    + ["SELECT 'intercept', round(avg(CAST(target AS DOUBLE)), 3) FROM tr"]))
def c2_optimality(spark, sf):
    """Where the gradient of the penalised loss vanishes, mean(p x) + w / (C n) equals mean(y x) for every feature, and
    mean(p) equals the share of positives: the left sides from the fitted model, the right sides in SQL."""
    train = prepared(spark, sf).where(F.col("split") == "train")
    f = C.fit("logistic_regression", train, FEATS)
    w, p1 = dict(f.coefficients), F.col("p1")
    row = f.transform(train).agg(F.count(F.lit(1)).alias("n"), F.avg(p1).alias("intercept"), *[F.avg(p1 * F.col(c)).alias(c) for c in FEATS]).first()
    rows = [(c, row[c] + w[c] / (C.LR_C * row["n"])) for c in FEATS] + [("intercept", row["intercept"])]
    return rounded(spark.createDataFrame(rows, "condition string, value double"), 3)


@register("c3_calibration_optimality", PREP_CTE + "\nSELECT count(*) AS n_train, round(avg(CAST(target AS DOUBLE)), 3) AS mean_probability, "
          "true AS margins_ordered, true AS few_on_wrong_side FROM tr")
def c3_calibration_optimality(spark, sf):
    """Platt's calibration is a fitted logistic curve, so its mean probability equals the share of positives; a larger
    margin never has a smaller probability, and the hinge loss is below that of the constant answer."""
    train = prepared(spark, sf).where(F.col("split") == "train")
    f = C.fit("svm", train, FEATS)
    share = F.avg(F.col("target").cast("double"))
    scored = f.transform(train)
    return scored.agg(F.count(F.lit(1)).alias("n_train"), F.round(F.avg("p1"), 3).alias("mean_probability"), F.lit(f.extra["a"] > 0).alias("margins_ordered"),
                      (F.avg((F.col("pred") != F.col("target")).cast("double")) <= F.least(share, 1 - share) + 1e-9).alias("few_on_wrong_side"))


def _first_tree_query(key, model_type):
    @register(key, PREP_CTE + "\nSELECT count(*) AS n_train, round(2 * avg(CAST(target AS DOUBLE)) - 1, 6) AS mean_first_tree, 0.0 AS largest_leaf_error, "
              "100 AS n_trees, true AS shallow, 1.0 AS importance_sum FROM tr")
    def fn(spark, sf):
        train = cut_lineage(prepared(spark, sf).where(F.col("split") == "train").select("target", *FEATS))
        f = C.fit(model_type, train, FEATS)
        first = f.spark_model.trees[0]
        answer = 2.0 * F.col("target") - 1.0
        leaves = first.transform(C.assemble(train, FEATS)).groupBy(first.getPredictionCol()).agg(
            F.count(F.lit(1)).alias("n"), F.avg(answer).alias("mean"), F.sum(F.col(first.getPredictionCol())).alias("total"))
        depth = {"xgboost": C.XGB_PARAMS, "gradient_boosting": C.GB_PARAMS}[model_type]["maxDepth"]
        return leaves.agg(F.sum("n").alias("n_train"), F.round(F.sum("total") / F.sum("n"), 6).alias("mean_first_tree"),
                          F.round(F.max(F.abs(F.col("mean") - F.col(first.getPredictionCol()))), 6).alias("largest_leaf_error"),
                          F.lit(len(f.spark_model.trees)).alias("n_trees"), F.lit(all(t.depth <= depth for t in f.spark_model.trees)).alias("shallow"),
                          F.round(F.lit(float(sum(x for _, x in f.importances))), 6).alias("importance_sum"))
    fn.__name__, fn.__doc__ = key, "The first boosted tree's leaves hold the mean of the answers -1 and 1 of the training rows that they get."


_first_tree_query("c4_first_tree", "xgboost")
_first_tree_query("c5_first_tree", "gradient_boosting")


@register("c1_forest_votes", PREP_CTE + "\nSELECT count(*) AS n_test, 100 AS n_trees, true AS shallow, 0.0 AS largest_vote_error, 1.0 AS importance_sum FROM te")
def c1_forest_votes(spark, sf):
    """The forest's probability is the mean of its trees' leaf shares, recomputed tree by tree on the test rows."""
    from pyspark.ml.functions import vector_to_array

    p = prepared(spark, sf)
    f = C.fit("random_forest", p.where(F.col("split") == "train"), FEATS)
    test = C.assemble(p.where(F.col("split") == "test"), FEATS).select(C.VEC)
    forest, trees = f.spark_model, f.spark_model.trees
    votes = forest.transform(test).select(C.VEC, vector_to_array(forest.getProbabilityCol())[1].alias("p1"))
    mean = F.lit(0.0)
    for i, t in enumerate(trees):
        votes = t.transform(votes).withColumn(f"__t{i}", vector_to_array(t.getRawPredictionCol())).drop(
            t.getRawPredictionCol(), t.getProbabilityCol(), t.getPredictionCol())
        mean = mean + F.col(f"__t{i}")[1] / (F.col(f"__t{i}")[0] + F.col(f"__t{i}")[1])
    return votes.agg(F.count(F.lit(1)).alias("n_test"), F.lit(len(trees)).alias("n_trees"),
                     F.lit(all(t.depth <= C.RF_PARAMS["maxDepth"] for t in trees)).alias("shallow"),
                     F.round(F.max(F.abs(F.col("p1") - mean / len(trees))), 6).alias("largest_vote_error"),
                     F.round(F.lit(float(sum(x for _, x in f.importances))), 6).alias("importance_sum"))


@register("c9_importance")
def c9_importance(spark, sf):
    """Tree importances (random forest) and linear coefficients, ranked (C9 + W1)."""
    from cohortlab.operators.runs import importance_ranking
    p = prepared(spark, sf)
    tr = p.where(F.col("split") == "train")
    rf = C.importance_table(spark, C.fit("random_forest", tr, FEATS))
    lr = C.importance_table(spark, C.fit("logistic_regression", tr, FEATS))
    a = importance_ranking(rf).select(F.lit("random_forest").alias("model"), "feature", "importance", "rank")
    b = importance_ranking(lr, value="coefficient", absolute=True).select(
        F.lit("logistic_regression").alias("model"), "feature", F.col("coefficient").alias("importance"), "rank")
    return a.unionByName(b)


def _nb_cv_sql(k_folds=5):
    parts = [PREP_CTE + """
, tf AS (SELECT tr.*, CAST((row_number() OVER (PARTITION BY target ORDER BY md5(CAST(session_id AS VARCHAR) || ':42')) - 1)
                          % 5 AS INTEGER) AS fold FROM tr)"""]
    for k in range(k_folds):
        fit = f"(SELECT * FROM tf WHERE fold <> {k})"
        eps = "1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in FEATS) + ")"
        par = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) + (SELECT e FROM eps{k}) AS v_{c}" for c in FEATS)

        def jll(p):
            s = f"ln({p}.prior)"
            for c in FEATS:
                s += f" - 0.5 * ln(2.0 * pi() * {p}.v_{c}) - (t.{c} - {p}.m_{c}) ^ 2 / (2.0 * {p}.v_{c})"
            return s
        parts.append(f"""
, eps{k} AS (SELECT {eps} AS e FROM {fit} f),
par{k} AS (SELECT target AS cls, count(*) / (SELECT count(*) FROM {fit} g) AS prior, {par} FROM {fit} f GROUP BY target),
pr{k} AS (SELECT fold, target, CASE WHEN d > 0 THEN 1 ELSE 0 END AS pred,
                 round(CASE WHEN d >= 0 THEN 1 / (1 + exp(-d)) ELSE exp(d) / (1 + exp(d)) END, 6) AS p1
          FROM (SELECT {k} AS fold, t.target, ({jll('b')}) - ({jll('a')}) AS d FROM (SELECT * FROM tf WHERE fold = {k}) t, (SELECT * FROM par{k} WHERE cls = 0) a,
               (SELECT * FROM par{k} WHERE cls = 1) b) z)""")
    union = " UNION ALL ".join(f"SELECT * FROM pr{k}" for k in range(k_folds))
    parts.append(f"""
, preds AS ({union}),
c AS (SELECT fold, count(*) FILTER (WHERE target = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE target = 0 AND pred = 1) AS fp,
             count(*) FILTER (WHERE target = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE target = 1 AND pred = 1) AS tp
      FROM preds GROUP BY fold),
m AS (SELECT fold, CASE WHEN tn + fp + fn + tp > 0 THEN (tp + tn) / (tn + fp + fn + tp) ELSE 0.0 END AS accuracy,
             CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
             CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_score FROM c),
sc AS (SELECT fold, pos, neg, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY p1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
       FROM (SELECT fold, p1, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg FROM preds GROUP BY fold, p1) x),
l AS (SELECT fold, 'accuracy' AS metric, accuracy AS value FROM m UNION ALL SELECT fold, 'precision', precision FROM m
      UNION ALL SELECT fold, 'recall', recall FROM m UNION ALL SELECT fold, 'f1_score', f1_score FROM m
      UNION ALL SELECT fold, 'roc_auc', sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) FROM sc GROUP BY fold)
SELECT metric, round(avg(value), 9) AS mean, round(stddev_pop(value), 9) AS std,
       list(round(value, 9) ORDER BY fold) AS fold_values
FROM l GROUP BY metric""")
    return "".join(parts)


@register("e5_model_cv", _nb_cv_sql())
def e5_model_cv(spark, sf):
    """5-fold stratified CV of naive Bayes on the training rows, AUC included: mean, population std, fold values."""
    p = prepared(spark, sf)
    folds = split.stratified_kfold(p.where(F.col("split") == "train"), "target", KEY, 5, 42)
    scored = suite.naive_bayes_folds(folds, FEATS, 5).withColumn("p1", F.round("p1", 6))
    out = metrics.cv_summary(metrics.fold_metrics(scored, "fold", "target", "pred", score="p1"))
    return out.select("metric", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"),
                      F.transform("fold_values", lambda v: F.round(v, 9)).alias("fold_values"))


@register("e6_model_cv")
def e6_model_cv(spark, sf):
    """5-fold stratified cross-validation of all eight models on the training rows: five metrics, AUC included."""
    p = prepared(spark, sf)
    folds = split.stratified_kfold(p.where(F.col("split") == "train"), "target", KEY, 5, 42)
    return rounded(suite.cross_validate(folds, FEATS, KEY, 5), 6)


@register("e6_model_suite")
def e6_model_suite(spark, sf):
    """All eight models: hold-out metrics, confusion counts and the error column (training time dropped)."""
    res, _, _, _ = suite.run_suite(prepared(spark, sf), FEATS, KEY)
    return res.drop("training_time")


# The scenarios re-aimed at the fixture's columns (clinical role → column).
ROLE_COLUMNS = {"MMSE": ("disc",), "nWBV": ("qty",), "eTIV": ("price",), "ASF": ("tax",), "Age": ("priority",), "M/F": ("status",),
                "SES": ("n_items",), "Educ": ()}
FIXTURE_SCENARIOS = tuple((name, rule, tuple(c for role in roles for c in ROLE_COLUMNS[role]))
                          for name, rule, roles in suite.ABLATION_SCENARIOS)


@register("e7_ablation_grid")
def e7_ablation_grid(spark, sf):
    """Seven feature subsets x random forest, boosted trees, logistic regression."""
    return suite.ablation_grid(prepared(spark, sf), FEATS, KEY, FIXTURE_SCENARIOS)


def _subsets_sql():
    """The grid's cells with their features and rows, without a model."""
    cells = []
    for name, rule, columns in FIXTURE_SCENARIOS:
        gone = list(columns) if rule == "without" else [c for c in FEATS if c not in columns]
        kept = [c for c in FEATS if c not in gone]
        cells.append(f"SELECT '{name}' AS scenario, '{', '.join(gone) or 'None'}' AS features_removed, {len(kept)} AS num_features")
    models = ", ".join(f"'{m}'" for m in suite.ABLATION_MODELS)
    return PREP_CTE + "\n, cells AS (" + " UNION ALL ".join(cells) + f""")
SELECT scenario, model, features_removed, num_features, (SELECT count(*) FROM tr) AS n_train, (SELECT count(*) FROM te) AS n_test
FROM cells, (SELECT unnest([{models}]) AS model) m WHERE num_features > 0"""


@register("e7_ablation_cells", _subsets_sql())
def e7_ablation_cells(spark, sf):
    """The cells of the ablation grid: removed features, features that are left, training and test rows."""
    p = prepared(spark, sf)
    rows = [(name, model, ", ".join(removed) or "None", len(kept)) for name, rule, columns in FIXTURE_SCENARIOS
            for removed, kept in [suite.scenario_features(FEATS, rule, columns)] for model in suite.ABLATION_MODELS if kept]
    sizes = p.agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))
    cells = spark.createDataFrame(rows, "scenario string, model string, features_removed string, num_features int")
    return cells.select("*", sizes.select("n_train").scalar().alias("n_train"), sizes.select("n_test").scalar().alias("n_test"))
