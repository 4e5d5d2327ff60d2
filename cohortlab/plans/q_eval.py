"""Registered evaluation, ablation, leaderboard and importance queries.

E1-E5 score the ``score`` fixture (orders as predictions, tied scores).
E8-E11, G20, G22, W4 work on the ``runs`` grid (scenario x model metrics
computed from orders). W1, W3, G21, P28 rank an importance table derived from
the data: |r| of every tissue / regional / clinical feature with the rating.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.functions.columns import fixed_text, percent_text, title_text
from cohortlab.operators import metrics, runs, split, stats
from cohortlab.plans import q_features as QF
from cohortlab.plans.registry import register, rounded
from cohortlab.sources import tables as T

S = T.with_ctes(T.SCORE_CTE)
R = T.with_ctes(T.RUNS_CTE)


@register("e1_confusion_matrix", S + """
SELECT count(*) FILTER (WHERE truth = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE truth = 0 AND pred = 1) AS fp,
       count(*) FILTER (WHERE truth = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE truth = 1 AND pred = 1) AS tp
FROM score""")
def e1_confusion_matrix(spark, sf):
    return metrics.confusion(T.score(spark, sf))


@register("e2_binary_metrics", S + """
, c AS (SELECT count(*) FILTER (WHERE truth = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE truth = 0 AND pred = 1) AS fp,
               count(*) FILTER (WHERE truth = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE truth = 1 AND pred = 1) AS tp
        FROM score)
SELECT tn, fp, fn, tp, round(CASE WHEN tn + fp + fn + tp > 0 THEN (tp + tn) / (tn + fp + fn + tp) ELSE 0.0 END, 9) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 9) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 9) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 9) AS f1_score,
       [[tn, fp], [fn, tp]] AS confusion_matrix
FROM c""")
def e2_binary_metrics(spark, sf):
    """Accuracy, precision, recall, F1 from the confusion counts (zero denominators → 0)."""
    return rounded(metrics.binary_metrics(metrics.confusion(T.score(spark, sf))), 9)


@register("e3_roc_auc", S + """
, g AS (SELECT score AS s, count(*) FILTER (WHERE truth = 1) AS pos, count(*) FILTER (WHERE truth = 0) AS neg
        FROM score GROUP BY score),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM g)
SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) END, 9)
       AS roc_auc FROM c""")
def e3_roc_auc(spark, sf):
    """Exact tie-aware ROC AUC through bucketed prefix sums."""
    return rounded(metrics.roc_auc(T.score(spark, sf)), 9)


@register("e4_classification_report", S + """
, cells AS (SELECT truth AS t, pred AS p, count(*) AS n FROM score GROUP BY truth, pred),
ev AS (SELECT CAST(t AS VARCHAR) AS label, n AS true_n, 0 AS pred_n, CASE WHEN t = p THEN n ELSE 0 END AS tp FROM cells
       UNION ALL SELECT CAST(p AS VARCHAR), 0, n, 0 FROM cells),
per0 AS (SELECT label, sum(true_n) AS support, sum(pred_n) AS pred_n, sum(tp) AS tp FROM ev GROUP BY label),
per AS (SELECT label, CASE WHEN pred_n > 0 THEN tp / pred_n ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support, tp FROM per0),
per2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END
                   AS f1_score FROM per),
tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf,
               sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1_score * support) AS wf FROM per2)
SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1_score, 9) AS f1_score,
       CAST(support AS BIGINT) AS support FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, round(CASE WHEN n > 0 THEN tp / n ELSE 0.0 END, 9), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 9), round(mr, 9), round(mf, 9), CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'weighted avg', round(CASE WHEN n > 0 THEN wp / n ELSE 0.0 END, 9),
                 round(CASE WHEN n > 0 THEN wr / n ELSE 0.0 END, 9), round(CASE WHEN n > 0 THEN wf / n ELSE 0.0 END, 9),
                 CAST(n AS BIGINT) FROM tot""")
def e4_classification_report(spark, sf):
    return rounded(metrics.classification_report(T.score(spark, sf)), 9)


@register("e5_cv_summary", S + """
, f AS (SELECT *, CAST((row_number() OVER (PARTITION BY truth ORDER BY md5(CAST(session_id AS VARCHAR) || ':42')) - 1) % 5
                       AS INTEGER) AS fold FROM score),
c AS (SELECT fold, count(*) FILTER (WHERE truth = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE truth = 0 AND pred = 1) AS fp,
             count(*) FILTER (WHERE truth = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE truth = 1 AND pred = 1) AS tp
      FROM f GROUP BY fold),
m AS (SELECT fold, CASE WHEN tn + fp + fn + tp > 0 THEN (tp + tn) / (tn + fp + fn + tp) ELSE 0.0 END AS accuracy,
             CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
             CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_score FROM c),
l AS (SELECT fold, 'accuracy' AS metric, accuracy AS value FROM m UNION ALL SELECT fold, 'precision', precision FROM m
      UNION ALL SELECT fold, 'recall', recall FROM m UNION ALL SELECT fold, 'f1_score', f1_score FROM m)
SELECT metric, round(avg(value), 9) AS mean, round(stddev_pop(value), 9) AS std,
       list(round(value, 9) ORDER BY fold) AS fold_values
FROM l GROUP BY metric""")
def e5_cv_summary(spark, sf):
    """Per-fold metrics over stratified folds → mean, population std, fold values."""
    folds = split.stratified_kfold(T.score(spark, sf), "truth", "session_id", 5, 42)
    out = metrics.cv_summary(metrics.fold_metrics(folds))
    return out.select("metric", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"),
                      F.transform("fold_values", lambda v: F.round(v, 9)).alias("fold_values"))


# ---------------------------------------------------------------------------
# runs grid
# ---------------------------------------------------------------------------

@register("e8_ablation_drops", R + """
, b AS (SELECT model, accuracy AS baseline FROM runs WHERE scenario = 'Baseline (All Features)')
SELECT scenario, r.model, round(accuracy, 9) AS accuracy, round(baseline, 9) AS baseline,
       round(baseline - accuracy, 9) AS drop
FROM runs r JOIN b ON r.model = b.model WHERE scenario <> 'Baseline (All Features)'""")
def e8_ablation_drops(spark, sf):
    return rounded(runs.ablation_drops(T.runs(spark, sf)), 9)


@register("e9_scenario_flags", R + """
, base AS (SELECT avg(accuracy) AS b FROM runs WHERE scenario = 'Baseline (All Features)'),
g AS (SELECT scenario, avg(accuracy) AS a FROM runs WHERE scenario <> 'Baseline (All Features)' GROUP BY scenario)
SELECT scenario, round(a, 9) AS avg_accuracy, round(b, 9) AS baseline_avg, round(b - a, 9) AS drop,
       round((b - a) / b * 100, 9) AS drop_pct,
       CASE WHEN contains(scenario, 'MMSE') AND b - a > 0.15 THEN 'CRITICAL'
            WHEN contains(scenario, 'Global') AND b - a > 0.10 THEN 'WARNING' END AS flag
FROM g, base""")
def e9_scenario_flags(spark, sf):
    """Average drop per scenario from the baseline average, with CRITICAL / WARNING flags."""
    return rounded(runs.scenario_summary(T.runs(spark, sf)), 9)


@register("e10_performance_band", R + """
, base AS (SELECT avg(accuracy) AS b FROM runs WHERE scenario = 'Baseline (All Features)')
SELECT scenario, model, round(accuracy, 9) AS accuracy,
       CASE WHEN accuracy < 0.83 THEN 'red' WHEN accuracy < 0.87 THEN 'amber' ELSE 'green' END AS band,
       CASE WHEN accuracy < b - 0.05 THEN 'red' WHEN accuracy < b - 0.01 THEN 'amber' ELSE 'green' END AS relative_band
FROM runs, base""")
def e10_performance_band(spark, sf):
    r = T.runs(spark, sf)
    base = r.where(F.col("scenario") == runs.BASELINE).select(F.avg("accuracy")).scalar()
    out = r.select("scenario", "model", F.round("accuracy", 9).alias("accuracy"),
                   runs.performance_band(F.col("accuracy")).alias("band"),
                   runs.performance_band(F.col("accuracy"), base).alias("relative_band"))
    return out


@register("e11_best_per_scenario", R + """
SELECT scenario, model AS best_model, round(accuracy, 9) AS best_accuracy FROM (
  SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY accuracy DESC, model) AS rn FROM runs) WHERE rn = 1""")
def e11_best_per_scenario(spark, sf):
    """Best model per feature set (highest accuracy, ties to the smaller name)."""
    return rounded(runs.best_per_group(T.runs(spark, sf)), 9)


@register("e11_run_averages", R + """
, a AS (SELECT * FROM runs WHERE scenario = 'Baseline (All Features)'),
b AS (SELECT * FROM runs WHERE scenario = 'Without MMSE'),
j AS (SELECT a.accuracy AS a1, b.accuracy AS a2, a.roc_auc AS u1, b.roc_auc AS u2 FROM a JOIN b ON a.model = b.model)
SELECT round(avg(a1), 9) AS avg_accuracy_phase1, round(avg(a2), 9) AS avg_accuracy_phase2,
       round(avg(a2) - avg(a1), 9) AS avg_accuracy_delta, round(avg(u1), 9) AS avg_auc_phase1,
       round(avg(u2), 9) AS avg_auc_phase2, round(avg(u2) - avg(u1), 9) AS avg_auc_delta FROM j""")
def e11_run_averages(spark, sf):
    """Run-vs-run averages over the models present in both runs."""
    from cohortlab.operators.merge import compare_runs
    r = T.runs(spark, sf)
    c = compare_runs(r.where(F.col("scenario") == runs.BASELINE), r.where(F.col("scenario") == "Without MMSE"))
    out = c.agg(F.avg("accuracy_phase1").alias("avg_accuracy_phase1"), F.avg("accuracy_phase2").alias("avg_accuracy_phase2"),
                F.avg("roc_auc_phase1").alias("avg_auc_phase1"), F.avg("roc_auc_phase2").alias("avg_auc_phase2"))
    out = out.select("*", (F.col("avg_accuracy_phase2") - F.col("avg_accuracy_phase1")).alias("avg_accuracy_delta"),
                     (F.col("avg_auc_phase2") - F.col("avg_auc_phase1")).alias("avg_auc_delta"))
    return rounded(out, 9)


@register("g20_grouped_mean_ranked", R + """
SELECT scenario, round(avg(accuracy), 9) AS mean_accuracy FROM runs GROUP BY scenario""")
def g20_grouped_mean_ranked(spark, sf):
    """Mean accuracy per scenario, ascending."""
    from cohortlab.operators.stats import grouped_mean_ranked
    return rounded(grouped_mean_ranked(T.runs(spark, sf), "scenario", "accuracy"), 9)


@register("g22_pivot_results", R + """
SELECT scenario, round(max(accuracy) FILTER (WHERE model = 'logistic_regression'), 9) AS logistic_regression,
       round(max(accuracy) FILTER (WHERE model = 'random_forest'), 9) AS random_forest,
       round(max(accuracy) FILTER (WHERE model = 'xgboost'), 9) AS xgboost
FROM runs GROUP BY scenario""")
def g22_pivot_results(spark, sf):
    """Scenario x model accuracy matrix."""
    models = [m for _, m in T.RUN_MODELS]
    return rounded(runs.pivot_results(T.runs(spark, sf), values=sorted(models)), 9)


@register("w4_leaderboard", R + """
SELECT scenario, model, round(accuracy, 9) AS accuracy, round(f1_score, 9) AS f1_score, round(roc_auc, 9) AS roc_auc, n,
       row_number() OVER (PARTITION BY scenario ORDER BY accuracy DESC, model) AS rank FROM runs""")
def w4_leaderboard(spark, sf):
    return rounded(runs.leaderboard(T.runs(spark, sf), group=["scenario"]), 9)


@register("w2_duplicated_rows", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice IN
  (SELECT o_totalprice FROM orders GROUP BY o_totalprice HAVING count(*) > 1)""")
def w2_duplicated_rows(spark, sf):
    """Every row whose value occurs more than once (keep=False)."""
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return runs.duplicated_rows(o, "o_totalprice")


# ---------------------------------------------------------------------------
# importance table
# ---------------------------------------------------------------------------

TISSUE_FEATS = [c for c in QF.TISSUE_DOUBLES if c != "csv_nwbv"]
REGIONAL_FEATS = [f"{r}_{s}_{m}" for r in QF.roi.REGIONS for s in QF.roi.SIDES for m in QF.PIV_MEASURES] + \
    [f"{r}_{k}" for r in QF.roi.REGIONS for k in ("bilateral_volume_mm3", "asymmetry_index", "laterality_ratio")] + \
    ["total_temporal_lobe_volume_mm3", "hippocampus_to_temporal_ratio"]
CLIN_FEATS = ["price", "qty", "disc", "tax"]
ALL_FEATS = TISSUE_FEATS + REGIONAL_FEATS + CLIN_FEATS


def importance(spark, sf):
    """(feature, importance = |r(feature, rating)|), one pass over the joined feature table."""
    t = QF._tissue(spark, sf).select("session_id", *TISSUE_FEATS)
    r = QF._regional(spark, sf).select("session_id", *REGIONAL_FEATS)
    v = T.visits(spark, sf).select("session_id", "cdr", *CLIN_FEATS)
    j = v.join(t, "session_id", "left").join(r, "session_id", "left")
    agg = stats.correlations_with(j, ALL_FEATS, "cdr").select("feature", F.abs("r").alias("importance"))
    return agg.where(F.col("importance").isNotNull()).select("feature", F.round("importance", 9).alias("importance"))


def _corr_sql(a, b):
    a2, b2 = f"CASE WHEN {b} IS NOT NULL THEN {a} END", f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    return (f"CASE WHEN stddev_pop({a2}) > 0 AND stddev_pop({b2}) > 0 "
            f"THEN covar_pop({a2}, {b2}) / (stddev_pop({a2}) * stddev_pop({b2})) END")


IMP_SQL = QF.BOTH_SQL + """
, fj AS (SELECT v.session_id, v.cdr, """ + ", ".join(f"v.{c}" for c in CLIN_FEATS) + ", " + \
    ", ".join(f"t.{c}" for c in TISSUE_FEATS) + ", " + ", ".join(f"r.{c}" for c in REGIONAL_FEATS) + """
         FROM visits v LEFT JOIN tissue t ON v.session_id = t.session_id LEFT JOIN regional r ON v.session_id = r.session_id),
imp0 AS (""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, abs({_corr_sql(f'CAST({c} AS DOUBLE)', 'cdr')}) AS importance FROM fj" for c in ALL_FEATS) + """),
imp AS (SELECT feature, round(importance, 9) AS importance FROM imp0 WHERE importance IS NOT NULL)
"""


@register("w1_importance_ranking", IMP_SQL + """
SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM imp""")
def w1_importance_ranking(spark, sf):
    """Features by descending importance, ties by name, with rank."""
    return runs.importance_ranking(importance(spark, sf))


@register("w3_top_features", IMP_SQL + "SELECT feature, importance FROM imp ORDER BY importance DESC, feature LIMIT 20")
def w3_top_features(spark, sf):
    """The 20 most important features (a top-k report)."""
    return runs.top_n(importance(spark, sf), 20)


@register("g21_importance_groups", IMP_SQL + """
, tot AS (SELECT sum(importance) AS t FROM imp)
SELECT category, round(importance, 6) AS importance, round(importance / t * 100, 6) AS share_pct FROM (
  SELECT 'original' AS category, coalesce(sum(importance) FILTER (WHERE feature IN ('MMSE', 'Age', 'Educ', 'SES', 'eTIV', 'nWBV', 'ASF')), 0.0) AS importance FROM imp
  UNION ALL SELECT 'mmse', coalesce(sum(importance) FILTER (WHERE feature = 'MMSE'), 0.0) FROM imp
  UNION ALL SELECT 'tissue', coalesce(sum(importance) FILTER (WHERE regexp_matches(feature, 'csf_|gm_|wm_|brain_parenchyma|reconstructed|_frac|_ratio|_to_etiv')), 0.0) FROM imp
  UNION ALL SELECT 'regional', coalesce(sum(importance) FILTER (WHERE regexp_matches(feature, 'hippocampus|ventricle|entorhinal|temporal')), 0.0) FROM imp
), tot""")
def g21_importance_groups(spark, sf):
    """Importance sum and share per category, overlapping predicates (shares may exceed 100%)."""
    out = runs.importance_by_group(importance(spark, sf))
    return rounded(out, 6)


@register("p28_feature_groups", IMP_SQL + """
SELECT feature,
  CASE WHEN contains(feature, 'hippocampus') OR contains(feature, 'ventricle') OR contains(feature, 'entorhinal')
            OR contains(feature, 'temporal') THEN 'regional'
       WHEN contains(feature, 'csf_') OR contains(feature, 'gm_') OR contains(feature, 'wm_')
            OR contains(feature, 'brain_parenchyma') OR contains(feature, 'nwbv') THEN 'tissue'
       WHEN feature IN ('MMSE', 'Age', 'Educ', 'SES', 'M/F', 'eTIV', 'nWBV', 'ASF') THEN 'clinical' ELSE 'other' END AS summary,
  CASE WHEN regexp_matches(feature, 'hippocampus|ventricle|entorhinal|temporal') THEN 'regional'
       WHEN regexp_matches(feature, 'csf_|gm_|wm_|brain_parenchyma|reconstructed|_frac|_ratio|_to_etiv') THEN 'tissue'
       WHEN regexp_matches(feature, '.') THEN 'clinical' ELSE 'other' END AS chart,
  CASE WHEN feature IN ('M/F', 'Age', 'Educ', 'SES', 'MMSE', 'eTIV', 'nWBV', 'ASF', 'Delay') THEN 'clinical'
       WHEN feature IN ('csf_vol_mm3', 'gm_vol_mm3', 'wm_vol_mm3', 'csf_voxels', 'gm_voxels', 'wm_voxels',
                        'brain_parenchyma_vol_mm3', 'total_segmented_vol_mm3', 'csf_frac', 'gm_frac', 'wm_frac',
                        'brain_parenchyma_frac', 'csf_to_brain_ratio', 'gm_wm_ratio', 'reconstructed_nwbv',
                        'brain_parenchyma_to_etiv', 'gm_to_etiv', 'wm_to_etiv', 'csf_to_etiv', 'nwbv_abs_error') THEN 'tissue'
       WHEN regexp_matches(feature, '.') THEN 'regional' ELSE 'other' END AS explorer
FROM imp""")
def p28_feature_groups(spark, sf):
    """Feature → group under the three rule sets (first match wins)."""
    imp = importance(spark, sf)
    f = F.col("feature")
    return imp.select("feature", *[runs.feature_group(f, rs).alias(rs) for rs in ("summary", "chart", "explorer")])


@register("f4_f9_report_lines", R + """
, b AS (SELECT model, accuracy AS baseline FROM runs WHERE scenario = 'Baseline (All Features)')
SELECT scenario, array_to_string(list_transform(string_split(replace(r.model, '_', ' '), ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ') AS model_title,
       printf('%.4f', accuracy) AS accuracy_text, printf('%.1f', (baseline - accuracy) * 100) || '%' AS drop_text
FROM runs r JOIN b USING (model)""")
def f4_f9_report_lines(spark, sf):
    """The grid as report lines: model names in title case, accuracies with four digits, drops as percentages."""
    g = T.runs(spark, sf)
    base = g.where(F.col("scenario") == "Baseline (All Features)").select("model", F.col("accuracy").alias("baseline"))
    return g.join(base, "model").select("scenario", title_text("model").alias("model_title"), fixed_text("accuracy").alias("accuracy_text"),
                                        percent_text(F.col("baseline") - F.col("accuracy")).alias("drop_text"))


@register("w1_global_leaderboard", R + """
SELECT scenario, model, round(accuracy, 9) AS accuracy, row_number() OVER (ORDER BY accuracy DESC, scenario || model) AS rank FROM runs""")
def w1_global_leaderboard(spark, sf):
    """All cells of the grid in one ranking, without a window over all of them."""
    g = T.runs(spark, sf).select("scenario", F.col("model").alias("kind"), "accuracy", F.concat("scenario", "model").alias("model"))
    return rounded(runs.leaderboard(g).select("scenario", F.col("kind").alias("model"), "accuracy", "rank"), 9)
