"""Binary-classification metrics over scored rows.

ROC AUC is exact and tie-aware, by a scan of two levels: equal scores are
counted, a range sort deals the distinct ones out and the result is written
once; the number of negatives below a score is the prefix sum over the
ranges before its own (a table of one row a range, joined) plus the running
count inside the range. No step orders all scores in one task, nothing is
read by the driver, and the plan is the same for any number of rows.

AUC = Σ_s pos(s) · (neg_below(s) + neg(s) / 2) / (P · N)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.columns import q
from cohortlab.operators.ranks import running


def _cnt(pred):
    return F.count_if(F.coalesce(pred, F.lit(False)))


def confusion(df: DataFrame, truth: str = "truth", pred: str = "pred", group: list[str] | None = None) -> DataFrame:
    """Tn, fp, fn, tp (matrix [[tn, fp], [fn, tp]]) in one aggregation."""
    t, p = F.col(q(truth)), F.col(q(pred))
    g = df.groupBy(*(group or []))
    return g.agg(_cnt((t == 0) & (p == 0)).alias("tn"), _cnt((t == 0) & (p == 1)).alias("fp"),
                 _cnt((t == 1) & (p == 0)).alias("fn"), _cnt((t == 1) & (p == 1)).alias("tp"))


def _safe(n, d):
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def binary_metrics(conf: DataFrame) -> DataFrame:
    """E2 from E1 counts: accuracy, precision, recall, f1 (zero denominators → 0)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    prec, rec = _safe(tp, tp + fp), _safe(tp, tp + fn)
    return conf.select("*", _safe(tp + tn, tn + fp + fn + tp).alias("accuracy"), prec.alias("precision"),
                       rec.alias("recall"), _safe(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
                       F.array(F.array(tn, fp), F.array(fn, tp)).alias("confusion_matrix"))


def roc_auc(df: DataFrame, score: str = "score", truth: str = "truth", group: list[str] | None = None,
            buckets: int | None = None) -> DataFrame:
    """Exact tie-aware ROC AUC per group; null when a group has one class only.

    ``buckets``: ranges of the sort, by default as many as the session's shuffle partitions.
    """
    names = [f"__a{i}" for i in range(len(group or []))]
    counted = df.groupBy(*[F.col(q(c)).alias(n) for c, n in zip(group or [], names)], F.col(q(score)).cast("double").alias("s")).agg(
        F.count_if(F.col(q(truth)) == 1).alias("pos"), F.count_if(F.col(q(truth)) == 0).alias("neg")).where("s IS NOT NULL")
    scanned = running(counted, names, "s", "neg", "below", buckets)
    agg = scanned.groupBy(*names).agg(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0)).alias("c"),
                                      F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(*[F.col(n).alias(c) for c, n in zip(group or [], names)], F.when(
        (F.col("P") > 0) & (F.col("N") > 0), F.col("c") / (F.col("P") * F.col("N"))).alias("roc_auc"))


def classification_report(df: DataFrame, truth: str = "truth", pred: str = "pred") -> DataFrame:
    """Per label precision, recall, f1, support; then accuracy, macro avg, weighted avg rows.

    Long rows ``(label, precision, recall, f1_score, support)``; the accuracy
    row carries the accuracy in ``f1_score`` as the text report prints it.
    """
    cells = df.groupBy(F.col(q(truth)).alias("t"), F.col(q(pred)).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    ev = cells.select(F.explode(F.array(
        F.struct(F.col("t").cast("string").alias("label"), F.col("n").alias("true_n"), F.lit(0).cast("long").alias("pred_n"),
                 F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).cast("long").alias("tp")),
        F.struct(F.col("p").cast("string").alias("label"), F.lit(0).cast("long").alias("true_n"), F.col("n").alias("pred_n"),
                 F.lit(0).cast("long").alias("tp")))).alias("e")).select("e.*")
    per = ev.groupBy("label").agg(F.sum("true_n").alias("support"), F.sum("pred_n").alias("pred_n"),
                                  F.sum("tp").alias("tp"))
    prec, rec = _safe(F.col("tp"), F.col("pred_n")), _safe(F.col("tp"), F.col("support"))
    per = per.select("label", prec.alias("precision"), rec.alias("recall"),
                     F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0)).alias("f1_score"),
                     F.col("support").cast("long").alias("support"), "tp")
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.avg("precision").alias("mp"),
                  F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    def row(label, p, r, f):
        return F.struct(F.lit(label).alias("label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        F.col("n").cast("long").alias("support"))

    n = F.col("n")
    summary = tot.select(F.inline(F.array(
        row("accuracy", F.lit(None), F.lit(None), _safe(F.col("tp"), n)),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", _safe(F.col("wp"), n), _safe(F.col("wr"), n), _safe(F.col("wf"), n)))))
    return per.drop("tp").unionByName(summary)


def cv_summary(fold_metrics: DataFrame, group: list[str] | None = None, fold: str = "fold") -> DataFrame:
    """E5: fold metric rows (…, fold, metric, value) → mean, population std and the per-fold values."""
    g = list(group or []) + ["metric"]
    return fold_metrics.groupBy(*g).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(fold), F.col("value")))), lambda s: s["value"])
        .alias("fold_values"))


def fold_metrics(scored: DataFrame, fold: str = "fold", truth: str = "truth", pred: str = "pred",
                 group: list[str] | None = None, score: str | None = None) -> DataFrame:
    """Per-fold accuracy / precision / recall / f1 — and the exact AUC where a ``score`` column is named — as long
    rows (input of :func:`cv_summary`)."""
    g = list(group or []) + [fold]
    m = binary_metrics(confusion(scored, truth, pred, g))
    names = ("accuracy", "precision", "recall", "f1_score")
    if score is not None:
        m, names = m.join(roc_auc(scored, score, truth, g), g, "left"), (*names, "roc_auc")
    return m.select(*g, F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])))
