"""Result tables: ablation drops, flags, bands, leaderboards, importance groups.

Result tables are small (models x scenarios, or one row per feature) but the
operators never assume it: rankings over them are partitioned by their
grouping key, and totals are scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.columns import q
from cohortlab.operators.ranks import numbered

BASELINE = "Baseline (All Features)"
# Flag rules (substring of the scenario, minimum drop, flag), first match wins.
FLAG_RULES = (("MMSE", 0.15, "CRITICAL"), ("Global", 0.10, "WARNING"))
# Absolute accuracy bands (red below 0.83, amber below 0.87, else green).
ABS_BANDS = (0.83, 0.87)
# Bands relative to the baseline (red below baseline - 0.05, amber below baseline - 0.01).
REL_BANDS = (0.05, 0.01)

# Three feature-group rule sets, first match wins.
GROUP_RULES = {
    # training script summary
    "summary": (
        ("regional", ("contains_any", ("hippocampus", "ventricle", "entorhinal", "temporal"))),
        ("tissue", ("contains_any", ("csf_", "gm_", "wm_", "brain_parenchyma", "nwbv"))),
        ("clinical", ("in", ("MMSE", "Age", "Educ", "SES", "M/F", "eTIV", "nWBV", "ASF"))),
    ),
    # dashboard chart colouring
    "chart": (
        ("regional", ("regex", "hippocampus|ventricle|entorhinal|temporal")),
        ("tissue", ("regex", "csf_|gm_|wm_|brain_parenchyma|reconstructed|_frac|_ratio|_to_etiv")),
        ("clinical", ("regex", ".")),
    ),
    # dashboard feature explorer lists
    "explorer": (
        ("clinical", ("in", ("M/F", "Age", "Educ", "SES", "MMSE", "eTIV", "nWBV", "ASF", "Delay"))),
        ("tissue", ("in", ("csf_vol_mm3", "gm_vol_mm3", "wm_vol_mm3", "csf_voxels", "gm_voxels", "wm_voxels",
                           "brain_parenchyma_vol_mm3", "total_segmented_vol_mm3", "csf_frac", "gm_frac", "wm_frac",
                           "brain_parenchyma_frac", "csf_to_brain_ratio", "gm_wm_ratio", "reconstructed_nwbv",
                           "brain_parenchyma_to_etiv", "gm_to_etiv", "wm_to_etiv", "csf_to_etiv",
                           "nwbv_abs_error"))),
        ("regional", ("regex", ".")),
    ),
}
SUMMARY_OTHER = "other"
# Overlapping category predicates of the importance summary.
IMPORTANCE_GROUPS = (
    ("original", ("in", ("MMSE", "Age", "Educ", "SES", "eTIV", "nWBV", "ASF"))),
    ("mmse", ("in", ("MMSE",))),
    ("tissue", ("regex", "csf_|gm_|wm_|brain_parenchyma|reconstructed|_frac|_ratio|_to_etiv")),
    ("regional", ("regex", "hippocampus|ventricle|entorhinal|temporal")),
)


def _match(c: Column, rule) -> Column:
    kind, arg = rule
    if kind == "in":
        return c.isin(*arg)
    if kind == "regex":
        return c.rlike(arg)
    if kind == "contains_any":
        out = F.lit(False)
        for s in arg:
            out = out | c.contains(s)
        return out
    raise ValueError(kind)


def feature_group(name: Column, rule_set: str = "summary") -> Column:
    """First matching group of the chosen rule set ('other' when none matches)."""
    expr = None
    for group, rule in GROUP_RULES[rule_set]:
        expr = F.when(_match(name, rule), group) if expr is None else expr.when(_match(name, rule), group)
    return expr.otherwise(SUMMARY_OTHER)


def importance_by_group(imp: DataFrame, feature: str = "feature", value: str = "importance",
                        overlap: bool = True, rule_set: str = "summary") -> DataFrame:
    """Importance sum and share of the total per category.

    ``overlap=True`` evaluates every category predicate independently (shares
    may exceed 100%, as in the reference); otherwise first-match groups (P28).
    """
    total = imp.select(F.sum(F.col(q(value)))).scalar()
    f, v = F.col(q(feature)), F.col(q(value))
    if overlap:
        agg = imp.agg(*[F.coalesce(F.sum(F.when(_match(f, rule), v)), F.lit(0.0)).alias(g) for g, rule in IMPORTANCE_GROUPS])
        long = agg.select(F.inline(F.array(*[F.struct(F.lit(g).alias("category"), F.col(g).alias("importance"))
                                             for g, _ in IMPORTANCE_GROUPS])))
    else:
        long = imp.groupBy(feature_group(f, rule_set).alias("category")).agg(F.sum(v).alias("importance"))
    return long.select("category", "importance", (F.col("importance") / total * 100).alias("share_pct"))


def ablation_drops(results: DataFrame, baseline: str = BASELINE, metric: str = "accuracy") -> DataFrame:
    """E8 per model: baseline − scenario (self-join on model against the baseline rows)."""
    b = results.where(F.col("scenario") == baseline).select("model", F.col(metric).alias("baseline"))
    s = results.where(F.col("scenario") != baseline)
    j = s.join(b, "model", "inner")
    return j.select("scenario", "model", F.col(metric).alias(metric), "baseline",
                    (F.col("baseline") - F.col(metric)).alias("drop"))


def scenario_summary(results: DataFrame, baseline: str = BASELINE, metric: str = "accuracy",
                     rules=FLAG_RULES) -> DataFrame:
    """E8 averages + E9 flags: per scenario mean metric, drop from the baseline mean, drop %, flag."""
    base = results.where(F.col("scenario") == baseline).select(F.avg(metric)).scalar()
    g = results.where(F.col("scenario") != baseline).groupBy("scenario").agg(F.avg(metric).alias(f"avg_{metric}"))
    drop = base - F.col(f"avg_{metric}")
    flag = None
    for sub, thr, name in rules:
        cond = F.col("scenario").contains(sub) & (drop > thr)
        flag = F.when(cond, name) if flag is None else flag.when(cond, name)
    return g.select("scenario", f"avg_{metric}", base.alias("baseline_avg"), drop.alias("drop"),
                    (drop / base * 100).alias("drop_pct"), flag.alias("flag"))


def performance_band(value: Column, baseline: Column | None = None) -> Column:
    """Red / amber / green, absolute or relative to a baseline value."""
    if baseline is None:
        return F.when(value < ABS_BANDS[0], "red").when(value < ABS_BANDS[1], "amber").otherwise("green")
    return (F.when(value < baseline - REL_BANDS[0], "red").when(value < baseline - REL_BANDS[1], "amber")
            .otherwise("green"))


def _ranked(df: DataFrame, value: Column, name: str, group: list[str] | None) -> DataFrame:
    """``rank`` by falling value, then name; without a group by a range sort (no window sees all rows)."""
    if group:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(value.desc(), F.col(q(name)))))
    placed = numbered(df.withColumns({"__none": value.isNull(), "__down": -value}), [], ["__none", "__down", name], "__place")
    return placed.withColumn("rank", (F.col("__place") + 1).cast("int")).drop("__none", "__down", "__place")


def leaderboard(results: DataFrame, metric: str = "accuracy", group: list[str] | None = None) -> DataFrame:
    """Rank per group by metric desc (ties by model name)."""
    return _ranked(results, F.col(q(metric)), "model", group)


def best_per_group(results: DataFrame, group: str = "scenario", metric: str = "accuracy") -> DataFrame:
    """Best model per group: highest metric, ties to the smaller model name."""
    return results.groupBy(group).agg(
        F.min_by(F.struct("model", metric), F.struct((-F.col(metric)).alias("m"), F.col("model"))).alias("b")
    ).select(group, F.col("b.model").alias("best_model"), F.col(f"b.{metric}").alias(f"best_{metric}"))


def importance_ranking(imp: DataFrame, value: str = "importance", feature: str = "feature",
                       absolute: bool = False, group: list[str] | None = None) -> DataFrame:
    """Descending importance (absolute value for coefficients), ties by feature name, with rank."""
    key = F.abs(F.col(q(value))) if absolute else F.col(q(value))
    return _ranked(imp, key, feature, group)


def top_n(imp: DataFrame, n: int = 20, value: str = "importance", feature: str = "feature",
          absolute: bool = False) -> DataFrame:
    """The n most important features (TakeOrderedAndProject; a top-k is the feature)."""
    key = F.abs(F.col(q(value))) if absolute else F.col(q(value))
    return imp.orderBy(key.desc(), F.col(q(feature))).limit(n)


def duplicated_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows whose key occurs more than once (keep=False)."""
    dups = df.groupBy(F.col(q(key)).alias("__k")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    return df.join(dups, F.col(q(key)) == F.col("__k"), "left_semi")


def pivot_results(results: DataFrame, index: str = "scenario", columns: str = "model", value: str = "accuracy",
                  values: list[str] | None = None) -> DataFrame:
    """Index x columns matrix of ``value`` (pass ``values`` to skip discovering the pivot keys)."""
    return results.groupBy(index).pivot(columns, values).agg(F.max(value))
