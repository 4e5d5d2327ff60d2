"""Pre-training audit of an enhanced table against its original.

Each check gives one row ``(check_id, check, status, n_issues)``. Two actions
answer all of them: row counts, id integrity, cell equality and the spot check
come from one full outer join of the two tables, each grouped by key before
(the join uses the groups' partitioning, and a key that repeats is one row of
it), as conditional sums; completeness, label presence and the direction means
are one aggregation over the enhanced table. The eight rows are small and are
gathered on the driver to derive the verdict. Unlike the reference, the spot
check reports its real status instead of always passing.

Cells of a key that repeats on a side (an issue of check 2 already) are compared
by their smallest and largest value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.functions.columns import q

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
# Columns whose presence means label leakage.
LEAKAGE_COLUMNS = ("Group", "Visit", "MR Delay")

SCHEMA = "check_id int, check string, status string, n_issues long"


@dataclass(frozen=True)
class Direction:
    """A8 rule: mean(measure | label == low) compared with mean(measure | label == high)."""
    measure: str
    expect: str  # 'greater' (low-group mean > high-group mean) or 'less'


def _status(ok: bool, bad: str = FAIL) -> str:
    return PASS if ok else bad


def _key_facts(original: DataFrame, enhanced: DataFrame, key: str, cols: list[str], spot_ids: list, spot_equal: list[str],
               spot_present: list[str]) -> dict:
    """A1, A2, A3, A7 facts from one full outer join of the keys of both tables."""
    def side(df: DataFrame, s: str) -> DataFrame:
        def cell(c):
            x = F.col(q(c))
            return F.coalesce(x, F.lit("")) if isinstance(df.schema[c].dataType, T.StringType) else x
        aggs = [F.count(F.lit(1)).alias(f"n_{s}")]
        aggs += [f(cell(c)).alias(f"{s}{i}_{n}") for i, c in enumerate(cols) for n, f in (("low", F.min), ("high", F.max))]
        aggs += [F.max(q(c)).alias(f"{s}_same{i}") for i, c in enumerate(spot_equal)]
        aggs += [F.count(q(c)).alias(f"{s}_has{i}") for i, c in enumerate(spot_present) if s == "e"]
        return df.groupBy(F.col(q(key)).alias("k")).agg(*aggs)

    met = side(original, "o").join(side(enhanced, "e"), "k", "full_outer")
    n_o, n_e = (F.coalesce(F.col(f"n_{s}"), F.lit(0)) for s in "oe")
    known = F.col("k").isNotNull()
    differ = [(~F.col(f"o{i}_low").eqNullSafe(F.col(f"e{i}_low")) | ~F.col(f"o{i}_high").eqNullSafe(F.col(f"e{i}_high"))).cast("long")
              for i in range(len(cols))]
    cells = F.when((n_o > 0) & (n_e > 0), sum(differ, F.lit(0).cast("long"))).otherwise(0)
    bad = (n_o != 1) | (n_e != 1)
    for i in range(len(spot_equal)):
        bad = bad | ~F.coalesce(F.col(f"o_same{i}") == F.col(f"e_same{i}"), F.lit(False))
    for i in range(len(spot_present)):
        bad = bad | (F.coalesce(F.col(f"e_has{i}"), F.lit(0)) == 0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return met.agg(total(n_o).alias("rows_o"), total(n_e).alias("rows_e"), F.count_if(known & (n_e > 0)).alias("keys_e"),
                   F.count_if(known & (n_e == 0)).alias("missing"), F.count_if(known & (n_o == 0)).alias("extra"),
                   total(cells).alias("cells"), F.count_if(F.col("k").isin(*[F.lit(v) for v in spot_ids]) & bad).alias("spot")).first().asDict()


def _enhanced_facts(enhanced: DataFrame, original: DataFrame, label: str, directions, label_low, label_high):
    """A4, A6, A8 facts of the enhanced table in ONE aggregation."""
    new_cols = [c for c in enhanced.columns if c not in original.columns]
    has_label = label in enhanced.columns
    dirs_ok = has_label and all(r.measure in enhanced.columns for r in directions)
    lv = F.col(q(label)) if has_label else None
    exprs = [(F.count(lv) if has_label else F.lit(0)).alias("__lab")]
    exprs += [F.count(q(c)).alias(f"__c{i}") for i, c in enumerate(new_cols)]
    if dirs_ok:
        exprs += [F.avg(F.when(lv == label_low, F.col(q(r.measure)))).alias(f"__lo{i}") for i, r in enumerate(directions)]
        exprs += [F.avg(F.when(lv == label_high, F.col(q(r.measure)))).alias(f"__hi{i}") for i, r in enumerate(directions)]
    return enhanced.agg(*exprs).first(), new_cols, has_label, dirs_ok


def run_audit(original: DataFrame, enhanced: DataFrame, key: str, check_columns: list[str], label: str,
              directions: list[Direction], spot_ids: list, spot_equal: list[str], spot_present: list[str],
              label_low=0.0, label_high=1.0) -> DataFrame:
    """The nine rows of the audit."""
    spark: SparkSession = enhanced.sparkSession
    cols = [c for c in check_columns if c in original.columns and c in enhanced.columns]
    enhanced = enhanced.persist(StorageLevel.MEMORY_AND_DISK)  # both actions read it
    try:
        keys = _key_facts(original, enhanced, key, cols, spot_ids, spot_equal, spot_present)
        facts, new_cols, has_label, dirs_ok = _enhanced_facts(enhanced, original, label, directions, label_low, label_high)
    finally:
        enhanced.unpersist()
    n_o, n_e = keys["rows_o"], keys["rows_e"]
    # A1 row count
    rows = [(1, "Row count match", _status(n_o == n_e), abs(n_e - n_o))]
    # A2 id integrity: missing, extra, duplicated ids
    n2 = keys["missing"] + keys["extra"] + n_e - keys["keys_e"]
    rows.append((2, "Session ID integrity", _status(n2 == 0), n2))
    # A3 columns preserved + cell equality on the check columns (strings: null reads as '')
    missing_cols = [c for c in original.columns if c not in enhanced.columns]
    rows.append((3, "Original columns preserved", _status(not missing_cols and keys["cells"] == 0), keys["cells"] + len(missing_cols)))
    # A4 completeness of the new columns (counts from the fused aggregation)
    empty = sum(1 for i, _ in enumerate(new_cols) if facts[f"__c{i}"] == 0)
    rows.append((4, "Feature completeness", _status(empty == 0, WARN), empty))
    # A5 leakage columns
    leaked = [c for c in LEAKAGE_COLUMNS if c in enhanced.columns]
    rows.append((5, "No data leakage", _status(not leaked), len(leaked)))
    # A6 label present
    if has_label:
        n_null = n_e - facts["__lab"]
        rows.append((6, "Label present", _status(n_null < n_e), n_null))
    else:
        rows.append((6, "Label present", FAIL, n_e))
    # A7 spot check of selected ids (ids absent from both sides are skipped)
    rows.append((7, "Patient spot-check", _status(keys["spot"] == 0), keys["spot"]))
    # A8 clinical direction: conditional means (from the fused aggregation)
    if dirs_ok:
        wrong = 0
        for i, r in enumerate(directions):
            lo, hi = facts[f"__lo{i}"], facts[f"__hi{i}"]
            ok = lo is not None and hi is not None and ((lo > hi) if r.expect == "greater" else (lo < hi))
            wrong += 0 if ok else 1
        rows.append((8, "Clinical direction", _status(wrong == 0), wrong))
    else:
        rows.append((8, "Clinical direction", FAIL, len(directions)))
    # A9 verdict
    n_fail = sum(1 for r in rows if r[2] == FAIL)
    rows.append((9, "Verdict", "READY" if n_fail == 0 else "NOT READY", n_fail))
    return spark.createDataFrame(rows, SCHEMA)


def verdict_counts(audit: DataFrame) -> DataFrame:
    """PASS / WARN / FAIL counts over the check rows."""
    return audit.where(F.col("check_id") < 9).groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))
