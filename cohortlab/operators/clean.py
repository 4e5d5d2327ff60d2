"""Target detection, feature selection, imputation, filtering.

Fit/apply pairs: ``fit_*`` returns a ONE-row DataFrame of statistics computed
in a single aggregation (one pass over the data however many columns there
are); ``apply_*`` reads that row once and applies the values as literals, so
plans built on top stay flat instead of re-running nested subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.functions.columns import nan_to_null, numeric_fields, q, string_fields, truthy

# Target candidates in priority order, and the identifier
# columns never used as features.
TARGET_CANDIDATES = ("CDR", "Dementia", "Group")
ID_COLUMNS = ("ID", "Subject ID", "Subject_ID", "MRI ID", "dataset", "Hand")
NEGATIVE_LABEL = "Nondemented"


# The columns that each named feature set leaves out.
FEATURE_SETS = {
    "full": (),
    "no_mmse": ("MMSE",),
    "imaging_only": ("MMSE", "nWBV", "eTIV", "ASF", "Delay", "SES"),
}


def feature_set(df: DataFrame, name: str, sets: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """The frame without the columns that a named feature set leaves out; columns that are not there do not matter."""
    sets = FEATURE_SETS if sets is None else sets
    if name not in sets:
        raise ValueError(f"no feature set is called {name!r}; there are {sorted(sets)}")
    return drop_if_present(df, *sets[name])


def detect_target(df: DataFrame, candidates=TARGET_CANDIDATES) -> str:
    """First candidate present in the schema."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"the frame has none of the target columns {list(candidates)}")


def feature_columns(df: DataFrame, target: str, exclude=ID_COLUMNS) -> list[str]:
    """Every column but the target and the identifier list, in schema order."""
    drop = {target, *exclude}
    return [c for c in df.columns if c not in drop]


def numeric_columns(df: DataFrame, columns=None) -> list[str]:
    """P3."""
    num = set(numeric_fields(df))
    return [c for c in (columns or df.columns) if c in num]


def string_columns(df: DataFrame, columns=None) -> list[str]:
    """P3."""
    s = set(string_fields(df))
    return [c for c in (columns or df.columns) if c in s]


def drop_suffix(df: DataFrame, column: str, suffix: str) -> DataFrame:
    """Drop rows whose key ends with ``suffix`` (null keys are kept)."""
    return df.where(~truthy(F.col(q(column)).endswith(suffix)))


def binary_target(df: DataFrame, target_col: str, negative: str = NEGATIVE_LABEL,
                  out: str = "target", rating: bool | None = None) -> DataFrame:
    """P5: a rating column → (c > 0); a string label → (c != negative); otherwise a copy.

    Missing ratings map to 0 and missing labels to 1 (a null predicate is False). ``rating`` says whether a numeric
    column is a rating; by default only the column named CDR (in any case) is one, other numbers are copied.
    """
    dt = df.schema[target_col].dataType
    c = F.col(q(target_col))
    if target_col in ("Dementia", "Group"):
        expr = (~c.eqNullSafe(F.lit(negative))).cast("int") if isinstance(dt, T.StringType) else c
    elif isinstance(dt, T.NumericType) and (target_col.upper() == "CDR" if rating is None else rating):
        expr = truthy(c > 0).cast("int")
    elif isinstance(dt, T.StringType):
        expr = (~c.eqNullSafe(F.lit(negative))).cast("int")
    else:
        expr = c
    return df.withColumn(out, expr)


def drop_missing_target(df: DataFrame, target: str = "target") -> DataFrame:
    """P6."""
    return df.na.drop(subset=[target])


def all_null_columns(df: DataFrame, columns=None) -> list[str]:
    """Columns with no non-null (non-NaN) value: one aggregation, one small row back."""
    cols = list(columns or df.columns)
    if not cols:
        return []
    fl = (T.FloatType, T.DoubleType)
    exprs = []
    for i, c in enumerate(cols):
        e = F.col(q(c))
        if isinstance(df.schema[c].dataType, fl):
            e = nan_to_null(e)
        exprs.append(F.count(e).alias(f"c{i}"))
    row = df.agg(*exprs).first()
    return [c for i, c in enumerate(cols) if row[f"c{i}"] == 0]


def drop_all_null_columns(df: DataFrame, columns=None) -> DataFrame:
    """P7."""
    empty = set(all_null_columns(df, columns))
    return df.select([q(c) for c in df.columns if c not in empty])


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    """P8."""
    return df.drop(*[c for c in columns if c in df.columns])


def rename_if_present(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P8."""
    for a, b in mapping.items():
        if a in df.columns:
            df = df.withColumnRenamed(a, b)
    return df


# ---------------------------------------------------------------------------
# imputation
# ---------------------------------------------------------------------------

def fit_imputer(df: DataFrame, strategy: str = "median", numeric=None, categorical=None,
                accuracy: int | None = None) -> DataFrame:
    """One-row statistics: median/mean per numeric column, mode per string column.

    ``accuracy`` switches the exact median to ``percentile_approx`` for very
    large inputs. NaN counts as missing. Ties of the mode go to the smallest
    value; an all-null string column is filled with 'Unknown'.
    """
    numeric = numeric_columns(df) if numeric is None else numeric
    categorical = string_columns(df) if categorical is None else categorical
    exprs = []
    exact_median = strategy == "median" and accuracy is None and numeric
    for c in numeric:
        v = nan_to_null(F.col(q(c)).cast("double"))
        if strategy == "median":
            e = F.lit(None) if exact_median else F.percentile_approx(v, 0.5, accuracy)
        elif strategy == "mean":
            e = F.avg(v)
        else:
            continue
        exprs.append(e.cast("double").alias(c))
    for c in categorical:
        exprs.append(F.lit(None).cast("string").alias(c))
    if not exprs:
        return df.sparkSession.range(1).select()
    row = df.agg(*exprs)
    if categorical:
        modes = most_frequent(df, categorical)
        row = row.select(*[F.lit(modes.get(c) or "Unknown").alias(c) if c in categorical else F.col(q(c))
                           for c in row.columns])
    if not exact_median:
        return row
    # exact medians of all numeric columns in ONE pipeline: unpivot to (column, value), group by column
    from cohortlab.operators.quantiles import exact_quantiles
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(q(c)).cast("double").alias("v"))
                                        for c in numeric])))
    med = {r["column"]: r["q0"] for r in exact_quantiles(long, "v", [0.5], ["column"], small_groups=True).collect()}
    return row.select(*[F.lit(med.get(c)).cast("double").alias(c) if c in numeric else F.col(q(c))
                        for c in row.columns])


def most_frequent(df: DataFrame, columns: list[str]) -> dict:
    """Mode of every string column, ties to the smallest value, None when all null.

    Counts per (column, value) with partial aggregation, then one bounded
    ``min_by`` per column over (−count, value): no step holds a column's
    distinct values in one place.
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(q(c)).cast("string").alias("v"))
                                        for c in columns]))).where(F.col("v").isNotNull())
    counts = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min_by("v", F.struct((-F.col("n")).alias("n"), F.col("v"))).alias("mode"))
    return {r["column"]: r["mode"] for r in best.collect()}


def imputer_values(fitted: DataFrame) -> dict:
    """The fitted row as a dict by column."""
    return fitted.first().asDict() if fitted.columns else {}


def apply_imputer(df: DataFrame, fitted: DataFrame | dict) -> DataFrame:
    """Fill nulls (and NaN) with the fitted statistic; column order kept.

    ``fitted``: the one row of ``fit_imputer``, or its values where the caller has read it. The values become
    literals, which keeps downstream plans flat; a column without a statistic stays as it is.
    """
    row = fitted if isinstance(fitted, dict) else imputer_values(fitted)
    fl = (T.FloatType, T.DoubleType)
    out = []
    for f in df.schema.fields:
        c = F.col(q(f.name))
        if f.name in row:
            if isinstance(f.dataType, fl):
                c = nan_to_null(c)
            out.append((c if row[f.name] is None else F.coalesce(c, F.lit(row[f.name]))).alias(f.name))
        else:
            out.append(c)
    return df.select(out)


def impute(df: DataFrame, strategy: str = "median", numeric=None, categorical=None,
           accuracy: int | None = None) -> DataFrame:
    """G2 + G3 with statistics over all rows of ``df``."""
    return apply_imputer(df, fit_imputer(df, strategy, numeric, categorical, accuracy))


def fitted_params(fitted: DataFrame, stat: str) -> DataFrame:
    """Long form (column, stat, value) of a one-row fitted frame, for persistence."""
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(stat).alias("stat"),
                              F.col(q(c)).cast("string").alias("value")) for c in fitted.columns])
    return fitted.select(F.inline(rows))
