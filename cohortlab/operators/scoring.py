"""Batch scoring of whole tables.

The reference scores one session per HTTP request; here the same maths runs
as column expressions over every row of a table:

X1 align: the model's feature order; categorical columns through a fixed
   mapping (unknown → 0); numbers via try_cast; absent / null / NaN / text →
   raw 0.0 BEFORE scaling (parity; ``impute='fitted'`` uses the fitted
   imputation values instead).
X2 scale with the training scaler, then keep only the mode's columns in the
   model's order.
X3 score: class, label, confidence = max probability, both probabilities.
X4 two models side by side (each with its own columns); a failing second
   model leaves nulls and an error text instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.functions.columns import argmax_index, display_round, nan_to_null, q, truthy
from cohortlab.operators.encode import apply_label_encoder

# Class labels of the scoring report and of the status map.
CLASS_LABELS = ("Non-Demented", "Demented")
STATUS_LABELS = ("Healthy", "Dementia")


def align_features(df: DataFrame, features: list[str], key: str, categorical: dict[str, dict] | None = None,
                   fill: dict[str, float] | None = None, dictionary: DataFrame | None = None,
                   coded: list[str] | None = None) -> DataFrame:
    """(key, features in order) as doubles; everything missing → fill (0.0). Categorical columns go through a fixed
    mapping (``categorical``) or, those in ``coded``, through the fitted dictionary, which is joined."""
    categorical = categorical or {}
    fill = fill or {}
    if dictionary is not None:
        df = apply_label_encoder(df, dictionary, [c for c in coded or [] if c in df.columns and c in features])
    cols = [F.col(q(key))]
    present = set(df.columns)
    for f in features:
        default = F.lit(float(fill.get(f, 0.0)))
        if f not in present:
            cols.append(default.alias(f))
        elif f in categorical:
            m = F.create_map(*[x for k, v in categorical[f].items() for x in (F.lit(k), F.lit(float(v)))])
            cols.append(F.coalesce(F.element_at(m, F.col(q(f)).cast("string")), default).alias(f))
        else:
            c = F.col(q(f))
            v = c.cast("double") if isinstance(df.schema[f].dataType, T.NumericType) else c.try_cast("double")
            cols.append(F.coalesce(nan_to_null(v), default).alias(f))
    return df.select(cols)


def scale_and_select(aligned: DataFrame, moments: dict[str, tuple[float, float]], keep: list[str],
                     key: str) -> DataFrame:
    """Scale every column that has moments, then keep ``keep`` in that order."""
    out = [F.col(q(key))]
    for f in keep:
        c = F.col(q(f))
        if f in moments:
            mean, sd = moments[f]
            c = (c - F.lit(mean)) / F.lit(sd)
        out.append(c.alias(f))
    return aligned.select(out)


def score_report(scored: DataFrame, key: str, n_features: int, prefix: str = "") -> DataFrame:
    """Class, label, confidence = max(p0, p1), both probabilities, number of features."""
    p1 = F.col("p1")
    cls = argmax_index(F.array(1 - p1, p1)).cast("int")  # a tie goes to the first class
    return scored.select(
        F.col(q(key)),
        cls.alias(f"{prefix}prediction"),
        F.when(cls == 1, CLASS_LABELS[1]).otherwise(CLASS_LABELS[0]).alias(f"{prefix}label"),
        F.greatest(p1, 1 - p1).alias(f"{prefix}confidence"),
        p1.alias(f"{prefix}prob_demented"),
        (1 - p1).alias(f"{prefix}prob_non_demented"),
        F.lit(n_features).alias(f"{prefix}n_features"))


def compare_models(first: DataFrame, second_fn, key: str) -> DataFrame:
    """Left join of the second model's report; if it cannot be built, nulls + error text."""
    try:
        second = second_fn()
        return first.join(second, key, "left").withColumn("second_error", F.lit(None).cast("string"))
    except Exception as e:  # noqa: BLE001 - a failing comparison model must not fail the batch
        return first.withColumn("second_error", F.lit(f"{type(e).__name__}: {e}"))


def ground_truth(rating: Column) -> tuple[Column, Column]:
    """(int truth, label): int null when the rating is missing, yet the label is then 'Non-Demented'."""
    truth = F.when(rating.isNotNull(), (rating > 0).cast("int"))
    label = F.when(truthy(rating > 0), CLASS_LABELS[1]).otherwise(CLASS_LABELS[0])
    return truth, label


def status_label(target: Column) -> Column:
    """0 → Healthy, 1 → Dementia."""
    return F.when(target == 0, STATUS_LABELS[0]).when(target == 1, STATUS_LABELS[1])


def record_view(df: DataFrame, rename: dict[str, str], rating: str, digits: int = 4) -> DataFrame:
    """X5 + P25: renamed columns, numbers rounded half-even to ``digits`` (strings kept), ground truth."""
    out = []
    for src, dst in rename.items():
        c = F.col(q(src))
        if isinstance(df.schema[src].dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = display_round(nan_to_null(c.cast("double")), digits)
        out.append(c.alias(dst))
    truth, label = ground_truth(F.col(q(rating)))
    return df.select(*out, truth.alias("ground_truth"), label.alias("ground_truth_label"))
