"""Binary-column detection and standardisation fitted on the training rows (M5, M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.columns import nan_to_null, q


def binary_flags(train: DataFrame, columns: list[str]) -> DataFrame:
    """M5: one row, one boolean per column: non-null values ⊆ {0, 1} (all-null counts as binary)."""
    return train.agg(*[F.coalesce(F.bool_and(nan_to_null(F.col(q(c)).cast("double")).isin(0.0, 1.0)),
                                  F.lit(True)).alias(c) for c in columns])


def binary_columns(train: DataFrame, columns: list[str]) -> list[str]:
    """M5 as a list (one small action: a single row of booleans)."""
    if not columns:
        return []
    row = binary_flags(train, columns).first()
    return [c for c in columns if row[c]]


def fit_scaler(train: DataFrame, columns: list[str]) -> DataFrame:
    """M6 fit: one row with ``<c>__mean`` and ``<c>__scale`` (population std; zero → 1)."""
    aggs = []
    for c in columns:
        v = nan_to_null(F.col(q(c)).cast("double"))
        aggs += [F.avg(v).alias(f"{c}__mean"), F.stddev_pop(v).alias(f"{c}__sd")]
    st = train.agg(*aggs)
    out = []
    for c in columns:
        sd = F.col(q(f"{c}__sd"))
        out += [F.col(q(f"{c}__mean")), F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd).alias(f"{c}__scale")]
    return st.select(out)


def fit_columns(train: DataFrame, columns: list[str]) -> tuple[list[str], dict[str, tuple[float, float]]]:
    """M5 and M6 in one pass over the training rows: the binary columns, and (mean, scale) of the others."""
    if not columns:
        return [], {}
    flags = [F.coalesce(F.bool_and(nan_to_null(F.col(q(c)).cast("double")).isin(0.0, 1.0)), F.lit(True)).alias(f"{c}__binary") for c in columns]
    aggs = [a for c in columns for v in (nan_to_null(F.col(q(c)).cast("double")),)
            for a in (F.avg(v).alias(f"{c}__mean"), F.stddev_pop(v).alias(f"{c}__sd"))]
    row = train.agg(*flags, *aggs).first()
    binary = [c for c in columns if row[f"{c}__binary"]]
    return binary, {c: (row[f"{c}__mean"], row[f"{c}__sd"] or 1.0) for c in columns if c not in binary}


def apply_scaler(df: DataFrame, fitted: DataFrame | dict, columns: list[str]) -> DataFrame:
    """M6 apply: (x − mean) / scale for ``columns``; nulls stay null; other columns untouched.

    ``fitted``: the row of ``fit_scaler``, or (mean, scale) by column; applied as literals.
    """
    sc = set(columns)
    if isinstance(fitted, dict):
        row = {f"{c}__{n}": v for c, m in fitted.items() for n, v in zip(("mean", "scale"), m)}
    else:
        row = fitted.first().asDict() if columns else {}
    out = []
    for f in df.schema.fields:
        c = F.col(q(f.name))
        if f.name in sc:
            mean = F.lit(row[f"{f.name}__mean"]).cast("double")
            scale = F.lit(row[f"{f.name}__scale"]).cast("double")
            out.append(((nan_to_null(c.cast("double")) - mean) / scale).alias(f.name))
        else:
            out.append(c)
    return df.select(out)


def standardise(df: DataFrame, columns: list[str], train_filter=None) -> DataFrame:
    """Fit on the training rows (``train_filter`` column expression), apply to all rows."""
    train = df.where(train_filter) if train_filter is not None else df
    return apply_scaler(df, fit_scaler(train, columns), columns)
