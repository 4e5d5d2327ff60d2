"""Categorical encodings (M1, M2).

M1's dictionary is a table (column, value, code): the distinct values of all categorical columns come from one
aggregation, a range sort numbers them within their column (``ranks.numbered``), and rows meet their codes in a join, which
Spark broadcasts or shuffles by the dictionary's size. A column may have any number of values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.columns import q
from cohortlab.operators.ranks import numbered
from cohortlab.session import stored


def fit_label_encoder(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, code): the distinct non-null values of each column as text, numbered from 0 in sorted order."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(q(c)).cast("string").alias("value")) for c in columns])))
    places = numbered(long.where(F.col("value").isNotNull()).distinct(), ["column"], ["value"])
    return stored(places.select("column", "value", F.col("place").cast("int").alias("code")), "dictionary")


def apply_label_encoder(df: DataFrame, fitted: DataFrame, columns: list[str], unseen: int | None = None) -> DataFrame:
    """value → code of the dictionary; null and values that it lacks → ``unseen``. Columns keep their order."""
    names = {c: f"__code{i}" for i, c in enumerate(columns)}
    out = df
    for c, n in names.items():
        codes = fitted.where(F.col("column") == c).select(F.col("value").alias(f"{n}v"), F.col("code").alias(n))
        out = out.join(codes, F.col(q(c)).cast("string") == F.col(f"{n}v"), "left")
    return out.select(*[F.coalesce(F.col(names[c]), F.lit(unseen).cast("int")).alias(c) if c in names else F.col(q(c)) for c in df.columns])


def label_encode(df: DataFrame, columns: list[str]) -> DataFrame:
    """M1: fit and apply on the same rows."""
    if not columns:
        return df
    return apply_label_encoder(df, fit_label_encoder(df, columns), columns)


def inference_encode(df: DataFrame, column: str, positive: str = "M", out: str | None = None) -> DataFrame:
    """M2: case-insensitive ``positive`` → 1, anything else (unknown, null) → 0."""
    return df.withColumn(out or column, F.when(F.upper(F.col(q(column))) == positive.upper(), 1).otherwise(0))
