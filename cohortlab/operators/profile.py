"""Data-set profile, key validation, value counts, completeness.

Every profile is ONE aggregation over the table, whatever the column count,
then an unpivot of the single stats row into long form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.functions.columns import nan_to_null, q


def _present(field: T.StructField):
    c = F.col(q(field.name))
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        c = nan_to_null(c)
    return F.count(c)


def profile_columns(df: DataFrame) -> DataFrame:
    """G1: (column, position, dtype, n_rows, n_missing, pct_missing) — one scan."""
    fields = df.schema.fields
    stats = df.agg(F.count(F.lit(1)).alias("__n"),
                   *[_present(f).alias(f"__c{i}") for i, f in enumerate(fields)])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(i).alias("position"),
                 F.lit(f.dataType.simpleString()).alias("dtype"),
                 (F.col("__n") - F.col(f"__c{i}")).alias("n_missing"))
        for i, f in enumerate(fields)])
    long = stats.select("__n", F.inline(rows))
    return long.select("column", "position", "dtype", F.col("__n").alias("n_rows"), "n_missing",
                       F.when(F.col("__n") > 0, F.col("n_missing") * 100.0 / F.col("__n")).alias("pct_missing"))


def completeness(profile: DataFrame) -> DataFrame:
    """Per-column bucket full / partial / empty from a G1 profile."""
    return profile.withColumn(
        "bucket",
        F.when(F.col("n_missing") == 0, "full")
        .when(F.col("n_missing") < F.col("n_rows"), "partial")
        .otherwise("empty"))


def completeness_buckets(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(bucket, n_columns, columns) with the sorted column list of each bucket."""
    prof = completeness(profile_columns(df.select([q(c) for c in columns]) if columns else df))
    return prof.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.array_sort(F.collect_list("column")).alias("columns"))


def validate_keys(df: DataFrame, key: str, name: str = "DataFrame", max_examples: int = 10) -> DataFrame:
    """One row of key statistics.

    total_rows, null_keys, empty_keys, unique_keys (non-null distinct),
    duplicate_keys = total - unique (nulls count as duplicates),
    duplicate_values = the first ``max_examples`` duplicated keys in key order,
    is_valid. A missing key column gives is_valid = false and an error text.
    """
    spark = df.sparkSession
    if key not in df.columns:
        return spark.createDataFrame(
            [(name, key, False, None, None, None, None, None, [], False, f"Key column '{key}' not found")],
            "df_name string, key_column string, has_key_column boolean, total_rows long, null_keys long, "
            "empty_keys long, unique_keys long, duplicate_keys long, duplicate_values array<string>, "
            "is_valid boolean, error string")
    k = F.col(q(key))
    is_str = isinstance(df.schema[key].dataType, T.StringType)
    # one shuffle: partial counts per key, then a global fold of the per-key rows
    per_key = df.groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    stats = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("null_keys"),
        (F.coalesce(F.sum(F.when(F.col("k") == "", F.col("n"))), F.lit(0)).cast("long") if is_str
         else F.lit(0).cast("long")).alias("empty_keys"),
        F.count("k").alias("unique_keys"))
    # bounded: TakeOrdered of max_examples keys, never the full duplicate list
    examples = (per_key.where((F.col("n") > 1) & F.col("k").isNotNull())
                .orderBy("k").limit(max_examples)
                .agg(F.transform(F.array_sort(F.collect_list("k")), lambda x: x.cast("string"))
                     .alias("duplicate_values")))
    out = stats.select("*", examples.select("duplicate_values").scalar().alias("duplicate_values"))
    out = out.withColumn("duplicate_keys", F.col("total_rows") - F.col("unique_keys"))
    return out.select(
        F.lit(name).alias("df_name"), F.lit(key).alias("key_column"), F.lit(True).alias("has_key_column"),
        "total_rows", "null_keys", "empty_keys", "unique_keys", "duplicate_keys",
        F.coalesce("duplicate_values", F.array().cast("array<string>")).alias("duplicate_values"),
        ((F.col("null_keys") == 0) & (F.col("empty_keys") == 0) & (F.col("duplicate_keys") == 0)).alias("is_valid"),
        F.lit(None).cast("string").alias("error"))


def value_counts(df: DataFrame, column: str, sort_by: str = "value") -> DataFrame:
    """(value, count, pct) including the null group; pct of all rows.

    The total is a scalar subquery, not a global window or a cross join.
    """
    c = F.col(q(column))
    counts = df.groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = df.select(F.count(F.lit(1))).scalar()
    out = counts.select("value", "count", (F.col("count") * 100.0 / total).alias("pct"))
    if sort_by == "value":
        return out.orderBy(F.col("value").asc_nulls_last())
    return out.orderBy(F.col("count").desc(), F.col("value").asc_nulls_last())
