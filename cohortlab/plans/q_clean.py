"""Registered profile and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.operators import clean, profile
from cohortlab.plans.registry import register, rounded
from cohortlab.sources import tables as T

V = T.with_ctes(T.VISITS_CTE)
D = T.with_ctes(T.DOCS_CTE)

VISIT_TYPES = [("session_id", "bigint"), ("ID", "string"), ("subject", "bigint"), ("status", "string"),
               ("priority", "string"), ("price", "double"), ("n_items", "bigint"), ("qty", "double"),
               ("disc", "double"), ("tax", "double"), ("cdr", "double")]
IMPUTE_COLS = ["price", "n_items", "qty", "disc", "tax", "cdr"]


def _profile_sql():
    parts = [f"""SELECT '{c}' AS column, {i} AS position, '{t}' AS dtype, count(*) AS n_rows,
                 count(*) - count({c}) AS n_missing,
                 round(CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*), 6) AS pct_missing FROM visits"""
             for i, (c, t) in enumerate(VISIT_TYPES)]
    return V + "\nUNION ALL\n".join(parts)


@register("g1_profile", _profile_sql())
def g1_profile(spark, sf):
    """Shape, dtypes, missing count and percent of every column, one scan."""
    return rounded(profile.profile_columns(T.visits(spark, sf)), 6)


@register("g2_median_impute", V + "SELECT session_id, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM visits)) AS {c}" for c in IMPUTE_COLS) + " FROM visits")
def g2_median_impute(spark, sf):
    """Fill numeric nulls with the column median over all rows."""
    v = T.visits(spark, sf).select("session_id", *IMPUTE_COLS)
    return clean.impute(v, "median", numeric=IMPUTE_COLS, categorical=[])


@register("g2_mean_impute", V + "SELECT session_id, " + ", ".join(
    f"round(coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM visits)), 6) AS {c}" for c in IMPUTE_COLS)
    + " FROM visits")
def g2_mean_impute(spark, sf):
    v = T.visits(spark, sf).select("session_id", *IMPUTE_COLS)
    return rounded(clean.impute(v, "mean", numeric=IMPUTE_COLS, categorical=[]), 6)


@register("g3_mode_impute", D + """
, lab AS (SELECT doc_id, CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS grade, lang FROM docs),
m AS (SELECT grade FROM (SELECT grade, count(*) AS c FROM lab WHERE grade IS NOT NULL GROUP BY grade)
      ORDER BY c DESC, grade LIMIT 1)
SELECT doc_id, coalesce(grade, coalesce((SELECT grade FROM m), 'Unknown')) AS grade, lang FROM lab""")
def g3_mode_impute(spark, sf):
    """Fill string nulls with the most frequent value (smallest on ties)."""
    d = T.docs(spark, sf).select(
        "doc_id", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("grade"), "lang")
    return clean.impute(d, numeric=[], categorical=["grade", "lang"])


@register("g4_key_validation", """
WITH per AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY l_orderkey),
dups AS (SELECT k FROM per WHERE n > 1 AND k IS NOT NULL ORDER BY k LIMIT 10)
SELECT 'lineitem' AS df_name, 'l_orderkey' AS key_column, true AS has_key_column,
       CAST(sum(n) AS BIGINT) AS total_rows, CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys,
       CAST(0 AS BIGINT) AS empty_keys, count(k) AS unique_keys,
       CAST(sum(n) - count(k) AS BIGINT) AS duplicate_keys,
       (SELECT list(CAST(k AS VARCHAR) ORDER BY k) FROM dups) AS duplicate_values,
       (coalesce(sum(n) FILTER (WHERE k IS NULL), 0) = 0 AND sum(n) - count(k) = 0) AS is_valid,
       CAST(NULL AS VARCHAR) AS error
FROM per""")
def g4_key_validation(spark, sf):
    """Key statistics of lineitem.l_orderkey (a key with duplicates)."""
    return profile.validate_keys(T.table(spark, sf, "lineitem"), "l_orderkey", "lineitem")


@register("g5_value_counts", D + """
SELECT quality AS value, count(*) AS count, round(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM docs), 6) AS pct
FROM docs GROUP BY quality""")
def g5_value_counts(spark, sf):
    """Label distribution including the missing group."""
    return rounded(profile.value_counts(T.docs(spark, sf), "quality"), 6)


@register("w5_missing_sorted",
          V + ", prof AS (" + "\nUNION ALL\n".join(
              f"SELECT '{c}' AS column, count(*) - count({c}) AS n_missing FROM visits" for c, _ in VISIT_TYPES)
          + ')\nSELECT "column", n_missing FROM prof WHERE n_missing > 0')
def w5_missing_sorted(spark, sf):
    """Columns that have missing values, by ascending missing count (the profile's plot order)."""
    p = profile.profile_columns(T.visits(spark, sf))
    return p.where(F.col("n_missing") > 0).orderBy("n_missing", "column").select("column", "n_missing")


def _completeness_sql():
    parts = [f"SELECT '{c}' AS column, count(*) - count({c}) AS miss, count(*) AS n FROM visits" for c, _ in VISIT_TYPES]
    return V + ", cols AS (" + " UNION ALL ".join(parts) + """)
SELECT CASE WHEN miss = 0 THEN 'full' WHEN miss < n THEN 'partial' ELSE 'empty' END AS bucket,
       count(*) AS n_columns, list("column" ORDER BY "column") AS columns
FROM cols GROUP BY 1"""


@register("g26_completeness", _completeness_sql())
def g26_completeness(spark, sf):
    return profile.completeness_buckets(T.visits(spark, sf))


@register("p4_suffix_filter", V + "SELECT session_id, ID FROM visits WHERE NOT ends_with(ID, '_MR2')")
def p4_suffix_filter(spark, sf):
    """Drop repeat scans (ID ending in _MR2)."""
    return clean.drop_suffix(T.visits(spark, sf).select("session_id", "ID"), "ID", "_MR2")


@register("p5_binary_target", V + "SELECT session_id, cdr, CAST(coalesce(cdr > 0, false) AS INTEGER) AS target FROM visits")
def p5_binary_target(spark, sf):
    """Rating → 0/1 target, a missing rating counts as 0."""
    return clean.binary_target(T.visits(spark, sf).select("session_id", "cdr"), "cdr")


@register("p5_label_target", D + """
SELECT doc_id, "Group", CAST("Group" IS DISTINCT FROM 'Nondemented' AS INTEGER) AS target FROM (
  SELECT doc_id, CASE quality WHEN 1 THEN 'Nondemented' WHEN 0 THEN 'Demented' END AS "Group" FROM docs)""")
def p5_label_target(spark, sf):
    """String label → (label != negative), a missing label counts as 1."""
    d = T.docs(spark, sf).select(
        "doc_id", F.when(F.col("quality") == 1, "Nondemented").when(F.col("quality") == 0, "Demented").alias("Group"))
    return clean.binary_target(d, "Group")


@register("p6_drop_missing_target", D + "SELECT doc_id, quality AS target FROM docs WHERE quality IS NOT NULL")
def p6_drop_missing_target(spark, sf):
    d = T.docs(spark, sf).select("doc_id", F.col("quality").alias("target"))
    return clean.drop_missing_target(d)


@register("p7_drop_all_null_columns", D + "SELECT doc_id, lang, source, n_chars FROM docs WHERE quality IS NULL")
def p7_drop_all_null_columns(spark, sf):
    """Unlabelled documents: the label columns are entirely null and are dropped."""
    d = T.docs(spark, sf).where(F.col("quality").isNull())
    return clean.drop_all_null_columns(d)


@register("p8_drop_rename", V + "SELECT session_id, ID, subject AS Subject_ID, priority, price FROM visits")
def p8_drop_rename(spark, sf):
    v = T.visits(spark, sf).select("session_id", "ID", "subject", "status", "priority", "price")
    v = clean.drop_if_present(v, "status", "Delay")
    return clean.rename_if_present(v, {"subject": "Subject_ID", "MR Delay": "delay"})


CLINICAL = {"ID": "ID", "session_id": "Subject_ID", "status": "M/F", "priority": "SES", "n_items": "Age", "qty": "MMSE", "price": "eTIV",
            "disc": "nWBV", "tax": "ASF", "cdr": "CDR"}


def clinical(spark, sf):
    """The visits under the names of the clinical sheet."""
    return T.visits(spark, sf).select(*[F.col(a).alias(b) for a, b in CLINICAL.items()])


@register("p1_p3_schema_choices", T.with_ctes(T.VISITS_CTE) + """
SELECT 'CDR' AS target, ['M/F', 'SES', 'Age', 'MMSE', 'eTIV', 'nWBV', 'ASF'] AS features, ['Age', 'MMSE', 'eTIV', 'nWBV', 'ASF'] AS numeric_features,
       ['M/F', 'SES'] AS text_features, count(cdr) AS n_rated, count(*) AS n_rows FROM visits""")
def p1_p3_schema_choices(spark, sf):
    """Target, features without identifiers and their split by type, over the rows that have a rating."""
    v = clinical(spark, sf)
    target = clean.detect_target(v)
    feats = clean.feature_columns(v, target)
    texts = lambda cs: F.array(*[F.lit(c) for c in cs])
    return v.agg(F.lit(target).alias("target"), texts(feats).alias("features"), texts(clean.numeric_columns(v, feats)).alias("numeric_features"),
                 texts(clean.string_columns(v, feats)).alias("text_features"), F.count(F.col(target)).alias("n_rated"), F.count(F.lit(1)).alias("n_rows"))


@register("p9_feature_sets", T.with_ctes(T.VISITS_CTE) + """
, s AS (SELECT unnest([{'n': 'full', 'c': ['M/F', 'SES', 'Age', 'MMSE', 'eTIV', 'nWBV', 'ASF']}, {'n': 'no_mmse', 'c': ['M/F', 'SES', 'Age', 'eTIV', 'nWBV', 'ASF']},
                        {'n': 'imaging_only', 'c': ['M/F', 'Age']}]) AS s)
SELECT s.n AS feature_set, s.c AS features, count(*) AS n_rows, round(avg(CAST(n_items AS DOUBLE)), 6) AS mean_age FROM visits, s GROUP BY s.n, s.c""")
def p9_feature_sets(spark, sf):
    """The columns that each named feature set keeps, on the clinical sheet."""
    v, out = clinical(spark, sf), None
    for name in clean.FEATURE_SETS:
        kept = clean.feature_set(v, name)
        row = kept.agg(F.lit(name).alias("feature_set"), F.array(*[F.lit(c) for c in clean.feature_columns(kept, "CDR")]).alias("features"),
                       F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("Age"), 6).alias("mean_age"))
        out = row if out is None else out.unionByName(row)
    return out


@register("u4_schema_containment", """
SELECT 'orders' AS table_name, true AS ok, []::VARCHAR[] AS missing, count(*) AS n_rows FROM orders
UNION ALL SELECT 'events', false, ['o_custkey', 'o_orderkey'], count(*) FROM events""")
def u4_schema_containment(spark, sf):
    """Does a table have the columns that a job needs? Tables with their missing columns."""
    from cohortlab.operators.merge import schema_contains
    out = None
    for name in ("orders", "events"):
        df = T.table(spark, sf, name)
        ok, missing = schema_contains(df, ["o_custkey", "o_orderkey"])
        row = df.agg(F.lit(name).alias("table_name"), F.lit(ok).alias("ok"), F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing"),
                     F.count(F.lit(1)).alias("n_rows"))
        out = row if out is None else out.unionByName(row)
    return out
