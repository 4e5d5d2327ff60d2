"""Registered encoding, split, scaling and preparation queries (M1-M8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.operators import clean, encode, prepare, scale, split
from cohortlab.plans.registry import register, rounded
from cohortlab.sources import tables as T

V = T.with_ctes(T.VISITS_CTE)
NUM = ["price", "n_items", "qty", "disc", "tax"]


def _targets(spark, sf):
    """visits with the 0/1 target of the rating (missing rating → 0)."""
    return clean.binary_target(T.visits(spark, sf), "cdr")


TARGET_CTE = ", tv AS (SELECT *, CAST(coalesce(cdr > 0, false) AS INTEGER) AS target FROM visits)\n"

QUOTA_SQL = """
, cc AS (SELECT {cls} AS cls, count(*) AS n_class FROM {src} WHERE {cls} IS NOT NULL GROUP BY {cls}),
tot AS (SELECT CAST(sum(n_class) AS BIGINT) AS n,
               CAST(ceil(CAST(sum(n_class) AS DOUBLE) * {p}) AS BIGINT) AS n_test FROM cc),
q1 AS (SELECT cls, n_class, n_class / n * (n - n_test) AS cont FROM cc, tot),
q2 AS (SELECT cls, n_class, CAST(floor(cont) AS BIGINT) AS base, cont - floor(cont) AS rem FROM q1),
q3 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, cls) AS r FROM q2),
nd AS (SELECT (SELECT n - n_test FROM tot) - sum(base) AS need FROM q2),
quota AS (SELECT cls, n_class, base + CASE WHEN r <= (SELECT need FROM nd) THEN 1 ELSE 0 END AS n_train,
                 n_class - (base + CASE WHEN r <= (SELECT need FROM nd) THEN 1 ELSE 0 END) AS n_test FROM q3)
"""


@register("m1_label_encode", V + """
SELECT session_id, CAST(dense_rank() OVER (ORDER BY status) - 1 AS INTEGER) AS status,
       CAST(dense_rank() OVER (ORDER BY priority) - 1 AS INTEGER) AS priority FROM visits""")
def m1_label_encode(spark, sf):
    """Sorted distinct strings → 0..n-1 per categorical column."""
    return encode.label_encode(T.visits(spark, sf).select("session_id", "status", "priority"), ["status", "priority"])


@register("m2_inference_encode", "SELECT o_orderkey, CASE WHEN upper(o_orderstatus) = 'O' THEN 1 ELSE 0 END AS o_orderstatus "
                                 "FROM orders")
def m2_inference_encode(spark, sf):
    """Case-insensitive category → 1, everything else (unknown, null) → 0."""
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return encode.inference_encode(o, "o_orderstatus", positive="o")


@register("m3_class_quotas", V + TARGET_CTE + QUOTA_SQL.format(cls="target", src="tv", p=0.2)
          + "SELECT cls AS target, n_class, n_train, n_test FROM quota")
def m3_class_quotas(spark, sf):
    """n_test = ceil(0.2 n); train quotas by largest remainder; test = rest."""
    return split.class_quotas(_targets(spark, sf), "target", 0.2)


@register("m3_stratified_holdout", V + TARGET_CTE + QUOTA_SQL.format(cls="target", src="tv", p=0.2) + """
, rk AS (SELECT session_id, target, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(session_id AS VARCHAR) || ':42')) AS rk
         FROM tv)
SELECT session_id, target, CASE WHEN rk <= n_test THEN 'test' ELSE 'train' END AS split
FROM rk JOIN quota ON rk.target = quota.cls""")
def m3_stratified_holdout(spark, sf):
    v = _targets(spark, sf).select("session_id", "target")
    return split.stratified_holdout(v, "target", "session_id", 0.2, 42)


@register("m4_subject_split", V + TARGET_CTE + """
, subj AS (SELECT subject, target FROM (
             SELECT subject, target, row_number() OVER (PARTITION BY subject ORDER BY session_id) AS rn FROM tv)
           WHERE rn = 1)
""" + QUOTA_SQL.format(cls="target", src="subj", p=0.2) + """
, rk AS (SELECT subject, target, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(subject AS VARCHAR) || ':42')) AS rk
         FROM subj),
ts AS (SELECT subject FROM rk JOIN quota ON rk.target = quota.cls WHERE rk <= n_test)
SELECT session_id, subject, target, CASE WHEN subject IN (SELECT subject FROM ts) THEN 'test' ELSE 'train' END AS split
FROM tv""")
def m4_subject_split(spark, sf):
    """Subjects are split (label of their first session); every session follows its subject."""
    v = _targets(spark, sf).select("session_id", "subject", "target")
    return split.subject_split(v, "subject", "target", "session_id", 0.2, 42)


BIN_SQL = V + """
, b AS (SELECT CAST(coalesce(cdr > 0, false) AS INTEGER) AS target, CAST(status = 'P' AS INTEGER) AS pending,
               CASE WHEN status = 'P' THEN NULL ELSE 1.0 END AS one_or_null, CAST(NULL AS DOUBLE) AS empty,
               CASE WHEN status = 'F' THEN 2 ELSE 0 END AS zero_two, n_items FROM visits)
SELECT coalesce(bool_and(CAST(target AS DOUBLE) IN (0.0, 1.0)), true) AS target,
       coalesce(bool_and(CAST(pending AS DOUBLE) IN (0.0, 1.0)), true) AS pending,
       coalesce(bool_and(one_or_null IN (0.0, 1.0)), true) AS one_or_null,
       coalesce(bool_and(empty IN (0.0, 1.0)), true) AS empty,
       coalesce(bool_and(CAST(zero_two AS DOUBLE) IN (0.0, 1.0)), true) AS zero_two,
       coalesce(bool_and(CAST(n_items AS DOUBLE) IN (0.0, 1.0)), true) AS n_items
FROM b"""


@register("m5_binary_detection", BIN_SQL)
def m5_binary_detection(spark, sf):
    """Per column: are the non-null values a subset of {0, 1}? (all-null → true)."""
    v = T.visits(spark, sf)
    b = v.select(F.coalesce(F.col("cdr") > 0, F.lit(False)).cast("int").alias("target"),
                 (F.col("status") == "P").cast("int").alias("pending"),
                 F.when(F.col("status") == "P", F.lit(None)).otherwise(F.lit(1.0)).alias("one_or_null"),
                 F.lit(None).cast("double").alias("empty"),
                 F.when(F.col("status") == "F", 2).otherwise(0).alias("zero_two"), "n_items")
    return scale.binary_flags(b, b.columns)


def _scaled_sql(split_expr_sql, cols, digits=6):
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 OR "
                      f"stddev_pop(CAST({c} AS DOUBLE)) IS NULL THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS s_{c}"
                      for c in cols)
    sel = ", ".join(f"round((CAST({c} AS DOUBLE) - m_{c}) / s_{c}, {digits}) AS {c}" for c in cols)
    return split_expr_sql + f", st AS (SELECT {stats} FROM sp WHERE split = 'train')\nSELECT session_id, split, {sel} FROM sp, st"


@register("m6_standardise", _scaled_sql(
    V + TARGET_CTE + QUOTA_SQL.format(cls="target", src="tv", p=0.2) + """
, rk AS (SELECT tv.*, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(session_id AS VARCHAR) || ':42')) AS rk
         FROM tv),
sp AS (SELECT rk.*, CASE WHEN rk <= n_test THEN 'test' ELSE 'train' END AS split FROM rk JOIN quota ON rk.target = quota.cls)
""", ["price", "n_items", "qty", "disc", "tax"]))
def m6_standardise(spark, sf):
    """Scaler fitted on the training rows (population std, zero → 1), applied to all rows; nulls kept."""
    v = _targets(spark, sf).select("session_id", "target", *NUM)
    s = split.stratified_holdout(v, "target", "session_id", 0.2, 42)
    out = scale.standardise(s, NUM, F.col("split") == "train")
    return rounded(out.select("session_id", "split", *NUM), 6)


@register("m8_stratified_kfold", V + TARGET_CTE + """
SELECT session_id, target,
       CAST((row_number() OVER (PARTITION BY target ORDER BY md5(CAST(session_id AS VARCHAR) || ':42')) - 1) % 5 AS INTEGER)
         AS fold
FROM tv""")
def m8_stratified_kfold(spark, sf):
    """Fold = rank inside the class in seeded hash order, mod 5."""
    v = _targets(spark, sf).select("session_id", "target")
    return split.stratified_kfold(v, "target", "session_id", 5, 42)


def _prep_sql():
    cols = ["status", "priority"] + NUM
    sel = ", ".join(f"round(CASE WHEN b_{c} THEN {c} ELSE ({c} - m_{c}) / s_{c} END, 6) AS {c}" for c in cols)
    return _prep_body() + f"\nSELECT ID, subject, session_id, split, target, {sel} FROM sp, st"


def _prep_body():
    """All CTEs of the preparation oracle, ending with ``st`` (training moments and binary flags)."""
    imp = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM visits)) AS {c}" for c in NUM + ["cdr"])
    body = V + f"""
, imp AS (SELECT session_id, ID, subject, status, priority, {imp} FROM visits),
flt AS (SELECT * FROM imp WHERE NOT ends_with(ID, '_MR2')),
enc AS (SELECT session_id, ID, subject, CAST(dense_rank() OVER (ORDER BY status) - 1 AS DOUBLE) AS status,
               CAST(dense_rank() OVER (ORDER BY priority) - 1 AS DOUBLE) AS priority, {', '.join(NUM)},
               CAST(coalesce(cdr > 0, false) AS INTEGER) AS target FROM flt),
subj AS (SELECT subject, target FROM (
           SELECT subject, target, row_number() OVER (PARTITION BY subject ORDER BY session_id) AS rn FROM enc)
         WHERE rn = 1)
""" + QUOTA_SQL.format(cls="target", src="subj", p=0.2) + """
, rk AS (SELECT subject, target, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(subject AS VARCHAR) || ':42')) AS rk
         FROM subj),
ts AS (SELECT subject FROM rk JOIN quota ON rk.target = quota.cls WHERE rk <= n_test),
sp AS (SELECT enc.*, CASE WHEN subject IN (SELECT subject FROM ts) THEN 'test' ELSE 'train' END AS split FROM enc)
"""
    cols = ["status", "priority"] + NUM
    stats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 "
                      f"ELSE stddev_pop({c}) END AS s_{c}, coalesce(bool_and({c} IN (0.0, 1.0)), true) AS b_{c}"
                      for c in cols)
    return body + f", st AS (SELECT {stats} FROM sp WHERE split = 'train')\n"


def _prepared(spark, sf, fit_on="all"):
    v = T.visits(spark, sf)
    return prepare.prepare(v, target="cdr", key="ID", subject="subject", order="session_id", suffix="_MR2",
                           keep=("subject", "session_id"), fit_on=fit_on)


def _prep_train_sql():
    """The preparation that fits everything on the training rows: split first, then medians, modes and codes of them."""
    cols = ["status", "priority"] + NUM
    stats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 "
                      f"ELSE stddev_pop({c}) END AS s_{c}, coalesce(bool_and({c} IN (0.0, 1.0)), true) AS b_{c}" for c in cols)
    modes = ", ".join(f"(SELECT {c} FROM tr0 WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS o_{c}"
                      for c in ("status", "priority"))
    codes = "".join(f""",
d_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code FROM (
  SELECT DISTINCT coalesce({c}, o_{c}) AS v FROM tr0, modes) x)""" for c in ("status", "priority"))
    fills = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM tr0)) AS {c}" for c in NUM)
    sel = ", ".join(f"round(CASE WHEN b_{c} THEN {c} ELSE ({c} - m_{c}) / s_{c} END, 6) AS {c}" for c in cols)
    return V + """
, flt AS (SELECT *, CAST(coalesce(cdr > 0, false) AS INTEGER) AS target FROM visits WHERE NOT ends_with(ID, '_MR2')),
subj AS (SELECT subject, target FROM (
           SELECT subject, target, row_number() OVER (PARTITION BY subject ORDER BY session_id) AS rn FROM flt) WHERE rn = 1)
""" + QUOTA_SQL.format(cls="target", src="subj", p=0.2) + f"""
, rk AS (SELECT subject, target, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(subject AS VARCHAR) || ':42')) AS rk
         FROM subj),
ts AS (SELECT subject FROM rk JOIN quota ON rk.target = quota.cls WHERE rk <= n_test),
al AS (SELECT flt.*, CASE WHEN subject IN (SELECT subject FROM ts) THEN 'test' ELSE 'train' END AS split FROM flt),
tr0 AS (SELECT * FROM al WHERE split = 'train'),
modes AS (SELECT {modes}){codes},
sp AS (SELECT session_id, ID, subject, split, target, coalesce(d_status.code, -1) AS status, coalesce(d_priority.code, -1) AS priority, {fills}
       FROM al CROSS JOIN modes LEFT JOIN d_status ON d_status.v = coalesce(al.status, o_status)
       LEFT JOIN d_priority ON d_priority.v = coalesce(al.priority, o_priority)),
st AS (SELECT {stats} FROM sp WHERE split = 'train')
SELECT ID, subject, session_id, split, target, {sel} FROM sp, st"""


@register("m7_prepare", _prep_sql())
def m7_prepare(spark, sf):
    """impute (all rows) → drop _MR2 → encode → target → subject split → scale on train."""
    p = _prepared(spark, sf)
    return rounded(p.data, 6)


@register("m7_prepare_train", _prep_train_sql())
def m7_prepare_train(spark, sf):
    """The same with everything fitted on the training rows only (``fit_on='train'``)."""
    return rounded(_prepared(spark, sf, "train").data, 6)
