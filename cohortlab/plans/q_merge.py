"""Registered merge, join and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.operators import merge
from cohortlab.plans.registry import register, rounded
from cohortlab.sources import tables as T

V = T.with_ctes(T.VISITS_CTE)


def _sides(spark, sf):
    left = T.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    right = T.table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return left, right


def _merged(spark, sf):
    left, right = _sides(spark, sf)
    return merge.validated_merge(left, right, "doc_id", how="outer", left_name="documents", right_name="labels")


MERGED_SQL = """
WITH m AS (
  SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.lang, d.n_chars, l.quality, l.toxic,
         CASE WHEN d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL THEN 'both'
              WHEN d.doc_id IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge
  FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id
)
"""


@register("j1_validated_merge", MERGED_SQL + "SELECT * FROM m")
def j1_validated_merge(spark, sf):
    """documents ⟗ labels on doc_id with key validation and the _merge indicator."""
    return _merged(spark, sf)


@register("j2_merge_audit", MERGED_SQL + """
SELECT count(*) AS total_merged_rows, count(*) FILTER (WHERE _merge = 'both') AS matched_rows,
       count(*) FILTER (WHERE _merge = 'left_only') AS left_only_rows,
       count(*) FILTER (WHERE _merge = 'right_only') AS right_only_rows,
       (SELECT count(*) FROM documents) AS left_rows, (SELECT count(*) FROM labels) AS right_rows,
       round(CAST(count(*) FILTER (WHERE _merge = 'both') AS DOUBLE)
             / greatest((SELECT count(*) FROM documents), (SELECT count(*) FROM labels)), 6) AS match_rate
FROM m""")
def j2_merge_audit(spark, sf):
    left, right = _sides(spark, sf)
    m = merge.validated_merge(left, right, "doc_id", how="outer")
    return rounded(merge.merge_audit(m, left, right), 6)


@register("j2_unmatched_keys", MERGED_SQL + """
SELECT regexp_replace(_merge, '_only$', '') AS side, doc_id AS key FROM m WHERE _merge <> 'both'""")
def j2_unmatched_keys(spark, sf):
    return merge.unmatched_keys(_merged(spark, sf), "doc_id")


@register("j3_unmatched_rows", MERGED_SQL + "SELECT doc_id, lang, n_chars FROM m WHERE _merge = 'left_only'")
def j3_unmatched_rows(spark, sf):
    """Left-only rows; the label columns are all null there and are dropped."""
    return merge.unmatched_rows(_merged(spark, sf), "left")


@register("j4_merge_sample", MERGED_SQL + """
SELECT * FROM m WHERE _merge = 'both' ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id LIMIT 5""")
def j4_merge_sample(spark, sf):
    return merge.merge_sample(_merged(spark, sf), "doc_id", n=5, seed=42)


@register("j6_join_cardinality", V + """
, img AS (SELECT vec_id AS session_id FROM embeddings),
j AS (SELECT img.session_id, v.price FROM visits v RIGHT JOIN img ON v.session_id = img.session_id)
SELECT count(*) AS n_rows, count(DISTINCT session_id) AS n_keys, (SELECT count(*) FROM img) AS n_right,
       (count(*) = (SELECT count(*) FROM img) AND count(DISTINCT session_id) = count(*)) AS ok FROM j""")
def j6_join_cardinality(spark, sf):
    """clinical ⋈ imaging sessions: row count equals the imaging side and keys stay unique."""
    img = T.table(spark, sf, "embeddings").select(F.col("vec_id").alias("session_id"))
    _, check = merge.join_with_check(T.visits(spark, sf).select("session_id", "price"), img, "session_id")
    return check


@register("j7_semi_join", "SELECT o_orderkey, o_totalprice FROM orders o WHERE EXISTS "
                          "(SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def j7_semi_join(spark, sf):
    """Sessions that have a segmentation (orders with lineitems)."""
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return merge.semi_join(o, T.table(spark, sf, "lineitem").select("l_orderkey"), "o_orderkey", "l_orderkey")


@register("j8_anti_join", "SELECT o_orderkey, o_totalprice FROM orders o WHERE NOT EXISTS "
                          "(SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def j8_anti_join(spark, sf):
    """Sessions with no segmentation."""
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return merge.anti_join(o, T.table(spark, sf, "lineitem").select("l_orderkey"), "o_orderkey", "l_orderkey")


@register("j9_lookup_join", V + """
SELECT e.vec_id AS session_id, v.price, v.disc, v.cdr FROM embeddings e LEFT JOIN visits v ON e.vec_id = v.session_id""")
def j9_lookup_join(spark, sf):
    """Imaging sessions get eTIV/nWBV/CDR-like values from the clinical table (null when absent)."""
    img = T.table(spark, sf, "embeddings").select(F.col("vec_id").alias("session_id"))
    return merge.lookup(img, T.visits(spark, sf), "session_id", ["price", "disc", "cdr"])


RUNS = T.with_ctes(T.RUNS_CTE)


@register("j10_run_comparison", RUNS + """
, a AS (SELECT * FROM runs WHERE scenario = 'Baseline (All Features)'),
b AS (SELECT * FROM runs WHERE scenario = 'Without MMSE')
SELECT a.model, round(a.accuracy, 6) AS accuracy_phase1, round(a.f1_score, 6) AS f1_score_phase1,
       round(a.roc_auc, 6) AS roc_auc_phase1, round(b.accuracy, 6) AS accuracy_phase2,
       round(b.f1_score, 6) AS f1_score_phase2, round(b.roc_auc, 6) AS roc_auc_phase2,
       round(b.accuracy - a.accuracy, 6) AS acc_delta, round(b.f1_score - a.f1_score, 6) AS f1_delta,
       round(b.roc_auc - a.roc_auc, 6) AS auc_delta
FROM a JOIN b ON a.model = b.model""")
def j10_run_comparison(spark, sf):
    runs = T.runs(spark, sf)
    a = runs.where(F.col("scenario") == "Baseline (All Features)")
    b = runs.where(F.col("scenario") == "Without MMSE")
    return rounded(merge.compare_runs(a, b), 6)


@register("j13_point_lookup", V + "SELECT session_id, ID, price, cdr FROM visits WHERE session_id = 1")
def j13_point_lookup(spark, sf):
    return merge.point_lookup(T.visits(spark, sf).select("session_id", "ID", "price", "cdr"), "session_id", 1)


@register("u1_key_differences", """
SELECT 'missing' AS side, doc_id AS key FROM (SELECT DISTINCT doc_id FROM documents EXCEPT SELECT DISTINCT doc_id FROM labels)
UNION ALL
SELECT 'extra' AS side, doc_id AS key FROM (SELECT DISTINCT doc_id FROM labels EXCEPT SELECT DISTINCT doc_id FROM documents)""")
def u1_key_differences(spark, sf):
    left, right = _sides(spark, sf)
    return merge.key_differences(left, right, "doc_id")


@register("u2_union_common", """
SELECT id, name, bal, nation, dataset FROM (
  SELECT c_custkey AS id, c_name AS name, c_acctbal AS bal, c_nationkey AS nation, c_mktsegment AS segment,
         'customer' AS dataset FROM customer
  UNION ALL
  SELECT s_suppkey, s_name, s_acctbal, s_nationkey, NULL, 'supplier' FROM supplier)""")
def u2_union_common(spark, sf):
    """Row union of two registries on their common columns (segment exists on one side only)."""
    c = T.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"),
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("dataset"))
    s = T.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"),
        F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("dataset"))
    return merge.union_common(c, s)


@register("u3_append_rows", """
SELECT 'customer' AS source, c_mktsegment AS grp, count(*) AS n, round(avg(c_acctbal), 6) AS mean_bal,
       CAST(NULL AS VARCHAR) AS error FROM customer GROUP BY c_mktsegment
UNION ALL
SELECT 'supplier', CAST(s_nationkey AS VARCHAR), count(*), NULL, 'no segment' FROM supplier GROUP BY s_nationkey""")
def u3_append_rows(spark, sf):
    """Append result rows whose columns differ; absent columns become null."""
    c = (T.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("grp"))
         .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 6).alias("mean_bal"))
         .select(F.lit("customer").alias("source"), "grp", "n", "mean_bal"))
    s = (T.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("grp"))
         .agg(F.count(F.lit(1)).alias("n"))
         .select(F.lit("supplier").alias("source"), "grp", "n", F.lit("no segment").alias("error")))
    return merge.append_rows(c, s)
