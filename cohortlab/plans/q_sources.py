"""Registered source and sink queries.

Round trips write into the session's shared checkpoint folder and read the
result back, so the check covers the writer and the reader together.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.models import classifiers as C
from cohortlab.models import suite
from cohortlab.plans import q_features, q_models, q_prep
from cohortlab.plans.registry import register, rounded
from cohortlab.sources import files, sinks
from cohortlab.sources import tables as T

L = T.with_ctes(T.LISTING_CTE)


@register("s1_clinical_scan", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, 'cross-sectional' AS dataset, o_orderkey AS Subject_ID
FROM orders""")
def s1_clinical_scan(spark, sf):
    """Sheet scan with NaN → null, a dataset literal and Subject_ID = key."""
    df = files.read_clinical(spark, f"{sf}/orders.parquet", key="o_orderkey")
    return df.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "dataset", "Subject_ID")


@register("s2_matrix_roundtrip", q_prep._prep_sql())
def s2_matrix_roundtrip(spark, sf):
    """Prepared matrix written as header CSV and read back with a fixed schema."""
    p = rounded(q_prep._prepared(spark, sf).data, 6)
    path = sinks.write_table(p, sinks.scratch_path(spark, "matrix"), "csv")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in p.schema.fields)
    return files.read_matrix(spark, path, schema)


@register("s3_metrics_roundtrip", T.with_ctes(T.RUNS_CTE) + """
SELECT scenario || '~' || model AS model, round(accuracy, 9) AS accuracy, 0.0 AS precision, 0.0 AS recall,
       round(f1_score, 9) AS f1_score, round(roc_auc, 9) AS roc_auc
FROM runs""")
def s3_metrics_roundtrip(spark, sf):
    """Metric JSON of every scenario and model (one folder each) read back; absent keys read as 0."""
    r = T.runs(spark, sf).select(F.concat_ws("~", "scenario", "model").alias("model"), "accuracy", "f1_score", "roc_auc")
    path = sinks.write_json(r, sinks.scratch_path(spark, "metrics"), partition_by=["model"])
    back = files.read_metrics(spark, path, model_re=r"model=([^/]+)", glob="*.json")
    return rounded(back.withColumn("model", F.url_decode(F.replace("model", F.lit("+"), F.lit("%2B")))), 9)


@register("s4_session_manifest", L + """
, s AS (SELECT path, regexp_extract(path, '/(OAS1_[^/]+)/', 1) AS session_id,
               regexp_extract(path, '/([^/]+)/OAS1_[^/]+/', 1) AS disc,
               regexp_extract(path, '^(.*/OAS1_[^/]+)/', 1) AS session_dir FROM listing),
g AS (SELECT session_id, min(disc) AS disc, min(session_dir) AS session_dir,
             min(path) FILTER (WHERE contains(path, '/FSL_SEG/') AND ends_with(path, '_fseg.hdr')) AS path_fsl_seg_hdr,
             min(path) FILTER (WHERE contains(path, '/FSL_SEG/') AND ends_with(path, '_fseg.txt')) AS path_fsl_seg_txt,
             min(path) FILTER (WHERE contains(path, '/PROCESSED/MPRAGE/T88_111/')
                               AND ends_with(path, '_t88_masked_gfc.hdr')) AS path_t88_masked_hdr
      FROM s WHERE session_id <> '' GROUP BY session_id)
SELECT *, path_fsl_seg_hdr IS NOT NULL AS has_fsl_seg_img, path_fsl_seg_txt IS NOT NULL AS has_fsl_seg_txt,
       path_t88_masked_hdr IS NOT NULL AS has_t88_masked FROM g""")
def s4_session_manifest(spark, sf):
    """Session manifest from a file listing (paths derived from the pages table)."""
    return files.session_manifest(T.listing(spark, sf))


@register("s7_pair_discovery", L + """
, h AS (SELECT path, substring(path, 1, length(path) - 4) AS stem FROM listing WHERE ends_with(path, '.hdr')),
i AS (SELECT substring(path, 1, length(path) - 4) AS stem FROM listing WHERE ends_with(path, '.img'))
SELECT path FROM h WHERE stem IN (SELECT stem FROM i)""")
def s7_pair_discovery(spark, sf):
    """Header files with a sibling data file."""
    return files.analyze_pairs(T.listing(spark, sf))


OUTCOMES_SQL = L + """
, h AS (SELECT path, substring(path, 1, length(path) - 4) AS stem FROM listing WHERE ends_with(path, '.hdr')),
i AS (SELECT DISTINCT substring(path, 1, length(path) - 4) AS stem FROM listing WHERE ends_with(path, '.img')),
o AS (SELECT DISTINCT substring(path, 1, length(path) - 7) AS stem FROM listing WHERE ends_with(path, '.nii.gz')),
oc AS (SELECT h.path, CASE WHEN i.stem IS NULL THEN 'failed' WHEN o.stem IS NOT NULL THEN 'skipped' ELSE 'success' END
              AS outcome, CASE WHEN i.stem IS NULL THEN 'Missing .img for ' || h.path END AS error
       FROM h LEFT JOIN i ON h.stem = i.stem LEFT JOIN o ON h.stem = o.stem)
"""


@register("s8_batch_outcomes", OUTCOMES_SQL + "SELECT * FROM oc")
def s8_batch_outcomes(spark, sf):
    """Per header: failed (no data file), skipped (converted output exists), success."""
    return files.batch_outcomes(T.listing(spark, sf))


@register("s8_batch_summary", OUTCOMES_SQL + """
SELECT count(*) AS total, count(*) FILTER (WHERE outcome = 'success') AS success,
       count(*) FILTER (WHERE outcome = 'skipped') AS skipped, count(*) FILTER (WHERE outcome = 'failed') AS failed
FROM oc""")
def s8_batch_summary(spark, sf):
    return files.batch_summary(files.batch_outcomes(T.listing(spark, sf)))


@register("s9_parquet_roundtrip", q_features.IMG + q_features.COUNTS_SQL + "\nSELECT * FROM counts")
def s9_parquet_roundtrip(spark, sf):
    """Label counts written as Parquet partitioned by status and read back."""
    from cohortlab.operators import tissue
    df = tissue.label_counts(T.slabs(spark, sf), T.meta(spark, sf))
    path = sinks.write_table(df, sinks.scratch_path(spark, "counts"), partition_by=["seg_status"])
    return spark.read.parquet(path)


def _params_sql():
    """Fill values, dictionaries, moments and feature order from the same rows."""
    feats, strings = q_models.FEATS, ("status", "priority")
    num = lambda c, stat, value, src="": f"SELECT '{c}' AS \"column\", '{stat}' AS stat, CAST(NULL AS VARCHAR) AS text, round(CAST({value} AS DOUBLE), 6) AS number{src}"
    parts = [num(c, "fill", f"(SELECT median({c}) FROM visits)") for c in q_prep.NUM + ["cdr"]]
    parts += [f"SELECT '{c}', 'fill', (SELECT {c} FROM visits WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), NULL" for c in strings]
    parts += [f"SELECT '{c}', 'code', v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) FROM (SELECT DISTINCT {c} AS v FROM flt) x" for c in strings]
    parts += [num(c, stat, f"{m}_{c}", f" FROM st WHERE NOT b_{c}") for c in feats for stat, m in (("mean", "m"), ("scale", "s"))]
    parts += [num(c, "feature_order", i) for i, c in enumerate(feats)]
    return q_prep._prep_body() + "\n" + " UNION ALL ".join(parts)


@register("s11_params_roundtrip", _params_sql())
def s11_params_roundtrip(spark, sf):
    """Fitted preparation state (fill values, dictionaries, moments, feature order) saved and reloaded."""
    prep = q_prep._prepared(spark, sf)
    path = sinks.save_params(prep.params(spark), sinks.scratch_path(spark, "params"))
    back = sinks.load_params(spark, path)
    assert back["features"] == prep.features and back["moments"].keys() == prep.moments.keys()
    strings = [c for c, v in back["fill"].items() if isinstance(v, str)]
    rows = [(c, "fill", v if c in strings else None, None if c in strings else v) for c, v in back["fill"].items()]
    rows += [(c, n, None, x) for c, m in back["moments"].items() for n, x in zip(("mean", "scale"), m)]
    rows += [(c, "feature_order", None, float(i)) for i, c in enumerate(back["features"])]
    state = spark.createDataFrame(rows, "column string, stat string, text string, number double")
    codes = back["dictionary"].select("column", F.lit("code").alias("stat"), F.col("value").alias("text"), F.col("code").cast("double").alias("number"))
    return rounded(state.unionByName(codes), 6)


@register("s12_model_roundtrip", q_models._nb_sql())
def s12_model_roundtrip(spark, sf):
    """Naive Bayes saved as a parameter table, reloaded, and used to score the test rows."""
    p = q_models.prepared(spark, sf)
    f = C.fit_naive_bayes(p.where(F.col("split") == "train"), q_models.FEATS)
    path = sinks.save_model(f, sinks.scratch_path(spark, "nb"), spark)
    g = sinks.load_naive_bayes(spark, path, q_models.FEATS)
    return g.transform(p.where(F.col("split") == "test")).select(q_models.KEY, F.round("p1", 6).alias("p1"), "pred")


SAVED_KINDS = C.MODEL_TYPES


@register("s12_models_roundtrip", q_prep._prep_body() + """
SELECT m.model, count(*) AS n_test, 0 AS n_changed FROM sp, (SELECT unnest([""" + ", ".join(f"'{m}'" for m in SAVED_KINDS) + """]) AS model) m
WHERE split = 'test' GROUP BY m.model""")
def s12_models_roundtrip(spark, sf):
    """Models fitted, saved, loaded and used to score the test rows: no prediction may change."""
    p = q_models.prepared(spark, sf)
    train, test = p.where(F.col("split") == "train"), p.where(F.col("split") == "test")
    cells = [(kind, q_models.FEATS, None) for kind in SAVED_KINDS]

    def one(cell, grown):
        kind = cell[0]
        f = grown() if grown is not None else q_models.fit_any(kind, train)
        g = sinks.load_model(spark, sinks.save_model(f, sinks.scratch_path(spark, f"model-{kind}"), spark))
        a, b = (q_models.score_any(x, test).select(q_models.KEY, F.round("p1", 9).alias(n)) for x, n in ((f, "a"), (g, "b")))
        both = a.join(b, q_models.KEY, "full").agg(F.count(F.lit(1)).alias("n_test"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).cast("int").alias("n_changed"))
        return both.select(F.lit(kind).alias("model"), "n_test", "n_changed")

    # the kinds share the executors, as in the suite
    with ThreadPoolExecutor(max_workers=4) as pool, ThreadPoolExecutor(max_workers=2) as beside:
        cells, grown = suite.waiting_last(cells, suite.grown_together(beside, train, q_models.FEATS, cells, train.count()))
        found = dict(zip((c[0] for c in cells), pool.map(one, cells, grown)))
    return reduce(DataFrame.unionByName, [found[kind] for kind in SAVED_KINDS])


@register("s13_run_metadata", q_prep._prep_body() + f"""
SELECT 'visits' AS dataset, 'cdr' AS target, {list(q_models.FEATS)} AS features, {len(q_models.FEATS)} AS n_features,
       count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test,
       count(*) FILTER (WHERE split = 'train' AND target = 1) AS train_pos,
       count(*) FILTER (WHERE split = 'train' AND target = 0) AS train_neg,
       count(*) FILTER (WHERE split = 'test' AND target = 1) AS test_pos,
       count(*) FILTER (WHERE split = 'test' AND target = 0) AS test_neg
FROM sp""")
def s13_run_metadata(spark, sf):
    """Dataset, target, feature list, split sizes and class counts of a preparation run."""
    prep = q_prep._prepared(spark, sf)
    return sinks.run_metadata(prep.data, prep.features, "visits", "cdr")
