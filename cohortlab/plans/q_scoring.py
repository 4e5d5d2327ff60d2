"""Registered batch-scoring queries.

The fitted state comes from the M7 preparation of the visits fixture; the
scored table is the whole raw visits table (every session, repeat scans
included), aligned with raw 0.0 for anything missing as the reference does.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.functions.columns import display_round
from cohortlab.models import classifiers as C
from cohortlab.operators import scoring
from cohortlab.plans import q_prep
from cohortlab.plans.q_models import FEATS, KEY, state_and_rows
from cohortlab.plans.registry import register, rounded
from cohortlab.sources import tables as T

ALIGN = FEATS + ["ses"]          # 'ses' is absent from the table: raw 0.0
MODE_DROP = {"full": (), "no_mmse": ("disc",)}


def _state(spark, sf):
    return q_prep._prepared(spark, sf)


def _aligned(spark, sf, prep):
    return scoring.align_features(T.visits(spark, sf), ALIGN, KEY, dictionary=prep.dictionary, coded=prep.categorical)


def _scaled(spark, sf, prep, mode="full"):
    keep = [c for c in FEATS if c not in MODE_DROP[mode]]
    return scoring.scale_and_select(_aligned(spark, sf, prep), prep.moments, keep, KEY)


def _rounded_cols(cols):
    return ", ".join(f"round(CASE WHEN b_{c} THEN {c} ELSE ({c} - m_{c}) / s_{c} END, 6) AS {c}" for c in cols)


BASE = q_prep._prep_body() + f"""
, prep AS (SELECT ID, subject, session_id, split, target, {_rounded_cols(FEATS)} FROM sp, st),
tr AS (SELECT * FROM prep WHERE split = 'train'),
ds AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code FROM (SELECT DISTINCT status AS v FROM flt)),
dp AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code FROM (SELECT DISTINCT priority AS v FROM flt)),
al AS (SELECT v.session_id, coalesce(ds.code, 0.0) AS status, coalesce(dp.code, 0.0) AS priority,
              {', '.join(f'coalesce(CAST(v.{c} AS DOUBLE), 0.0) AS {c}' for c in q_prep.NUM)}, 0.0 AS ses
       FROM visits v LEFT JOIN ds ON v.status = ds.v LEFT JOIN dp ON v.priority = dp.v),
sc AS (SELECT session_id, {', '.join(f'CASE WHEN b_{c} THEN {c} ELSE ({c} - m_{c}) / s_{c} END AS {c}' for c in FEATS)}
       FROM al, st)
"""


@register("x1_feature_alignment", BASE + "SELECT * FROM al")
def x1_feature_alignment(spark, sf):
    """Model-ordered raw vector: dictionary codes, try-cast numbers, absent / null → 0.0."""
    prep = _state(spark, sf)
    return _aligned(spark, sf, prep)


@register("x2_scaled_vector", BASE + "SELECT session_id, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in FEATS if c != "disc") + " FROM sc")
def x2_scaled_vector(spark, sf):
    """Scale with the training scaler, then drop the mode's columns (no-MMSE mode drops 'disc')."""
    prep = _state(spark, sf)
    return rounded(_scaled(spark, sf, prep, "no_mmse"), 6)


def _nb_sql(feats, rows="sc", prefix=""):
    eps = "1e-9 * greatest(" + ", ".join(f"var_pop({c})" for c in feats) + ")"
    par = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) + (SELECT e FROM eps{prefix}) AS v_{c}" for c in feats)

    def jll(p):
        s = f"ln({p}.prior)"
        for c in feats:
            s += f" - 0.5 * ln(2.0 * pi() * {p}.v_{c}) - ({rows}.{c} - {p}.m_{c}) ^ 2 / (2.0 * {p}.v_{c})"
        return s
    return f"""
, eps{prefix} AS (SELECT {eps} AS e FROM tr),
par{prefix} AS (SELECT target AS cls, count(*) / (SELECT count(*) FROM tr) AS prior, {par} FROM tr GROUP BY target),
jl{prefix} AS (SELECT {rows}.session_id, {jll('a')} AS j0, {jll('b')} AS j1
               FROM {rows}, (SELECT * FROM par{prefix} WHERE cls = 0) a, (SELECT * FROM par{prefix} WHERE cls = 1) b),
pp{prefix} AS (SELECT session_id, CASE WHEN j1 - j0 >= 0 THEN 1.0 / (1.0 + exp(-(j1 - j0)))
                                   ELSE exp(j1 - j0) / (1.0 + exp(j1 - j0)) END AS p1 FROM jl{prefix}),
rep{prefix} AS (SELECT session_id, CAST(p1 > 0.5 AS INTEGER) AS {prefix}prediction,
                       CASE WHEN p1 > 0.5 THEN 'Demented' ELSE 'Non-Demented' END AS {prefix}label,
                       round(greatest(p1, 1 - p1), 6) AS {prefix}confidence, round(p1, 6) AS {prefix}prob_demented,
                       round(1 - p1, 6) AS {prefix}prob_non_demented, {len(feats)} AS {prefix}n_features FROM pp{prefix})
"""


def _nb_report(spark, sf, prep, rows, mode, prefix=""):
    feats = [c for c in FEATS if c not in MODE_DROP[mode]]
    f = C.fit_naive_bayes(rows.where(F.col("split") == "train"), feats)
    scored = f.transform(_scaled(spark, sf, prep, mode))
    return rounded(scoring.score_report(scored, KEY, len(feats), prefix), 6)


@register("x3_batch_score", BASE + _nb_sql(FEATS) + "SELECT * FROM rep")
def x3_batch_score(spark, sf):
    """Every session scored: class, label, confidence, both probabilities, feature count."""
    return _nb_report(spark, sf, *state_and_rows(spark, sf), "full")


@register("x3_stream_score", BASE + _nb_sql(FEATS) + "SELECT * FROM rep")
def x3_stream_score(spark, sf):
    """The batch score as a Structured Streaming job: session rows arrive as files (orders), join the
    static per-order aggregate, are scored with the fitted state and appended to Parquet."""
    from cohortlab.streaming.scoring import read_stream_files, run_to_parquet
    prep, p = state_and_rows(spark, sf)
    f = C.fit_naive_bayes(p.where(F.col("split") == "train"), FEATS)
    orders = read_stream_files(spark, sf, T.table(spark, sf, "orders").schema, glob="orders.parquet")
    v = T.visits_from(orders, T.order_items(spark, sf))
    aligned = scoring.align_features(v, ALIGN, KEY, dictionary=prep.dictionary, coded=prep.categorical)
    scored = f.transform(scoring.scale_and_select(aligned, prep.moments, FEATS, KEY))
    out = run_to_parquet(rounded(scoring.score_report(scored, KEY, len(FEATS)), 6), "x3_stream")
    return spark.read.parquet(out)


NO_MMSE = [c for c in FEATS if c != "disc"]


@register("x4_two_model_comparison", BASE + _nb_sql(FEATS) + _nb_sql(NO_MMSE, "sc", "b_") + """
SELECT rep.*, repb_.* EXCLUDE (session_id), CAST(NULL AS VARCHAR) AS second_error
FROM rep LEFT JOIN repb_ ON rep.session_id = repb_.session_id""")
def x4_two_model_comparison(spark, sf):
    """Full model and no-MMSE model on the same rows, side by side."""
    fitted = state_and_rows(spark, sf)
    first = _nb_report(spark, sf, *fitted, "full")
    return scoring.compare_models(first, lambda: _nb_report(spark, sf, *fitted, "no_mmse", "b_"), KEY)


VIEW = {"session_id": "session_id", "ID": "id", "price": "etiv", "disc": "nwbv", "tax": "asf", "qty": "mmse",
        "cdr": "cdr"}


@register("x5_patient_view", T.with_ctes(T.VISITS_CTE) + """
SELECT session_id, ID AS id, CAST(printf('%.4f', price) AS DOUBLE) AS etiv, CAST(printf('%.4f', disc) AS DOUBLE) AS nwbv, CAST(printf('%.4f', tax) AS DOUBLE) AS asf,
       CAST(printf('%.4f', qty) AS DOUBLE) AS mmse, CAST(printf('%.4f', cdr) AS DOUBLE) AS cdr,
       CASE WHEN cdr IS NOT NULL THEN CAST(cdr > 0 AS INTEGER) END AS ground_truth,
       CASE WHEN coalesce(cdr > 0, false) THEN 'Demented' ELSE 'Non-Demented' END AS ground_truth_label
FROM visits""")
def x5_patient_view(spark, sf):
    """Renamed clinical record with half-even display rounding and the ground truth."""
    return scoring.record_view(T.visits(spark, sf), VIEW, "cdr")


@register("p25_display_round", T.with_ctes(T.VISITS_CTE) + """
SELECT session_id, CAST(printf('%.4f', disc) AS DOUBLE) AS disc, CAST(printf('%.4f', tax) AS DOUBLE) AS tax, status FROM visits""")
def p25_display_round(spark, sf):
    """4-decimal half-even rounding, nulls and strings kept."""
    v = T.visits(spark, sf)
    return v.select("session_id", display_round("disc").alias("disc"), display_round("tax").alias("tax"), "status")


@register("p26_ground_truth", T.with_ctes(T.VISITS_CTE) + """
SELECT session_id, cdr, CASE WHEN cdr IS NOT NULL THEN CAST(cdr > 0 AS INTEGER) END AS ground_truth,
       CASE WHEN coalesce(cdr > 0, false) THEN 'Demented' ELSE 'Non-Demented' END AS ground_truth_label FROM visits""")
def p26_ground_truth(spark, sf):
    v = T.visits(spark, sf)
    truth, label = scoring.ground_truth(F.col("cdr"))
    return v.select("session_id", "cdr", truth.alias("ground_truth"), label.alias("ground_truth_label"))


@register("p27_status_map", T.with_ctes(T.VISITS_CTE) + """
SELECT session_id, CASE WHEN coalesce(cdr > 0, false) THEN 'Dementia' ELSE 'Healthy' END AS status_label FROM visits""")
def p27_status_map(spark, sf):
    v = T.visits(spark, sf).select("session_id", F.coalesce(F.col("cdr") > 0, F.lit(False)).cast("int").alias("t"))
    return v.select("session_id", scoring.status_label(F.col("t")).alias("status_label"))
