"""Registered imaging-feature queries: reports, tissue, ROI, regional, image stats, QC.

Sessions are the clinical ``visits`` (orders); volumes exist for the sessions
that have an embedding row (vec_id = session id); reports exist for orders
with lineitems. The oracle computes box indices with the diagonal inverse
(x - origin) / zoom directly, while the Spark side uses the general 3x3
adjugate, so the geometry is checked by an independent formula.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.operators import merge, region, roi, stats, tissue, volumes
from cohortlab.plans.registry import register, rounded
from cohortlab.sources import tables as T

PAT = tissue.VOLUME_PATTERN
VOXEL_VOL = 30.0 * 20.0 * 16.0
IMG = T.with_ctes(T.VISITS_CTE, T.VOXELS_CTE)
REP = T.with_ctes(T.VISITS_CTE, T.REPORTS_CTE, T.VOXELS_CTE)


def _visits_sessions(spark, sf):
    return T.visits(spark, sf).select("session_id", "price", "disc")


# ---------------------------------------------------------------------------
# reports and tissue
# ---------------------------------------------------------------------------

PARSED_SQL = f"""
, px AS (
  SELECT v.session_id, r.content,
         TRY_CAST(regexp_extract(r.content, '{PAT}', 1) AS DOUBLE) AS g1,
         TRY_CAST(regexp_extract(r.content, '{PAT}', 2) AS DOUBLE) AS g2,
         TRY_CAST(regexp_extract(r.content, '{PAT}', 3) AS DOUBLE) AS g3,
         TRY_CAST(regexp_extract(r.content, '{PAT}', 4) AS DOUBLE) AS g4
  FROM visits v LEFT JOIN reports r ON v.session_id = r.session_id
),
parsed AS (
  SELECT session_id,
         CASE WHEN content IS NULL THEN 'missing' WHEN NOT regexp_matches(content, '{PAT}') THEN 'parse_failed'
              WHEN g1 IS NULL OR g2 IS NULL OR g3 IS NULL OR g4 IS NULL THEN 'error' ELSE 'success' END AS txt_status,
         g1, g2, g3, g4
  FROM px
),
parsed2 AS (
  SELECT session_id, txt_status,
         CASE WHEN txt_status = 'success' THEN g1 END AS csf_vol_mm3,
         CASE WHEN txt_status = 'success' THEN g2 END AS gm_vol_mm3,
         CASE WHEN txt_status = 'success' THEN g3 END AS wm_vol_mm3,
         CASE WHEN txt_status = 'success' THEN g4 END AS brain_percentage
  FROM parsed
)"""


@register("s5_report_parse", REP + PARSED_SQL + "\nSELECT * FROM parsed2")
def s5_report_parse(spark, sf):
    """Parse the Volumes line of every session's segmentation report."""
    return tissue.parse_reports(_visits_sessions(spark, sf), T.reports(spark, sf))


COUNTS_SQL = f"""
, counts AS (
  SELECT session_id, count(*) FILTER (WHERE label = 1) AS csf_voxels, count(*) FILTER (WHERE label = 2) AS gm_voxels,
         count(*) FILTER (WHERE label = 3) AS wm_voxels, count(*) AS n_voxels, {VOXEL_VOL} AS voxel_vol_mm3,
         'success' AS seg_status
  FROM voxels GROUP BY session_id
)"""


@register("g14_label_counts", IMG + COUNTS_SQL + "\nSELECT * FROM counts")
def g14_label_counts(spark, sf):
    """Voxels per tissue class per volume, and the voxel volume (P16: product of zooms)."""
    return tissue.label_counts(T.slabs(spark, sf), T.meta(spark, sf))


def _tissue_tail():
    ratio = "CASE WHEN {d} > 0 THEN {n} / {d} END"
    etiv = "CASE WHEN have AND csv_etiv > 0 THEN {n} / csv_etiv END"
    return f"""
, tj AS (
  SELECT v.session_id, p.txt_status, coalesce(c.seg_status, 'missing') AS seg_status,
         (p.csf_vol_mm3 IS NULL AND coalesce(c.seg_status = 'success', false)) AS fb,
         c.csf_voxels, c.gm_voxels, c.wm_voxels, c.voxel_vol_mm3, p.csf_vol_mm3 AS tc, p.gm_vol_mm3 AS tg,
         p.wm_vol_mm3 AS tw, v.disc AS csv_nwbv, v.price AS csv_etiv
  FROM visits v LEFT JOIN parsed2 p ON v.session_id = p.session_id LEFT JOIN counts c ON v.session_id = c.session_id
),
tv AS (
  SELECT session_id, txt_status, seg_status, CASE WHEN fb THEN 'voxel_counts' ELSE 'txt_file' END AS volume_source,
         csf_voxels, gm_voxels, wm_voxels,
         CASE WHEN fb THEN csf_voxels * voxel_vol_mm3 ELSE tc END AS csf_vol_mm3,
         CASE WHEN fb THEN gm_voxels * voxel_vol_mm3 ELSE tg END AS gm_vol_mm3,
         CASE WHEN fb THEN wm_voxels * voxel_vol_mm3 ELSE tw END AS wm_vol_mm3,
         csv_nwbv, csv_etiv
  FROM tj
),
tw AS (
  SELECT *, (csf_vol_mm3 IS NOT NULL AND gm_vol_mm3 IS NOT NULL AND wm_vol_mm3 IS NOT NULL) AS have FROM tv
),
tx AS (
  SELECT *, CASE WHEN have THEN gm_vol_mm3 + wm_vol_mm3 END AS brain_parenchyma_vol_mm3,
            CASE WHEN have THEN csf_vol_mm3 + gm_vol_mm3 + wm_vol_mm3 END AS total_segmented_vol_mm3
  FROM tw
),
ty AS (
  SELECT *, {ratio.format(n='csf_vol_mm3', d='total_segmented_vol_mm3')} AS csf_frac,
            {ratio.format(n='gm_vol_mm3', d='total_segmented_vol_mm3')} AS gm_frac,
            {ratio.format(n='wm_vol_mm3', d='total_segmented_vol_mm3')} AS wm_frac,
            {ratio.format(n='brain_parenchyma_vol_mm3', d='total_segmented_vol_mm3')} AS brain_parenchyma_frac,
            {ratio.format(n='csf_vol_mm3', d='brain_parenchyma_vol_mm3')} AS csf_to_brain_ratio,
            {ratio.format(n='gm_vol_mm3', d='wm_vol_mm3')} AS gm_wm_ratio,
            {ratio.format(n='brain_parenchyma_vol_mm3', d='total_segmented_vol_mm3')} AS reconstructed_nwbv
  FROM tx
),
tissue AS (
  SELECT session_id, txt_status, seg_status, volume_source, csf_voxels, gm_voxels, wm_voxels,
         csf_vol_mm3, gm_vol_mm3, wm_vol_mm3, csv_nwbv, brain_parenchyma_vol_mm3, total_segmented_vol_mm3,
         csf_frac, gm_frac, wm_frac, brain_parenchyma_frac, csf_to_brain_ratio, gm_wm_ratio, reconstructed_nwbv,
         CASE WHEN reconstructed_nwbv IS NOT NULL AND csv_nwbv IS NOT NULL AND csv_nwbv <> 0
              THEN abs(reconstructed_nwbv - csv_nwbv) END AS reconstructed_nwbv_abs_error,
         CASE WHEN reconstructed_nwbv IS NOT NULL AND csv_nwbv IS NOT NULL AND csv_nwbv <> 0
              THEN abs(reconstructed_nwbv - csv_nwbv) / csv_nwbv * 100 END AS reconstructed_nwbv_pct_error,
         {etiv.format(n='brain_parenchyma_vol_mm3')} AS brain_parenchyma_to_etiv,
         {etiv.format(n='gm_vol_mm3')} AS gm_to_etiv, {etiv.format(n='wm_vol_mm3')} AS wm_to_etiv,
         {etiv.format(n='csf_vol_mm3')} AS csf_to_etiv,
         CASE WHEN have THEN 'success' ELSE 'failed' END AS tissue_status
  FROM ty
)"""


TISSUE_TAIL = _tissue_tail()
TISSUE_SQL = REP + PARSED_SQL + COUNTS_SQL + TISSUE_TAIL
TISSUE_DOUBLES = ["csf_vol_mm3", "gm_vol_mm3", "wm_vol_mm3", "csv_nwbv", "brain_parenchyma_vol_mm3",
                  "total_segmented_vol_mm3", "csf_frac", "gm_frac", "wm_frac", "brain_parenchyma_frac",
                  "csf_to_brain_ratio", "gm_wm_ratio", "reconstructed_nwbv", "reconstructed_nwbv_abs_error",
                  "reconstructed_nwbv_pct_error", "brain_parenchyma_to_etiv", "gm_to_etiv", "wm_to_etiv", "csf_to_etiv"]


def _tissue(spark, sf):
    s = _visits_sessions(spark, sf)
    parsed = tissue.parse_reports(s, T.reports(spark, sf))
    counts = tissue.label_counts(T.slabs(spark, sf), T.meta(spark, sf))
    return tissue.tissue_features(s, parsed, counts, nwbv="disc", etiv="price")


def _tissue_select(cols, digits=9):
    return TISSUE_SQL + "\nSELECT session_id, " + ", ".join(
        f"round({c}, {digits}) AS {c}" if c in TISSUE_DOUBLES else c for c in cols) + " FROM tissue"


ALL_TISSUE = ["txt_status", "seg_status", "volume_source", "csf_voxels", "gm_voxels", "wm_voxels"] + TISSUE_DOUBLES \
    + ["tissue_status"]


def _tissue_query(name, cols, doc):
    def fn(spark, sf):
        return rounded(_tissue(spark, sf).select("session_id", *cols), 9)
    fn.__doc__ = doc
    fn.__name__ = name
    register(name, _tissue_select(cols))(fn)


_tissue_query("i4_tissue_features", ALL_TISSUE, "All tissue features of every clinical session.")
_tissue_query("p10_tissue_totals", ["brain_parenchyma_vol_mm3", "total_segmented_vol_mm3"], "parenchyma, total")
_tissue_query("p11_tissue_fractions", ["csf_frac", "gm_frac", "wm_frac", "brain_parenchyma_frac"], "fractions")
_tissue_query("p12_tissue_ratios", ["csf_to_brain_ratio", "gm_wm_ratio"], "ratios")
_tissue_query("p13_reconstruction_error", ["reconstructed_nwbv", "csv_nwbv", "reconstructed_nwbv_abs_error",
                                           "reconstructed_nwbv_pct_error"], "reconstructed fraction and error")
_tissue_query("p14_etiv_normalised", ["brain_parenchyma_to_etiv", "gm_to_etiv", "wm_to_etiv", "csf_to_etiv"],
              "volumes over the reference volume")
_tissue_query("p15_volume_source", ["volume_source", "csf_vol_mm3", "gm_vol_mm3", "wm_vol_mm3"],
              "report volume, else voxel count x voxel volume")


@register("g9_error_stats", TISSUE_SQL + """
, e AS (SELECT reconstructed_nwbv_abs_error AS v FROM tissue WHERE reconstructed_nwbv_abs_error IS NOT NULL)
SELECT count(*) AS n_validated, round(avg(v), 9) AS mean_abs_error, round(median(v), 9) AS median_abs_error,
       round(max(v), 9) AS max_abs_error, count(*) FILTER (WHERE v < 0.01) AS error_lt_0_01,
       count(*) FILTER (WHERE v < 0.05) AS error_lt_0_05, bool_and(v < 0.01) AS all_lt_0_01 FROM e""")
def g9_error_stats(spark, sf):
    return rounded(stats.error_stats(_tissue(spark, sf), "reconstructed_nwbv_abs_error"), 9)


@register("g10_fraction_sum", TISSUE_SQL + """
, s AS (SELECT coalesce(csf_frac, 0.0) + coalesce(gm_frac, 0.0) + coalesce(wm_frac, 0.0) AS s FROM tissue)
SELECT round(avg(s), 9) AS fraction_sum_mean, round(stddev_samp(s), 9) AS fraction_sum_std,
       count(*) FILTER (WHERE s > 0.99 AND s < 1.01) AS fraction_sum_ok FROM s""")
def g10_fraction_sum(spark, sf):
    return rounded(stats.fraction_sum_check(_tissue(spark, sf), ["csf_frac", "gm_frac", "wm_frac"]), 9)


@register("g11_tissue_outcomes", TISSUE_SQL + """
SELECT count(*) AS total_sessions, count(*) FILTER (WHERE txt_status = 'success') AS successful_extractions,
       count(*) FILTER (WHERE txt_status = 'partial') AS partial_extractions,
       count(*) FILTER (WHERE txt_status IS DISTINCT FROM 'success') AS failed_extractions FROM tissue""")
def g11_tissue_outcomes(spark, sf):
    """Tissue style: every non-success report counts as failed."""
    return stats.outcome_counts(_tissue(spark, sf), "txt_status", kind="tissue")


# ---------------------------------------------------------------------------
# ROI boxes and regional features
# ---------------------------------------------------------------------------

def _atlas_values():
    rows = [f"('{r}', '{s}', {float(x[0])}, {float(x[1])}, {float(y[0])}, {float(y[1])}, {float(z[0])}, "
            f"{float(z[1])}, {roi.TARGET_LABEL[r]})" for r, s, x, y, z in roi.ATLAS_MM]
    return "(VALUES " + ", ".join(rows) + ") a(region, side, x0, x1, y0, y1, z0, z1, target_label)"


def _idx(expr):
    return f"CAST(least(greatest(round_even({expr}, 0), 0), 3) AS INTEGER)"


BOXES_SQL = f"""
, bx AS (
  SELECT g.session_id, a.region, a.side, a.target_label,
         {_idx('(a.x0 - g.ox) / g.sx')} AS ia, {_idx('(a.x1 - g.ox) / g.sx')} AS ib,
         {_idx('(a.y0 - g.oy) / g.sy')} AS ja, {_idx('(a.y1 - g.oy) / g.sy')} AS jb,
         {_idx('(a.z0 - g.oz) / g.sz')} AS ka, {_idx('(a.z1 - g.oz) / g.sz')} AS kb
  FROM geom g CROSS JOIN {_atlas_values()}
),
boxes AS (
  SELECT session_id, region, side, target_label, least(ia, ib) AS i0, least(ja, jb) AS j0, least(ka, kb) AS k0,
         greatest(ia, ib) AS i1, greatest(ja, jb) AS j1, greatest(ka, kb) AS k1, {VOXEL_VOL} AS voxel_vol_mm3
  FROM bx
),
rc AS (
  SELECT b.session_id, b.region, b.side, b.target_label, count(v.label) AS total,
         count(*) FILTER (WHERE v.label = 0) AS c0, count(*) FILTER (WHERE v.label = 1) AS c1,
         count(*) FILTER (WHERE v.label = 2) AS c2, count(*) FILTER (WHERE v.label = 3) AS c3
  FROM boxes b LEFT JOIN voxels v ON v.session_id = b.session_id AND v.i BETWEEN b.i0 AND b.i1
       AND v.j BETWEEN b.j0 AND b.j1 AND v.k BETWEEN b.k0 AND b.k1
  GROUP BY b.session_id, b.region, b.side, b.target_label
),
roistats AS (
  SELECT session_id, region, side, target_label,
         CASE target_label WHEN 1 THEN c1 WHEN 2 THEN c2 WHEN 3 THEN c3 ELSE c0 END AS voxels,
         CASE target_label WHEN 1 THEN c1 WHEN 2 THEN c2 WHEN 3 THEN c3 ELSE c0 END * {VOXEL_VOL} AS volume_mm3,
         CASE WHEN total > 0 THEN CASE target_label WHEN 1 THEN c1 WHEN 2 THEN c2 WHEN 3 THEN c3 ELSE c0 END / total
              ELSE 0.0 END AS tissue_fraction,
         total AS total_voxels, c1 AS csf_voxels, c2 AS gm_voxels, c3 AS wm_voxels, c0 AS background_voxels
  FROM rc
)"""


@register("i2_roi_boxes", IMG + BOXES_SQL + "\nSELECT session_id, region, side, target_label, i0, j0, k0, i1, j1, k1, "
          "voxel_vol_mm3 FROM boxes")
def i2_roi_boxes(spark, sf):
    """mm boxes → clamped voxel index boxes per session (I1 inverse affine + I2)."""
    return roi.roi_boxes(T.meta(spark, sf))


@register("g15_roi_stats", IMG + BOXES_SQL + "\nSELECT session_id, region, side, target_label, voxels, "
          "volume_mm3, round(tissue_fraction, 9) AS tissue_fraction, total_voxels, csf_voxels, gm_voxels, "
          "wm_voxels, background_voxels FROM roistats")
def g15_roi_stats(spark, sf):
    """J11 range join of slabs and boxes, then tissue counts per box."""
    out = roi.roi_tissue_stats(T.slabs(spark, sf), roi.roi_boxes(T.meta(spark, sf)))
    return rounded(out, 9)


KEYS = [f"{r}_{s}" for r in roi.REGIONS for s in roi.SIDES]
PIV_MEASURES = list(roi.WIDE_MEASURES)


def _wide_sql():
    cols = []
    for r in roi.REGIONS:
        for s in roi.SIDES:
            for m in PIV_MEASURES:
                cols.append(f"max(CASE WHEN region = '{r}' AND side = '{s}' THEN {m} END) AS {r}_{s}_{m}")
    return ", wide AS (SELECT session_id, " + ",\n ".join(cols) + " FROM roistats GROUP BY session_id)"


@register("g16_region_pivot", IMG + BOXES_SQL + _wide_sql() + "\nSELECT * FROM wide")
def g16_region_pivot(spark, sf):
    stats_ = roi.roi_tissue_stats(T.slabs(spark, sf), roi.roi_boxes(T.meta(spark, sf)))
    return roi.pivot_regions(stats_)


def _regional_tail():
    feats = []
    for r in roi.REGIONS:
        lv, rv = f"{r}_left_volume_mm3", f"{r}_right_volume_mm3"
        for s in roi.SIDES:
            for m in PIV_MEASURES:
                feats.append(f"{r}_{s}_{m}")
        feats += [f"{lv} + {rv} AS {r}_bilateral_volume_mm3",
                  f"CASE WHEN {lv} + {rv} IS NULL THEN NULL WHEN {lv} + {rv} > 0 THEN ({lv} - {rv}) / ({lv} + {rv}) "
                  f"ELSE 0.0 END AS {r}_asymmetry_index",
                  f"CASE WHEN {lv} IS NOT NULL AND {rv} > 0 THEN {lv} / {rv} END AS {r}_laterality_ratio",
                  f"CASE WHEN {lv} IS NOT NULL AND {rv} IS NOT NULL THEN 'success' WHEN {lv} IS NOT NULL OR {rv} "
                  f"IS NOT NULL THEN 'partial' ELSE 'failed' END AS {r}_status"]
    t = ["entorhinal_bilateral_volume_mm3", "inferior_temporal_bilateral_volume_mm3",
         "middle_temporal_bilateral_volume_mm3"]
    any_t = " OR ".join(f"{c} IS NOT NULL" for c in t)
    sum_t = " + ".join(f"coalesce({c}, 0.0)" for c in t)
    etiv = []
    for r, sides in region.ETIV_RATIOS:
        for s in sides:
            etiv.append(f"CASE WHEN {r}_bilateral_volume_mm3 IS NOT NULL AND v.price > 0 "
                        f"THEN {r}_{s}_volume_mm3 / v.price END AS {r}_{s}_to_etiv")
    return f"""
, f1 AS (SELECT session_id, {', '.join(feats)} FROM wide),
f2 AS (SELECT *, CASE WHEN {any_t} THEN {sum_t} END AS total_temporal_lobe_volume_mm3 FROM f1),
f3 AS (SELECT *, CASE WHEN hippocampus_bilateral_volume_mm3 IS NOT NULL AND total_temporal_lobe_volume_mm3 > 0
                      THEN hippocampus_bilateral_volume_mm3 / total_temporal_lobe_volume_mm3 END
                   AS hippocampus_to_temporal_ratio,
              CASE WHEN hippocampus_status = 'success' AND ventricle_status = 'success' THEN 'success'
                   WHEN hippocampus_status IN ('success', 'partial') OR ventricle_status IN ('success', 'partial')
                   THEN 'partial' ELSE 'failed' END AS st
       FROM f2),
regional AS (
  SELECT v.session_id, f3.* EXCLUDE (session_id, st), coalesce(f3.st, 'missing_image') AS regional_extraction_status,
         {', '.join(etiv)},
         CASE WHEN v.price > 0 THEN total_temporal_lobe_volume_mm3 / v.price END AS total_temporal_to_etiv
  FROM visits v LEFT JOIN f3 ON v.session_id = f3.session_id
)"""


REGIONAL_TAIL = _regional_tail()
REGIONAL_SQL = IMG + BOXES_SQL + _wide_sql() + REGIONAL_TAIL
BOTH_SQL = REP + PARSED_SQL + COUNTS_SQL + TISSUE_TAIL + BOXES_SQL + _wide_sql() + REGIONAL_TAIL


def _regional(spark, sf):
    return region.regional_features(_visits_sessions(spark, sf), T.slabs(spark, sf), T.meta(spark, sf), etiv="price")


def _regional_query(name, cols, doc):
    def fn(spark, sf):
        df = _regional(spark, sf)
        return df.select("session_id", *cols) if cols else df
    fn.__doc__ = doc
    fn.__name__ = name
    sel = ("SELECT session_id, " + ", ".join(cols) + " FROM regional") if cols else "SELECT * FROM regional"
    register(name, REGIONAL_SQL + "\n" + sel)(fn)


_regional_query("i3_regional_features", None, "All regional features of every clinical session, one slab pass.")
_regional_query("p17_bilateral_sum", [f"{r}_bilateral_volume_mm3" for r in roi.REGIONS], "left + right")
_regional_query("p18_asymmetry_index", [f"{r}_asymmetry_index" for r in roi.REGIONS], "(L-R)/(L+R), 0 on zero sum")
_regional_query("p19_laterality_ratio", [f"{r}_laterality_ratio" for r in roi.REGIONS], "L/R, null when R = 0")
_regional_query("p20_region_etiv_ratios", [f"{r}_{s}_to_etiv" for r, ss in region.ETIV_RATIOS for s in ss]
                + ["total_temporal_to_etiv"], "region volumes over eTIV")
_regional_query("p21_composite_temporal", ["total_temporal_lobe_volume_mm3", "hippocampus_to_temporal_ratio"],
                "sum of non-null temporal regions, hippocampus share")
_regional_query("p22_extraction_status", ["regional_extraction_status"], "success / partial / failed / missing_image")
_regional_query("p23_bilateral_status", [f"{r}_status" for r in roi.REGIONS], "per-region side completeness")


@register("g8_asymmetry_stats", REGIONAL_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{r}_asymmetry_index' AS measure, count({r}_asymmetry_index) AS n, "
    f"round(avg({r}_asymmetry_index), 9) AS mean, round(stddev_samp({r}_asymmetry_index), 9) AS std, "
    f"round(avg(abs({r}_asymmetry_index)), 9) AS abs_mean FROM regional" for r in roi.REGIONS))
def g8_asymmetry_stats(spark, sf):
    return rounded(stats.asymmetry_stats(_regional(spark, sf), [f"{r}_asymmetry_index" for r in roi.REGIONS]), 9)


@register("g7_region_volume_stats", REGIONAL_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS measure, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(min({c}), 6) AS min, round(max({c}), 6) AS max, "
    f"round(CASE WHEN avg({c}) > 0 THEN stddev_samp({c}) / avg({c}) ELSE 0.0 END, 9) AS cv FROM regional"
    for c in ("hippocampus_bilateral_volume_mm3", "ventricle_bilateral_volume_mm3")))
def g7_region_volume_stats(spark, sf):
    """Hippocampus and ventricle volume summaries with coefficient of variation."""
    out = stats.global_stats(_regional(spark, sf), ["hippocampus_bilateral_volume_mm3", "ventricle_bilateral_volume_mm3"])
    return out.select("measure", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "max")],
                      F.round("cv", 9).alias("cv"))


@register("g11_regional_outcomes", REGIONAL_SQL + """
SELECT count(*) AS total_sessions, count(*) FILTER (WHERE regional_extraction_status = 'success') AS successful_extractions,
       count(*) FILTER (WHERE regional_extraction_status = 'partial') AS partial_extractions,
       count(*) FILTER (WHERE regional_extraction_status = 'failed') AS failed_extractions FROM regional""")
def g11_regional_outcomes(spark, sf):
    """Regional style: only 'failed' counts as failed (missing_image is in neither)."""
    return stats.outcome_counts(_regional(spark, sf), "regional_extraction_status", kind="regional")


@register("j5_feature_join", BOTH_SQL + """
SELECT t.session_id, t.tissue_status, round(t.gm_vol_mm3, 9) AS gm_vol_mm3, r.regional_extraction_status,
       r.hippocampus_bilateral_volume_mm3
FROM tissue t JOIN regional r ON t.session_id = r.session_id""")
def j5_feature_join(spark, sf):
    """tissue ⋈ regional on the session key (inner)."""
    t = rounded(_tissue(spark, sf).select("session_id", "tissue_status", "gm_vol_mm3"), 9)
    r = _regional(spark, sf).select("session_id", "regional_extraction_status", "hippocampus_bilateral_volume_mm3")
    return merge.inner_join(t, r, "session_id")


# ---------------------------------------------------------------------------
# image statistics, slices, QC
# ---------------------------------------------------------------------------

@register("g17_foreground_stats", IMG + """
, fg AS (SELECT session_id, min(value) AS mn, max(value) AS mx, avg(value) AS mean, stddev_pop(value) AS sd,
                quantile_cont(value, [0.5, 0.01, 0.99]) AS q, count(*) AS n
         FROM voxels WHERE value > 0 GROUP BY session_id)
SELECT v.session_id, round(coalesce(mn, 0.0), 9) AS min, round(coalesce(mx, 0.0), 9) AS max,
       round(coalesce(mean, 0.0), 9) AS mean, round(coalesce(sd, 0.0), 9) AS std,
       round(coalesce(q[1], 0.0), 9) AS median, round(coalesce(q[2], 0.0), 9) AS p01,
       round(coalesce(q[3], 0.0), 9) AS p99, coalesce(n, 0) AS nonzero_voxels
FROM (SELECT DISTINCT session_id FROM visits) v LEFT JOIN fg ON v.session_id = fg.session_id""")
def g17_foreground_stats(spark, sf):
    """Foreground (> 0) intensity statistics of every session; zeros when there is none."""
    return rounded(volumes.foreground_stats(T.visits(spark, sf), T.slabs(spark, sf)), 9)


@register("g18_image_stats", IMG + f"""
, st AS (SELECT session_id, min(value) AS mn, max(value) AS mx, avg(value) AS mean, stddev_pop(value) AS sd,
                count(*) AS n FROM voxels GROUP BY session_id)
SELECT e.vec_id AS session_id, [4, 4, 4] AS shape, [30.0, 20.0, 16.0] AS zooms, 'float64' AS dtype,
       round(mn, 9) AS min, round(mx, 9) AS max, round(mean, 9) AS mean, round(sd, 9) AS std, n AS n_voxels,
       CASE WHEN n IS NULL THEN 'failed' ELSE 'success' END AS status
FROM embeddings e LEFT JOIN st ON e.vec_id = st.session_id""")
def g18_image_stats(spark, sf):
    return rounded(volumes.image_stats(T.slabs(spark, sf), T.meta(spark, sf)), 9)


@register("w6_mid_slices", IMG + """
SELECT session_id, 'axial' AS plane, i AS u, j AS v, label AS value FROM voxels WHERE k = 2
UNION ALL SELECT session_id, 'coronal', i, k, label FROM voxels WHERE j = 2
UNION ALL SELECT session_id, 'sagittal', j, k, label FROM voxels WHERE i = 2""")
def w6_mid_slices(spark, sf):
    """The three planes through the centre of every label volume."""
    return volumes.mid_slices(T.slabs(spark, sf), T.meta(spark, sf))


QC_SQL = IMG + "," + T.IMAGE_STATUS_CTE + """
, fg AS (SELECT session_id, min(value) AS mn, max(value) AS mx, avg(value) AS mean, stddev_pop(value) AS sd,
                quantile_cont(value, [0.5, 0.01, 0.99]) AS q, count(*) AS n
         FROM voxels WHERE value > 0 GROUP BY session_id),
qc AS (
  SELECT v.session_id, coalesce(i.status, 'missing') AS seg_status,
         CASE WHEN i.status = 'success' THEN coalesce(mn, 0.0) END AS seg_min,
         CASE WHEN i.status = 'success' THEN coalesce(mx, 0.0) END AS seg_max,
         CASE WHEN i.status = 'success' THEN coalesce(mean, 0.0) END AS seg_mean,
         CASE WHEN i.status = 'success' THEN coalesce(sd, 0.0) END AS seg_std,
         CASE WHEN i.status = 'success' THEN coalesce(q[1], 0.0) END AS seg_median,
         CASE WHEN i.status = 'success' THEN coalesce(q[2], 0.0) END AS seg_p01,
         CASE WHEN i.status = 'success' THEN coalesce(q[3], 0.0) END AS seg_p99,
         CASE WHEN i.status = 'success' THEN coalesce(n, 0) END AS seg_nonzero_voxels,
         CASE WHEN i.status = 'success' THEN [4, 4, 4] END AS seg_shape,
         CASE WHEN i.status = 'success' THEN [30.0, 20.0, 16.0] END AS seg_voxel_dims,
         i.error AS seg_error, coalesce(i.status, 'missing') NOT IN ('failed', 'error') AS qc_pass,
         CASE WHEN i.status IS NULL THEN ['seg file missing'] WHEN i.error IS NOT NULL THEN ['seg: ' || i.error] ELSE [] END AS errors
  FROM (SELECT DISTINCT session_id FROM visits) v LEFT JOIN image_status i ON v.session_id = i.session_id
       LEFT JOIN fg ON v.session_id = fg.session_id
)"""


def _qc(spark, sf):
    return volumes.session_qc(T.visits(spark, sf), {"seg": (T.slabs(spark, sf), "values", T.image_status(spark, sf))})


@register("i5_session_qc", QC_SQL + "\nSELECT session_id, seg_status, " + ", ".join(
    f"round(seg_{c}, 9) AS seg_{c}" for c in volumes.FOREGROUND_STATS)
    + ", seg_nonzero_voxels, seg_shape, seg_voxel_dims, seg_error, qc_pass, errors FROM qc")
def i5_session_qc(spark, sf):
    """Per session: image status (good, missing, blank, truncated), foreground stats, geometry, qc_pass (missing does
    not fail) and errors."""
    return rounded(_qc(spark, sf), 9)


@register("s14_qc_summary", QC_SQL + """
SELECT count(*) AS total_sessions, count(*) FILTER (WHERE qc_pass) AS qc_pass,
       count(*) FILTER (WHERE NOT qc_pass) AS qc_fail FROM qc""")
def s14_qc_summary(spark, sf):
    return volumes.qc_summary(_qc(spark, sf))
