"""Regional features from the ROI pivot: bilateral sums, asymmetry, ratios, status.

Input: the wide ROI table of :func:`cohortlab.operators.roi.pivot_regions`,
the session list (every clinical session gets a row) and an eTIV column.
Output: one fixed schema; sessions without an image get nulls and status
``missing_image`` instead of absent keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.columns import asymmetry_index, bilateral, laterality_ratio, q, ratio_if_positive
from cohortlab.operators.roi import REGIONS, pivot_regions, roi_boxes, roi_tissue_stats

TEMPORAL = ("entorhinal", "inferior_temporal", "middle_temporal")
# Regions and sides normalised by eTIV.
ETIV_RATIOS = (("hippocampus", ("bilateral", "left", "right")), ("ventricle", ("bilateral", "left", "right")),
               ("entorhinal", ("bilateral",)))


def bilateral_status(left, right):
    """Success with both sides, partial with one, failed with none."""
    return (F.when(left.isNotNull() & right.isNotNull(), "success")
            .when(left.isNotNull() | right.isNotNull(), "partial").otherwise("failed"))


def derive_regional(wide: DataFrame) -> DataFrame:
    """P17-P19, P21, P23 on the wide ROI table (before the eTIV join)."""
    cols = [F.col("session_id")]
    for r in REGIONS:
        lv, rv = F.col(f"{r}_left_volume_mm3"), F.col(f"{r}_right_volume_mm3")
        for side in ("left", "right"):
            for m in ("volume_mm3", "voxels", "tissue_fraction", "gm_voxels", "wm_voxels", "csf_voxels"):
                cols.append(F.col(f"{r}_{side}_{m}"))
        cols += [bilateral(lv, rv).alias(f"{r}_bilateral_volume_mm3"),
                 asymmetry_index(lv, rv).alias(f"{r}_asymmetry_index"),
                 laterality_ratio(lv, rv).alias(f"{r}_laterality_ratio"),
                 bilateral_status(lv, rv).alias(f"{r}_status")]
    out = wide.select(cols)
    parts = [F.col(f"{r}_bilateral_volume_mm3") for r in TEMPORAL]
    any_part = F.lit(False)
    for p in parts:
        any_part = any_part | p.isNotNull()
    total = F.when(any_part, sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0)))
    out = out.withColumn("total_temporal_lobe_volume_mm3", total)
    out = out.withColumn("hippocampus_to_temporal_ratio",
                         F.when(F.col("hippocampus_bilateral_volume_mm3").isNotNull(),
                                ratio_if_positive("hippocampus_bilateral_volume_mm3", "total_temporal_lobe_volume_mm3")))
    hs, vs = F.col("hippocampus_status"), F.col("ventricle_status")
    status = (F.when((hs == "success") & (vs == "success"), "success")
              .when(hs.isin("success", "partial") | vs.isin("success", "partial"), "partial").otherwise("failed"))
    return out.withColumn("regional_extraction_status", status)


def regional_features(sessions: DataFrame, slabs: DataFrame, meta: DataFrame, etiv: str = "etiv",
                      key: str = "session_id") -> DataFrame:
    """All regions in ONE pass over the slabs, then P20 eTIV ratios and P22/P24 statuses.

    ``sessions`` carries the session key and the eTIV column; sessions with no
    volume get status ``missing_image`` and null features.
    """
    decoded = meta.where(F.col("status") == "success") if "status" in meta.columns else meta
    stats = roi_tissue_stats(slabs, roi_boxes(decoded))
    feats = derive_regional(pivot_regions(stats))
    s = sessions.select(F.col(q(key)).alias("session_id"), F.col(q(etiv)).cast("double").alias("__etiv"))
    j = s.join(feats, "session_id", "left")
    status = F.when(F.col("regional_extraction_status").isNotNull(), F.col("regional_extraction_status"))
    if "status" in meta.columns:  # a volume that failed to decode is an 'error', not a missing image
        failed = meta.where(F.col("status") == "error").select("session_id", F.lit(True).alias("__err")).distinct()
        j = j.join(failed, "session_id", "left")
        status = status.when(F.col("__err"), F.lit("error"))
    j = j.withColumn("regional_extraction_status", status.otherwise(F.lit("missing_image")))
    j = j.drop("__err") if "__err" in j.columns else j
    e = F.col("__etiv")
    for r, sides in ETIV_RATIOS:
        for side in sides:
            src = f"{r}_{side}_volume_mm3"
            j = j.withColumn(f"{r}_{side}_to_etiv",
                             F.when(F.col(f"{r}_bilateral_volume_mm3").isNotNull(), ratio_if_positive(src, e)))
    # Extension: the reference never emits this one (it normalises before the composite exists).
    j = j.withColumn("total_temporal_to_etiv", ratio_if_positive("total_temporal_lobe_volume_mm3", e))
    return j.drop("__etiv")
