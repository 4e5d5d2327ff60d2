"""Tissue composition features.

Reports are parsed with ``regexp_extract`` + ``try_cast``; label counts come
from the slab arrays with one partial/final aggregation per session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.columns import product, q, ratio_if_positive

# Fixed value: the "Volumes:" line of a segmentation report (CSF, GM, WM, brain fraction).
VOLUME_PATTERN = r"Volumes:\s+([\d.]+)\s+([\d.]+)\s+([\d.]+)\s+([\d.]+)"
# Label convention of the segmentation images: (csf, gm, wm). The pipeline
# uses 1/2/3 with 0 as background; the library variant used 0/1/2.
PIPELINE_LABELS = (1, 2, 3)
LIBRARY_LABELS = (0, 1, 2)


def parse_reports(sessions: DataFrame, reports: DataFrame, key: str = "session_id",
                  content: str = "content") -> DataFrame:
    """(session_id, txt_status, csf_vol_mm3, gm_vol_mm3, wm_vol_mm3, brain_percentage).

    status: ``missing`` (no report), ``parse_failed`` (no Volumes line),
    ``error`` (a captured number does not parse), ``success``.
    """
    r = reports.select(F.col(q(key)).alias("session_id"), F.col(q(content)).alias("__c"))
    j = sessions.select(F.col(q(key)).alias("session_id")).join(r, "session_id", "left")
    c = F.col("__c")
    groups = [F.regexp_extract(c, VOLUME_PATTERN, g).try_cast("double") for g in (1, 2, 3, 4)]
    matched = c.rlike(VOLUME_PATTERN)
    ok = groups[0].isNotNull() & groups[1].isNotNull() & groups[2].isNotNull() & groups[3].isNotNull()
    status = (F.when(c.isNull(), "missing").when(~matched, "parse_failed").when(~ok, "error").otherwise("success"))
    good = F.col("txt_status") == "success"
    out = j.select("session_id", status.alias("txt_status"), *[g.alias(f"__g{i}") for i, g in enumerate(groups)])
    names = ("csf_vol_mm3", "gm_vol_mm3", "wm_vol_mm3", "brain_percentage")
    return out.select("session_id", "txt_status",
                      *[F.when(good, F.col(f"__g{i}")).alias(n) for i, n in enumerate(names)])


def label_counts(slabs: DataFrame, meta: DataFrame, labels=PIPELINE_LABELS) -> DataFrame:
    """Voxels per tissue class per session plus the voxel volume (product of zooms)."""
    csf, gm, wm = labels

    def cnt(v):
        return F.size(F.filter("labels", lambda x: x == v))

    per = slabs.groupBy("session_id").agg(
        F.sum(cnt(csf)).cast("long").alias("csf_voxels"), F.sum(cnt(gm)).cast("long").alias("gm_voxels"),
        F.sum(cnt(wm)).cast("long").alias("wm_voxels"),
        F.sum(F.size("labels")).cast("long").alias("n_voxels"))
    m = meta.select("session_id", product("zooms").alias("voxel_vol_mm3"))
    return per.join(m, "session_id", "inner").withColumn("seg_status", F.lit("success"))


def tissue_features(sessions: DataFrame, parsed: DataFrame, counts: DataFrame, nwbv: str | None = None,
                    etiv: str | None = None, key: str = "session_id", skip_zero_nwbv: bool = True,
                    fallback: bool = True) -> DataFrame:
    """I4 = P10-P16 over report volumes with a voxel-count fallback.

    ``sessions`` holds the key and the recorded nWBV / eTIV columns (optional).
    Volume source: the report; else voxel count x voxel volume when the image
    was read (``fallback=False`` is the pipeline variant: reports only); the
    tag reads ``txt_file`` whenever the fallback was not used.
    """
    s = sessions.select(F.col(q(key)).alias("session_id"),
                        (F.col(q(nwbv)).cast("double") if nwbv else F.lit(None).cast("double")).alias("csv_nwbv"),
                        (F.col(q(etiv)).cast("double") if etiv else F.lit(None).cast("double")).alias("csv_etiv"))
    j = (s.join(parsed.drop("brain_percentage"), "session_id", "left")
          .join(counts.select("session_id", "csf_voxels", "gm_voxels", "wm_voxels", "voxel_vol_mm3", "seg_status"),
                "session_id", "left"))
    seg_ok = F.col("seg_status") == "success"
    fallback = F.col("csf_vol_mm3").isNull() & F.coalesce(seg_ok, F.lit(False)) & F.lit(fallback)
    vv = F.col("voxel_vol_mm3")

    def vol(name: str, voxels: str) -> Column:
        return F.when(fallback, F.col(voxels) * vv).otherwise(F.col(name))

    j = j.select("session_id", "txt_status", F.coalesce("seg_status", F.lit("missing")).alias("seg_status"),
                 F.when(fallback, "voxel_counts").otherwise("txt_file").alias("volume_source"),
                 "csf_voxels", "gm_voxels", "wm_voxels",
                 vol("csf_vol_mm3", "csf_voxels").alias("csf_vol_mm3"),
                 vol("gm_vol_mm3", "gm_voxels").alias("gm_vol_mm3"),
                 vol("wm_vol_mm3", "wm_voxels").alias("wm_vol_mm3"),
                 "csv_nwbv", "csv_etiv")
    csf, gm, wm = F.col("csf_vol_mm3"), F.col("gm_vol_mm3"), F.col("wm_vol_mm3")
    have = csf.isNotNull() & gm.isNotNull() & wm.isNotNull()
    par = F.when(have, gm + wm)
    tot = F.when(have, csf + gm + wm)
    j = j.withColumn("brain_parenchyma_vol_mm3", par).withColumn("total_segmented_vol_mm3", tot)
    P, T = F.col("brain_parenchyma_vol_mm3"), F.col("total_segmented_vol_mm3")
    j = j.select(
        "*",
        ratio_if_positive(csf, T).alias("csf_frac"), ratio_if_positive(gm, T).alias("gm_frac"),
        ratio_if_positive(wm, T).alias("wm_frac"), ratio_if_positive(P, T).alias("brain_parenchyma_frac"),
        ratio_if_positive(csf, P).alias("csf_to_brain_ratio"), ratio_if_positive(gm, wm).alias("gm_wm_ratio"),
        ratio_if_positive(P, T).alias("reconstructed_nwbv"))
    rec, rn = F.col("reconstructed_nwbv"), F.col("csv_nwbv")
    usable = rec.isNotNull() & rn.isNotNull() & ((rn != 0) if skip_zero_nwbv else F.lit(True))
    err = F.when(usable, F.abs(rec - rn))
    j = j.withColumn("reconstructed_nwbv_abs_error", err)
    j = j.withColumn("reconstructed_nwbv_pct_error",
                     F.when(usable, F.try_divide(F.col("reconstructed_nwbv_abs_error"), rn) * 100))
    e = F.col("csv_etiv")
    for name, c in (("brain_parenchyma_to_etiv", P), ("gm_to_etiv", gm), ("wm_to_etiv", wm), ("csf_to_etiv", csf)):
        j = j.withColumn(name, F.when(have, ratio_if_positive(c, e)))
    tissue_status = F.when(F.col("volume_source").isNotNull() & have, "success").otherwise("failed")
    return j.withColumn("tissue_status", tissue_status).drop("csv_etiv")
