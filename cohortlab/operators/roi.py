"""Region-of-interest geometry and tissue counts inside boxes.

Volumes are stored as *slab rows* ``(session_id, k, ni, nj, labels)``: one
row per axial plane, ``labels`` in i-major, j-minor order. A box is exploded
over its k range, so the range join becomes an equi-join on
``(session_id, k)`` — at most one slab and a handful of boxes per key, hence
no hot key however large one session is — with the i/j window evaluated on
the slab array by a higher-order ``filter``. Voxels are never exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.functions.columns import product

# ROI boxes in Talairach/MNI millimetres (x range, y range, z range).
ATLAS_MM = (
    ("hippocampus", "left", (-35, -20), (-40, -10), (-20, -5)),
    ("hippocampus", "right", (20, 35), (-40, -10), (-20, -5)),
    ("ventricle", "left", (-35, -2), (-60, 20), (-5, 30)),
    ("ventricle", "right", (2, 35), (-60, 20), (-5, 30)),
    ("entorhinal", "left", (-30, -15), (-15, 5), (-35, -15)),
    ("entorhinal", "right", (15, 30), (-15, 5), (-35, -15)),
    ("inferior_temporal", "left", (-55, -30), (-60, -5), (-35, -10)),
    ("inferior_temporal", "right", (30, 55), (-60, -5), (-35, -10)),
    ("middle_temporal", "left", (-65, -40), (-60, 0), (-15, 10)),
    ("middle_temporal", "right", (40, 65), (-60, 0), (-15, 10)),
)
# Tissue counted per region (1 = CSF, 2 = GM, 3 = WM).
TARGET_LABEL = {"hippocampus": 2, "ventricle": 1, "entorhinal": 2, "inferior_temporal": 2, "middle_temporal": 2}
REGIONS = ("hippocampus", "ventricle", "entorhinal", "inferior_temporal", "middle_temporal")
SIDES = ("left", "right")
CSF, GM, WM = 1, 2, 3


def atlas(spark: SparkSession, target_label: dict | None = None) -> DataFrame:
    """The constant ROI table (10 rows)."""
    tl = target_label or TARGET_LABEL
    rows = [(r, s, float(x[0]), float(x[1]), float(y[0]), float(y[1]), float(z[0]), float(z[1]), tl[r])
            for r, s, x, y, z in ATLAS_MM]
    return spark.createDataFrame(rows, "region string, side string, x0 double, x1 double, y0 double, y1 double, "
                                       "z0 double, z1 double, target_label int")


def _a(i: int) -> Column:
    return F.col("affine")[i].cast("double")


def mm_to_index(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Inverse affine (closed-form 3x3 adjugate) applied to a mm point.

    Needs an ``affine`` column (16 doubles, row-major) and ``dims`` in scope.
    Result: half-even rounded indices clamped to [0, dim - 1].
    """
    a, b, c, tx = _a(0), _a(1), _a(2), _a(3)
    d, e, f, ty = _a(4), _a(5), _a(6), _a(7)
    g, h, i, tz = _a(8), _a(9), _a(10), _a(11)
    det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    px, py, pz = x - tx, y - ty, z - tz
    vi = ((e * i - f * h) * px - (b * i - c * h) * py + (b * f - c * e) * pz) / det
    vj = (-(d * i - f * g) * px + (a * i - c * g) * py - (a * f - c * d) * pz) / det
    vk = ((d * h - e * g) * px - (a * h - b * g) * py + (a * e - b * d) * pz) / det

    def clamp(v: Column, axis: int) -> Column:
        return F.least(F.greatest(F.rint(v), F.lit(0.0)), (F.col("dims")[axis] - 1).cast("double")).cast("int")

    return clamp(vi, 0), clamp(vj, 1), clamp(vk, 2)


def _atlas_literal(atlas_mm, target_label) -> Column:
    return F.array(*[
        F.struct(F.lit(r).alias("region"), F.lit(s).alias("side"),
                 F.lit(float(x[0])).alias("x0"), F.lit(float(x[1])).alias("x1"),
                 F.lit(float(y[0])).alias("y0"), F.lit(float(y[1])).alias("y1"),
                 F.lit(float(z[0])).alias("z0"), F.lit(float(z[1])).alias("z1"),
                 F.lit(int(target_label[r])).alias("target_label"))
        for r, s, x, y, z in atlas_mm])


def roi_boxes(meta: DataFrame, atlas_mm=ATLAS_MM, target_label: dict | None = None) -> DataFrame:
    """Per (session, region, side) the inclusive index box of the ROI.

    meta: (session_id, dims, zooms, affine). The constant atlas is inlined as a
    literal array and expanded per session with ``inline`` — a narrow
    generator, no join. A box fully outside the image clamps onto an edge
    plane and is not empty.
    """
    j = meta.select("*", F.inline(_atlas_literal(atlas_mm, target_label or TARGET_LABEL)))
    lo = mm_to_index(F.col("x0"), F.col("y0"), F.col("z0"))
    hi = mm_to_index(F.col("x1"), F.col("y1"), F.col("z1"))
    return j.select(
        "session_id", "region", "side", "target_label",
        *[F.least(lo[n], hi[n]).alias(f"{ax}0") for n, ax in enumerate("ijk")],
        *[F.greatest(lo[n], hi[n]).alias(f"{ax}1") for n, ax in enumerate("ijk")],
        product("zooms").alias("voxel_vol_mm3"))


def _count(arr: Column, label: int) -> Column:
    return F.size(F.filter(arr, lambda x: x == label))


def roi_tissue_stats(slabs: DataFrame, boxes: DataFrame) -> DataFrame:
    """J11 + G15: tissue counts inside every box.

    Output per (session_id, region, side): target voxel count, volume, fraction
    of the box (0.0 for an empty box), total box voxels and csf/gm/wm/background
    counts. Overlapping boxes count a voxel in each box.
    """
    bk = boxes.withColumn("k", F.explode(F.sequence(F.col("k0"), F.col("k1"))))
    j = slabs.select("session_id", "k", "nj", "labels").join(bk, ["session_id", "k"], "inner")
    inbox = F.filter("labels", lambda x, p: F.floor(p / F.col("nj")).between(F.col("i0"), F.col("i1"))
                     & (p % F.col("nj")).between(F.col("j0"), F.col("j1")))
    per = j.select("session_id", "region", "side", inbox.alias("v"))
    counts = per.groupBy("session_id", "region", "side").agg(
        F.sum(F.size("v")).alias("total"),
        *[F.sum(_count(F.col("v"), lab)).alias(f"c{lab}") for lab in (0, CSF, GM, WM)])
    full = boxes.join(counts, ["session_id", "region", "side"], "left")
    c = {lab: F.coalesce(F.col(f"c{lab}"), F.lit(0)).cast("long") for lab in (0, CSF, GM, WM)}
    total = F.coalesce(F.col("total"), F.lit(0)).cast("long")
    target = (F.when(F.col("target_label") == CSF, c[CSF]).when(F.col("target_label") == GM, c[GM])
              .when(F.col("target_label") == WM, c[WM]).otherwise(c[0]))
    return full.select(
        "session_id", "region", "side", "target_label",
        target.alias("voxels"),
        (target * F.col("voxel_vol_mm3")).alias("volume_mm3"),
        F.when(total > 0, target / total).otherwise(F.lit(0.0)).alias("tissue_fraction"),
        total.alias("total_voxels"),
        c[CSF].alias("csf_voxels"), c[GM].alias("gm_voxels"), c[WM].alias("wm_voxels"),
        c[0].alias("background_voxels"))


WIDE_MEASURES = ("volume_mm3", "voxels", "tissue_fraction", "gm_voxels", "wm_voxels", "csf_voxels")


def pivot_regions(stats: DataFrame, measures=WIDE_MEASURES) -> DataFrame:
    """Long (session, region, side) → one row per session with ``region_side_measure`` columns.

    The pivot values are the fixed ROI list, so no extra job discovers them.
    """
    keys = [f"{r}_{s}" for r in REGIONS for s in SIDES]
    long = stats.select("session_id", F.concat_ws("_", "region", "side").alias("roi"), *measures)
    wide = long.groupBy("session_id").pivot("roi", keys).agg(*[F.max(m).alias(m) for m in measures])
    if len(measures) == 1:  # Spark names single-aggregate pivots by value only
        wide = wide.select("session_id", *[F.col(k).alias(f"{k}_{measures[0]}") for k in keys])
    return wide
