"""Hand-made edge frames (FIXTURES.md §2) against the documented semantics."""

import math

import pytest
from pyspark.sql import functions as F

from cohortlab.functions.columns import asymmetry_index, display_round, laterality_ratio, safe_corr
from cohortlab.operators import clean, encode, merge, metrics, profile, roi, scale, split, stats
from cohortlab.operators.region import derive_regional
from cohortlab.operators.volumes import foreground_stats
from frame_rows import rows


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 1.0), (None, 5.0), (3.0, 7.0)], "x double, y double")
    fitted = clean.fit_imputer(df, "median", numeric=["x"], categorical=[]).first()
    assert fitted["x"] == 2.0  # median of 1, 3 — NaN and null both ignored
    imputed = clean.impute(df, "median", numeric=["x"], categorical=[])
    assert rows(imputed, "x") == [(1.0,), (2.0,), (2.0,), (3.0,)]
    g = stats.global_stats(df, ["x"]).first()
    assert g["n"] == 2 and g["mean"] == 2.0
    p = profile.profile_columns(df).where(F.col("column") == "x").first()
    assert p["n_missing"] == 2


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a long, b double")
    assert clean.all_null_columns(df) == ["b"]
    assert clean.drop_all_null_columns(df).columns == ["a"]
    assert clean.impute(df, numeric=["b"], categorical=[]).where(F.col("b").isNull()).count() == 2
    assert scale.binary_columns(df, ["b"]) == ["b"]


def test_mode_tie_and_all_null_string(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("a", None), ("b", None), (None, None)], "s string, t string")
    out = clean.impute(df, numeric=[], categorical=["s", "t"])
    assert sorted(r.s for r in out.collect()) == ["a", "a", "a", "b", "b"]
    assert {r.t for r in out.collect()} == {"Unknown"}


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "c double")
    out = scale.standardise(df, ["c"])
    assert rows(out) == [(0.0,), (0.0,), (0.0,)]


def test_binary_variants(spark):
    df = spark.createDataFrame([(0, 0, 0, 0, 0.0), (1, 0, 1, 2, 1.0), (1, 0, None, 0, 0.0)],
                               "a int, b int, c int, d int, e double")
    assert scale.binary_columns(df, ["a", "b", "c", "d", "e"]) == ["a", "b", "c", "e"]


def test_label_cases(spark):
    df = spark.createDataFrame([(0.0, "Nondemented"), (0.5, "Demented"), (None, None)], "CDR double, Group string")
    a = clean.binary_target(df, "CDR")
    assert [r.target for r in a.orderBy(F.col("CDR").asc_nulls_last()).collect()] == [0, 1, 0]
    b = clean.binary_target(df, "Group")
    assert [r.target for r in b.orderBy(F.col("CDR").asc_nulls_last()).collect()] == [0, 1, 1]


def test_dup_keys(spark):
    df = spark.createDataFrame([("k1",), ("k1",), ("k2",), (None,), ("",)], "k string")
    v = profile.validate_keys(df, "k").first()
    assert (v.null_keys, v.empty_keys, v.unique_keys, v.duplicate_keys) == (1, 1, 3, 2)
    assert v.duplicate_values == ["k1"] and not v.is_valid
    missing = profile.validate_keys(df, "nope").first()
    assert not missing.is_valid and "not found" in missing.error


def test_merge_sides(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    right = spark.createDataFrame([("b", 20), ("c", 30), ("d", 40)], "k string, v int")
    m = merge.validated_merge(left, right, "k")
    assert set(m.columns) == {"k", "v_left", "v_right", "_merge"}
    assert rows(m, "k", "_merge") == [("a", "left_only"), ("b", "both"), ("c", "both"), ("d", "right_only")]
    a = merge.merge_audit(m, left, right).first()
    assert (a.matched_rows, a.left_only_rows, a.right_only_rows) == (2, 1, 1)
    assert a.match_rate == pytest.approx(2 / 3)
    u = merge.unmatched_rows(m, "left")
    assert u.columns == ["k", "v_left"]
    with pytest.raises(ValueError):
        merge.validated_merge(left.union(left), right, "k")


def test_empty_sides(spark):
    e = spark.createDataFrame([], "k string, v int")
    m = merge.validated_merge(e, e, "k")
    a = merge.merge_audit(m, e, e).first()
    assert a.total_merged_rows == 0 and a.match_rate is None


def test_subject_split_zero_overlap(spark):
    data = [(s, s * 10 + i, 1 if s % 3 == 0 else 0) for s in range(10) for i in range(1 + s % 3)]
    df = spark.createDataFrame(data, "subject long, row long, target int")
    out = split.subject_split(df, "subject", "target", "row", 0.2, 42)
    per = out.groupBy("subject").agg(F.countDistinct("split").alias("n")).collect()
    assert all(r.n == 1 for r in per)
    n_test_subjects = out.where(F.col("split") == "test").select("subject").distinct().count()
    assert n_test_subjects == 2  # ceil(10 * 0.2)


def test_split_416_quotas(spark):
    df = spark.range(416).select(F.col("id").alias("k"), (F.col("id") >= 316).cast("int").alias("target"))
    q = {r.target: (r.n_train, r.n_test) for r in split.class_quotas(df, "target", 0.2).collect()}
    assert q == {0: (252, 64), 1: (80, 20)}
    out = split.stratified_holdout(df, "target", "k", 0.2, 42)
    got = {(r.target, r.split): r["count"] for r in out.groupBy("target", "split").count().collect()}
    assert got == {(0, "train"): 252, (0, "test"): 64, (1, "train"): 80, (1, "test"): 20}
    folds = split.stratified_kfold(df, "target", "k", 5, 42).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in folds) == [83, 83, 83, 83, 84]


def test_zero_volumes(spark):
    from cohortlab.operators.tissue import tissue_features
    s = spark.createDataFrame([(1,), (2,), (3,)], "session_id long")
    parsed = spark.createDataFrame([(1, "success", 0.0, 0.0, 0.0), (2, "success", 5.0, 3.0, 0.0),
                                    (3, "success", 5.0, 0.0, 0.0)],
                                   "session_id long, txt_status string, csf_vol_mm3 double, gm_vol_mm3 double, "
                                   "wm_vol_mm3 double")
    counts = spark.createDataFrame([], "session_id long, csf_voxels long, gm_voxels long, wm_voxels long, "
                                       "voxel_vol_mm3 double, seg_status string")
    t = {r.session_id: r for r in tissue_features(s, parsed, counts).collect()}
    assert t[1].csf_frac is None and t[1].csf_to_brain_ratio is None and t[1].gm_wm_ratio is None
    assert t[2].gm_wm_ratio is None and t[2].csf_frac == pytest.approx(5 / 8)
    assert t[3].csf_to_brain_ratio is None and t[3].csf_frac == 1.0


def test_asymmetry_and_laterality(spark):
    df = spark.createDataFrame([(3.0, 1.0), (0.0, 0.0), (2.0, 0.0), (None, 1.0)], "l double, r double")
    out = df.select(asymmetry_index("l", "r").alias("a"), laterality_ratio("l", "r").alias("lr")).collect()
    assert [r.a for r in out] == [0.5, 0.0, 1.0, None]
    assert [r.lr for r in out] == [3.0, None, None, None]


def test_composite_temporal(spark):
    cols = {f"{r}_{s}_{m}": None for r in roi.REGIONS for s in roi.SIDES for m in roi.WIDE_MEASURES}
    base = dict(cols, session_id=1)
    a = dict(base, entorhinal_left_volume_mm3=0.5, entorhinal_right_volume_mm3=0.5,
             inferior_temporal_left_volume_mm3=1.0, inferior_temporal_right_volume_mm3=1.0)
    b = dict(base, session_id=2)
    schema = "session_id long, " + ", ".join(f"{c} double" for c in cols)
    df = spark.createDataFrame([a, b], schema)
    out = {r.session_id: r for r in derive_regional(df).collect()}
    assert out[1].total_temporal_lobe_volume_mm3 == 3.0
    assert out[2].total_temporal_lobe_volume_mm3 is None
    assert out[2].regional_extraction_status == "failed"


def _meta(spark, affine):
    return spark.createDataFrame([(1, [4, 4, 4], [1.0, 1.0, 1.0], [float(a) for a in affine])],
                                 "session_id long, dims array<int>, zooms array<double>, affine array<double>")


def test_grid_boxes_clamp_and_overlap(spark):
    ident = [1.0, 0, 0, 0, 0, 1.0, 0, 0, 0, 0, 1.0, 0, 0, 0, 0, 1.0]
    atlas = (("a", "left", (1, 2), (0, 3), (0, 0)),        # inclusive ends
             ("b", "left", (2, 3), (0, 3), (0, 0)),        # overlaps a on i = 2
             ("c", "left", (10, 20), (0, 0), (0, 0)))      # fully outside → edge plane i = 3
    boxes = roi.roi_boxes(_meta(spark, ident), atlas, {"a": 2, "b": 2, "c": 2})
    got = {r.region: (r.i0, r.i1, r.j0, r.j1, r.k0, r.k1) for r in boxes.collect()}
    assert got == {"a": (1, 2, 0, 3, 0, 0), "b": (2, 3, 0, 3, 0, 0), "c": (3, 3, 0, 0, 0, 0)}
    labels = [2] * 16
    slabs = spark.createDataFrame([(1, k, 4, 4, labels, [1.0] * 16) for k in range(4)],
                                  "session_id long, k int, ni int, nj int, labels array<int>, values array<double>")
    st = {r.region: r for r in roi.roi_tissue_stats(slabs, boxes).collect()}
    assert st["a"].voxels == 8 and st["b"].voxels == 8 and st["c"].total_voxels == 1
    assert st["a"].tissue_fraction == 1.0


def test_negative_affine_half_even(spark):
    # x flipped with offset 1.5: x = -1 * i + 1.5 → i = 1.5 - x
    aff = [-1.0, 0, 0, 1.5, 0, 1.0, 0, 0, 0, 0, 1.0, 0, 0, 0, 0, 1.0]
    boxes = roi.roi_boxes(_meta(spark, aff), (("a", "left", (0.0, 1.0), (0, 0), (0, 0)),), {"a": 2})
    r = boxes.first()
    # corners: i = 1.5 → 2 (half-even), i = 0.5 → 0 (half-even); swapped into (0, 2)
    assert (r.i0, r.i1) == (0, 2)


def test_blank_image_stats_are_zero(spark):
    s = spark.createDataFrame([(1,), (2,)], "session_id long")
    slabs = spark.createDataFrame([(1, 0, 2, 2, [0, 0, 0, 0], [0.0, -1.0, 0.0, 0.0])],
                                  "session_id long, k int, ni int, nj int, labels array<int>, values array<double>")
    out = foreground_stats(s, slabs).collect()
    for r in out:
        assert (r["min"], r["max"], r["mean"], r["std"], r["median"], r["nonzero_voxels"]) == (0.0, 0.0, 0.0, 0.0,
                                                                                              0.0, 0)


def test_auc_ties(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "score double, truth int")
    for b in (1, 2, 64):
        assert metrics.roc_auc(df, buckets=b).first().roc_auc == pytest.approx(0.875)


def test_one_class(spark):
    df = spark.createDataFrame([(0.2, 0, 0), (0.7, 0, 1)], "score double, truth int, pred int")
    assert metrics.roc_auc(df).first().roc_auc is None
    m = metrics.binary_metrics(metrics.confusion(df)).first()
    assert (m.precision, m.recall, m.f1_score) == (0.0, 0.0, 0.0)


def test_auc_plan_does_not_grow(spark):
    plans = []
    for n in (1_000, 100_000):
        df = spark.range(n).selectExpr("id % 997 / 997.0D AS score", "cast((id * 31) % 7 < 3 AS int) AS truth", "id % 2 AS g")
        out = metrics.roc_auc(df, group=["g"])
        plans.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
        assert out.count() == 2
    assert abs(plans[0] - plans[1]) < 50  # paths and names apart, the same plan


def test_knn_zero_distance(spark):
    from cohortlab.models.knn import knn_candidates, knn_vote
    train = spark.createDataFrame([(1, 0.0, 0.0, 1), (2, 1.0, 1.0, 0), (3, 2.0, 2.0, 0), (4, 3.0, 3.0, 0),
                                   (5, 4.0, 4.0, 0), (6, 9.0, 9.0, 0)], "id long, a double, b double, target int")
    q = spark.createDataFrame([(100, 0.0, 0.0)], "qid long, a double, b double")
    c = knn_candidates(train, q, ["a", "b"], "target", "id", "qid", k=5, block_rows=2)
    assert sorted(r.tid for r in c.collect()) == [1, 2, 3, 4, 5]
    v = knn_vote(c).first()
    assert v.p1 == 1.0 and v.pred == 1


def test_score_missing(spark):
    from cohortlab.operators.scoring import align_features
    df = spark.createDataFrame([(1, None, "x7", "M"), (2, 3.5, "2.5", "f")], "k long, a double, b string, sex string")
    out = {r.k: r for r in align_features(df, ["a", "b", "sex", "absent"], "k",
                                          {"sex": {"F": 0, "M": 1}}).collect()}
    assert (out[1].a, out[1].b, out[1].sex, out[1].absent) == (0.0, 0.0, 1.0, 0.0)
    assert (out[2].a, out[2].b, out[2].sex) == (3.5, 2.5, 0.0)


def test_display_round_is_binary_half_even(spark):
    df = spark.createDataFrame([(0.02125,), (2.5e-5,), (None,)], "x double")
    got = [r.y for r in df.select(display_round("x").alias("y")).collect()]
    assert got[0] == round(0.02125, 4) and got[1] == round(2.5e-5, 4) and got[2] is None


def test_safe_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    assert df.select(safe_corr("a", "b").alias("r")).first().r is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None)], "a double, b double")
    assert df2.select(safe_corr("a", "b").alias("r")).first().r == pytest.approx(1.0)


def test_label_encoder(spark):
    df = spark.createDataFrame([("M",), ("F",), ("M",), (None,)], "s string")
    out = [r.s for r in encode.label_encode(df, ["s"]).collect()]
    assert out == [1, 0, 1, None]
    assert not math.isnan(1.0)


def test_regional_status_error_and_missing(spark):
    from cohortlab.operators.region import regional_features
    ident = [1.0, 0, 0, 0, 0, 1.0, 0, 0, 0, 0, 1.0, 0, 0, 0, 0, 1.0]
    meta = spark.createDataFrame([(1, [4, 4, 4], [1.0, 1.0, 1.0], [float(a) for a in ident], "success"),
                                  (2, None, None, None, "error")],
                                 "session_id long, dims array<int>, zooms array<double>, affine array<double>, "
                                 "status string")
    slabs = spark.createDataFrame([(1, k, 4, 4, [2] * 16, [1.0] * 16) for k in range(4)],
                                  "session_id long, k int, ni int, nj int, labels array<int>, values array<double>")
    sessions = spark.createDataFrame([(1, 1000.0), (2, 1000.0), (3, 1000.0)], "session_id long, etiv double")
    got = {r.session_id: r.regional_extraction_status
           for r in regional_features(sessions, slabs, meta).select("session_id", "regional_extraction_status").collect()}
    assert got == {1: "success", 2: "error", 3: "missing_image"}


def test_schema_options(spark):
    from cohortlab.operators.audit import LEAKAGE_COLUMNS
    df = spark.createDataFrame([("OAS1_0001_MR1", "F", 70, 29.0, 0.0, "x")],
                               "ID string, `M/F` string, Age long, MMSE double, CDR double, Hand string")
    assert clean.detect_target(df) == "CDR"
    with pytest.raises(ValueError):
        clean.detect_target(df.drop("CDR"))
    feats = clean.feature_columns(df, "CDR")
    assert feats == ["M/F", "Age", "MMSE"]
    assert clean.numeric_columns(df, feats) == ["Age", "MMSE"] and clean.string_columns(df, feats) == ["M/F"]
    ok, missing = merge.schema_contains(df, ["ID", "Age", "Group"])
    assert not ok and missing == ["Group"]
    assert [c for c in LEAKAGE_COLUMNS if c in df.columns] == []
