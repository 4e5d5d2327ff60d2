"""File sources and sinks on files written into a scratch folder."""

import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlab.models import classifiers as C
from cohortlab.sources import files, sinks


def _analyze_pair(folder, stem, arr, zooms):
    hdr = bytearray(348)
    struct.pack_into("<i", hdr, 0, 348)
    struct.pack_into("<8h", hdr, 40, 3, *arr.shape, 1, 1, 1, 1)
    struct.pack_into("<h", hdr, 70, 2)   # uint8
    struct.pack_into("<h", hdr, 72, 8)
    struct.pack_into("<8f", hdr, 76, 1.0, *zooms, 0, 0, 0, 0)
    with open(os.path.join(folder, stem + ".hdr"), "wb") as f:
        f.write(bytes(hdr))
    with open(os.path.join(folder, stem + ".img"), "wb") as f:
        f.write(arr.astype("uint8").tobytes(order="F"))


def test_volume_decode(spark, tmp_path):
    d = tmp_path / "disc1" / "OAS1_0001_MR1" / "FSL_SEG"
    d.mkdir(parents=True)
    arr = np.arange(24).reshape((4, 3, 2), order="F") % 4
    _analyze_pair(str(d), "OAS1_0001_MR1_fseg", arr, (1.0, 2.0, 3.0))
    other = tmp_path / "disc1" / "OAS1_0002_MR1"
    other.mkdir()
    with open(str(other / "OAS1_0002_MR1_fseg.hdr"), "wb") as f:   # header without data file: a status row
        f.write(b"\x00" * 348)
    slabs, meta = files.split_volumes(files.read_volumes(spark, str(tmp_path)))
    bad = meta.where("status <> 'success'").collect()
    assert [(r.session_id, r.status) for r in bad] == [("OAS1_0002_MR1", "error")] and "data file" in bad[0].error
    from cohortlab.operators.volumes import qc_summary, session_qc
    sessions = spark.createDataFrame([("OAS1_0001_MR1",), ("OAS1_0002_MR1",), ("OAS1_0003_MR1",)], "session_id string")
    qc = session_qc(sessions, {"seg": (slabs, "values", meta)})
    got = {r.session_id[5:9]: (r.seg_status, r.qc_pass, r.seg_shape) for r in qc.collect()}
    assert got == {"0001": ("success", True, [4, 3, 2]), "0002": ("error", False, None), "0003": ("missing", True, None)}
    assert tuple(qc_summary(qc).first()) == (3, 2, 1)
    m = meta.where("status = 'success'").first()
    assert m.session_id == "OAS1_0001_MR1" and m.dims == [4, 3, 2] and m.zooms == [1.0, 2.0, 3.0]
    assert m.affine[0] == -1.0 and m.status == "success"
    got = {r.k: r.labels for r in slabs.collect()}
    assert got[0] == arr[:, :, 0].ravel().tolist() and got[1] == arr[:, :, 1].ravel().tolist()


def test_images_are_read_in_their_tasks(spark, tmp_path):
    """Pairs, single files, compressed and broken ones, odd names; only paths move between tasks."""
    import gzip

    rng, want = np.random.default_rng(1), {}
    for i in range(40):
        d = tmp_path / f"disc {i % 3}" / f"OAS1_{i:04d}_MR1"
        d.mkdir(parents=True)
        arr = rng.integers(0, 4, (3, 2, 2))
        _analyze_pair(str(d), f"im#{i}%20x_fseg", arr, (1.0, 1.0, 2.0))
        want[f"OAS1_{i:04d}_MR1"] = [arr[:, :, k].ravel().tolist() for k in range(2)]
        if i % 8 == 5:
            (d / f"im#{i}%20x_fseg.img").write_bytes(b"12")  # truncated
            want[f"OAS1_{i:04d}_MR1"] = None
    for header in (d / f"im#{i}%20x_fseg.hdr",):  # the same volume as one compressed file
        h = bytearray(header.read_bytes())
        struct.pack_into("<f", h, 108, 352.0)
        h[344:348] = b"n+1\x00"
        (tmp_path / "OAS1_9999_MR1.nii.gz").write_bytes(gzip.compress(bytes(h) + b"\0" * 4 + arr.astype("uint8").tobytes(order="F")))
    decoded = files.read_volumes(spark, str(tmp_path), pairs_per_task=4)
    assert decoded.rdd.getNumPartitions() >= 10
    slabs, meta = files.split_volumes(decoded)
    got = {}
    for r in slabs.orderBy("session_id", "k").collect():
        got.setdefault(r.session_id, []).append(r.labels)
    assert got == {k: v for k, v in want.items() if v}
    assert {r.session_id for r in meta.where("status = 'error'").collect()} == {k for k, v in want.items() if v is None}
    one, told = files.split_volumes(files.read_volumes(spark, str(tmp_path), header_glob="*.nii*"))
    assert told.first().status == "success" and [r.labels for r in one.orderBy("k").collect()] == want["OAS1_0039_MR1"]
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_listing_manifest_pairs(spark, tmp_path):
    base = tmp_path / "disc1" / "OAS1_0001_MR1"
    (base / "FSL_SEG").mkdir(parents=True)
    (base / "PROCESSED" / "MPRAGE" / "T88_111").mkdir(parents=True)
    for p in ("FSL_SEG/x_fseg.hdr", "FSL_SEG/x_fseg.img", "FSL_SEG/x_fseg.txt",
              "PROCESSED/MPRAGE/T88_111/x_t88_masked_gfc.hdr"):
        (base / p).write_bytes(b"1")
    listing = files.list_files(spark, str(tmp_path))
    m = files.session_manifest(listing).first()
    assert m.session_id == "OAS1_0001_MR1" and m.disc == "disc1"
    assert m.has_fsl_seg_img and m.has_fsl_seg_txt and m.has_t88_masked
    assert files.analyze_pairs(listing).count() == 1
    s = files.batch_summary(files.batch_outcomes(listing)).first()
    assert (s.total, s.success, s.failed) == (2, 1, 1)


def test_metrics_scan_reads_written_files(spark, tmp_path):
    import json
    for kind, acc in (("svm", 0.7), ("knn", 0.8)):
        (tmp_path / f"{kind}_metrics.json").write_text(json.dumps({"accuracy": acc, "recall": 0.5, "confusion_matrix": [[1, 2], [3, 4]]}, indent=2))
    (tmp_path / "other.json").write_text("{}")
    rows = {r.model: r for r in files.read_metrics(spark, str(tmp_path)).collect()}
    assert set(rows) == {"svm", "knn"} and rows["svm"].accuracy == 0.7 and rows["knn"].recall == 0.5 and rows["knn"].roc_auc == 0.0
    (tmp_path / "model_comparison.csv").write_text("model,accuracy,roc_auc\nsvm,0.9,0.95\n")   # the comparison table wins
    assert [tuple(r) for r in files.read_metrics(spark, str(tmp_path)).collect()] == [("svm", 0.9, 0.0, 0.0, 0.0, 0.95)]


def test_metrics_json_roundtrip(spark):
    df = spark.createDataFrame([("knn", 0.8, 0.9), ("svm", 0.7, None)], "model string, accuracy double, roc_auc double")
    path = sinks.write_json(df, sinks.scratch_path(spark, "t-metrics"), partition_by=["model"])
    back = {r.model: r for r in files.read_metrics(spark, path, model_re=r"model=([^/]+)", glob="*.json").collect()}
    assert back["knn"].accuracy == 0.8 and back["knn"].precision == 0.0 and back["svm"].roc_auc == 0.0


def test_json_ready_map_keys(spark):
    df = spark.createDataFrame([({1: 2},)], "m map<int,int>")
    assert sinks.to_json_column(df).first().json == '{"m":{"1":2}}'


def test_naive_bayes_save_load(spark):
    tr = spark.createDataFrame([(0.0, 0), (0.2, 0), (1.0, 1), (1.3, 1)], "x double, target int")
    f = C.fit_naive_bayes(tr, ["x"])
    path = sinks.save_model(f, sinks.scratch_path(spark, "t-nb"), spark)
    g = sinks.load_naive_bayes(spark, path, ["x"])
    a = [r.p1 for r in f.transform(tr).orderBy("x").collect()]
    b = [r.p1 for r in g.transform(tr).orderBy("x").collect()]
    assert a == pytest.approx(b) and a[0] < 0.5 < a[-1]


def test_clinical_scan_nan(spark, tmp_path):
    p = str(tmp_path / "c.csv")
    with open(p, "w") as f:
        f.write("ID,Age,MMSE\nOAS1_0001_MR1,70,NaN\nOAS1_0002_MR1,80,29\n")
    df = files.read_clinical(spark, p, "csv", "ID string, Age long, MMSE double")
    r = df.orderBy("ID").collect()
    assert r[0].MMSE is None and r[0].Subject_ID == "OAS1_0001_MR1" and r[0].dataset == "cross-sectional"
    assert df.where(F.col("MMSE").isNull()).count() == 1


def test_all_models_survive_a_round_trip(spark, monkeypatch):
    monkeypatch.setattr(C, "ADA_ROUNDS", 3)
    for params in (C.RF_PARAMS, C.XGB_PARAMS, C.GB_PARAMS):
        monkeypatch.setitem(params, "maxDepth", 2)
        monkeypatch.setitem(params, "numTrees" if "numTrees" in params else "maxIter", 3)
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), int(a + b > 0)) for i, (a, b) in enumerate(rng.normal(size=(60, 2)))]
    df = spark.createDataFrame(rows, "id long, x double, y double, target int")
    from cohortlab.models.knn import fit_knn
    for kind in C.MODEL_TYPES:
        f = fit_knn(df, ["x", "y"], "target", train_key="id") if kind == "knn" else (
            C.fit_svm(df, ["x", "y"], n_components=8) if kind == "svm" else C.fit(kind, df, ["x", "y"]))
        g = sinks.load_model(spark, sinks.save_model(f, sinks.scratch_path(spark, f"t-{kind}"), spark))
        assert g.model_type == kind and g.features == ["x", "y"]
        score = lambda m: {r.id: r.p1 for r in (m.predict_fn(df, "id") if kind == "knn" else m.transform(df)).collect()}
        a, b = score(f), score(g)
        assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-12) for i in a), kind
