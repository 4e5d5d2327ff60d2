"""File-based sources: clinical table, file listing, manifest, image pairs, volumes.

A listing is a DataFrame with a ``path`` column, as
``spark.read.format("binaryFile").option("recursiveFileLookup", "true")``
gives it; selecting only ``path`` prunes the file contents from the scan.
"""

from __future__ import annotations

import gzip
import re
import struct
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.functions.columns import nan_to_null_all, q
from cohortlab.session import ship_package, stored

# File-name endings of the session files.
SEG_HDR, SEG_TXT, T88_HDR = "_fseg.hdr", "_fseg.txt", "_t88_masked_gfc.hdr"
SESSION_RE = r"/(OAS1_[^/]+)/"


def read_clinical(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None,
                  dataset: str = "cross-sectional", key: str = "ID", rename: dict | None = None) -> DataFrame:
    """The clinical sheet with an explicit schema, NaN → null, ``dataset`` and ``Subject_ID`` added."""
    r = spark.read.schema(schema) if schema else spark.read
    df = r.option("header", "true").csv(path) if fmt == "csv" else r.format(fmt).load(path)
    df = nan_to_null_all(df)
    for a, b in (rename or {}).items():
        df = df.withColumnRenamed(a, b)
    return df.withColumns({"dataset": F.lit(dataset), "Subject_ID": F.col(key)})


def read_matrix(spark: SparkSession, path: str, schema: str, label: str | None = None) -> DataFrame:
    """Header CSV of features (and optionally the label column) with a fixed schema."""
    df = spark.read.schema(schema).option("header", "true").csv(path)
    return nan_to_null_all(df) if label is None else nan_to_null_all(df).withColumnRenamed(label, "target")


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """All file paths under ``root`` (contents are not read: only ``path`` is selected)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path")


METRIC_FILES = ("*_metrics.json", r"([^/]+)_metrics\.json$")   # fixed values: how one model's metrics are named
COMPARISON_FILE = "model_comparison.csv"


def read_metrics(spark: SparkSession, root: str, keys=("accuracy", "precision", "recall", "f1_score", "roc_auc"),
                 model_re: str = METRIC_FILES[1], glob: str = METRIC_FILES[0]) -> DataFrame:
    """S3: one row per model (model, metric columns). A comparison table in ``root`` wins; else every model's metric
    file is one JSON document, on one line or indented, named by its model. A missing key reads as 0."""
    schema = T.StructType([T.StructField(k, T.DoubleType()) for k in keys])
    table = list_files(spark, root, COMPARISON_FILE).first()
    if table is not None:
        df = spark.read.option("header", "true").csv(table["path"])
        return df.select("model", *[(F.col(q(k)).cast("double") if k in df.columns else F.lit(0.0)).alias(k) for k in keys])
    df = (spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob).json(root))
    return df.select(F.regexp_extract(F.input_file_name(), model_re, 1).alias("model"),
                     *[F.coalesce(F.col(k), F.lit(0.0)).alias(k) for k in keys])


def session_manifest(listing: DataFrame) -> DataFrame:
    """One row per session directory with the three file paths and has-flags.

    Several matches of one kind: the smallest path wins (the reference's pick
    depends on directory order).
    """
    p = F.col("path")
    s = listing.select(
        p, F.regexp_extract(p, SESSION_RE, 1).alias("session_id"),
        F.regexp_extract(p, r"/([^/]+)/OAS1_[^/]+/", 1).alias("disc"),
        F.regexp_extract(p, r"^(.*/OAS1_[^/]+)/", 1).alias("session_dir"))
    s = s.where(F.col("session_id") != "")
    in_seg = p.contains("/FSL_SEG/")
    in_t88 = p.contains("/PROCESSED/MPRAGE/T88_111/")
    g = s.groupBy("session_id").agg(
        F.min("disc").alias("disc"), F.min("session_dir").alias("session_dir"),
        F.min(F.when(in_seg & p.endswith(SEG_HDR), p)).alias("path_fsl_seg_hdr"),
        F.min(F.when(in_seg & p.endswith(SEG_TXT), p)).alias("path_fsl_seg_txt"),
        F.min(F.when(in_t88 & p.endswith(T88_HDR), p)).alias("path_t88_masked_hdr"))
    return g.select("*", F.col("path_fsl_seg_hdr").isNotNull().alias("has_fsl_seg_img"),
                    F.col("path_fsl_seg_txt").isNotNull().alias("has_fsl_seg_txt"),
                    F.col("path_t88_masked_hdr").isNotNull().alias("has_t88_masked"))


def _stems(listing: DataFrame, ext: str) -> DataFrame:
    p = F.col("path")
    return listing.where(p.endswith(ext)).select(p, F.expr(f"substring(path, 1, length(path) - {len(ext)})").alias("stem"))


def analyze_pairs(listing: DataFrame) -> DataFrame:
    """Header files that have a sibling data file (``.hdr`` with ``.img``)."""
    hdr, img = _stems(listing, ".hdr"), _stems(listing, ".img")
    return hdr.join(img.select("stem"), "stem", "left_semi").select("path")


def batch_outcomes(listing: DataFrame, overwrite: bool = False, out_ext: str = ".nii.gz") -> DataFrame:
    """S8 per header: outcome failed (no data file) / skipped (output exists, no overwrite) / success."""
    hdr = _stems(listing, ".hdr")
    img = _stems(listing, ".img").select("stem", F.lit(True).alias("has_img"))
    out = _stems(listing, out_ext).select("stem", F.lit(True).alias("has_out"))
    j = hdr.join(img, "stem", "left").join(out, "stem", "left")
    outcome = (F.when(F.col("has_img").isNull(), "failed")
               .when(F.col("has_out").isNotNull() & F.lit(not overwrite), "skipped").otherwise("success"))
    err = F.when(F.col("has_img").isNull(), F.concat(F.lit("Missing .img for "), F.col("path")))
    return j.select("path", outcome.alias("outcome"), err.alias("error"))


def batch_summary(outcomes: DataFrame) -> DataFrame:
    """S8 totals: total, success, skipped, failed (errors stay in the outcome rows)."""
    o = F.col("outcome")
    return outcomes.agg(F.count(F.lit(1)).alias("total"), F.count_if(o == "success").alias("success"),
                        F.count_if(o == "skipped").alias("skipped"), F.count_if(o == "failed").alias("failed"))


# ---------------------------------------------------------------------------
# Analyze 7.5 / NIfTI-1 volumes → slab rows
# ---------------------------------------------------------------------------

_DTYPES = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4"}

VOLUME_SCHEMA = ("session_id string, kind string, k int, ni int, nj int, labels array<int>, values array<double>, "
                 "dims array<int>, zooms array<double>, affine array<double>, status string, error string")


def decode_volume(header: bytes, data: bytes | None = None):
    """Header (+ separate data for Analyze) → (array[x, y, z], zooms, affine).

    Fortran voxel order, 4-D volumes with one frame squeezed. NIfTI uses its
    sform when set; otherwise the base affine (x flipped, centred).
    """
    if header[:2] == b"\x1f\x8b":
        header = gzip.decompress(header)
    end = "<" if struct.unpack("<i", header[:4])[0] == 348 else ">"
    dim = struct.unpack(end + "8h", header[40:56])
    code = struct.unpack(end + "h", header[70:72])[0]
    pixdim = struct.unpack(end + "8f", header[76:108])
    vox_offset = int(struct.unpack(end + "f", header[108:112])[0])
    nd = dim[0]
    shape = [d for d in dim[1:1 + nd]]
    while len(shape) > 3 and shape[-1] == 1:
        shape.pop()
    if len(shape) != 3:
        raise ValueError(f"expected a 3-D volume, got shape {shape}")
    dt = np.dtype(end + _DTYPES[code])
    n = int(np.prod(shape))
    raw = data if data is not None else header[vox_offset:]
    if data is not None and data[:2] == b"\x1f\x8b":
        raw = gzip.decompress(data)
    arr = np.frombuffer(raw, dtype=dt, count=n).astype("float64").reshape(shape, order="F")
    magic = header[344:348]
    slope = struct.unpack(end + "f", header[112:116])[0] if magic in (b"n+1\x00", b"ni1\x00") else 0.0
    if slope not in (0.0, 1.0) and np.isfinite(slope):
        inter = struct.unpack(end + "f", header[116:120])[0]
        arr = arr * slope + inter
    zooms = [float(abs(z)) for z in pixdim[1:4]]
    sform = struct.unpack(end + "h", header[254:256])[0] if magic in (b"n+1\x00", b"ni1\x00") else 0
    if sform > 0:
        rows = [struct.unpack(end + "4f", header[o:o + 16]) for o in (280, 296, 312)]
        affine = [float(v) for r in rows for v in r] + [0.0, 0.0, 0.0, 1.0]
    else:
        nx, ny, nz = shape
        affine = [-zooms[0], 0.0, 0.0, (nx - 1) / 2.0 * zooms[0],
                  0.0, zooms[1], 0.0, -(ny - 1) / 2.0 * zooms[1],
                  0.0, 0.0, zooms[2], -(nz - 1) / 2.0 * zooms[2],
                  0.0, 0.0, 0.0, 1.0]
    return arr, zooms, affine


def read_bytes(path: str) -> bytes:
    """The content of one file, read where this runs (a task); any store that pyarrow knows by its scheme."""
    from pyarrow import fs

    if re.match(r"[a-z0-9]+:", path) and not path.startswith("file:"):  # Spark gives paths as they are, not quoted
        store, place = fs.FileSystem.from_uri(quote(re.sub(r"^s3[an]:", "s3:", path), safe=":/@"))
    else:
        store, place = fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    with store.open_input_stream(place, compression=None) as f:
        return f.read()


def _volume_rows(session_id: str, header_path: str, data_path: str | None) -> list[tuple]:
    """Rows of one image: geometry and slabs, or a status row if it cannot be read."""
    try:
        if data_path is None and not re.search(r"\.nii(\.gz)?$", header_path):
            raise FileNotFoundError("the header has no data file")
        arr, zooms, affine = decode_volume(read_bytes(header_path), None if data_path is None else read_bytes(data_path))
        nx, ny, nz = arr.shape
        rows = [(session_id, "meta", None, None, None, None, None, [nx, ny, nz], zooms, affine, "success", None)]
        for k in range(nz):
            plane = arr[:, :, k]
            rows.append((session_id, "slab", k, nx, ny, np.rint(plane).astype("int64").ravel().tolist(), plane.ravel().tolist(),
                         None, None, None, None, None))
        return rows
    except Exception as e:  # noqa: BLE001 - a broken file becomes a status row
        return [(session_id, "meta", None, None, None, None, None, None, None, None, "error", f"{type(e).__name__}: {e}")]


def _decode_batches(batches):
    names = [x.split()[0] for x in VOLUME_SCHEMA.split(", ")]
    for pdf in batches:
        for r in pdf.itertuples(index=False):  # one image's rows at a time
            yield pd.DataFrame(_volume_rows(r.session_id, r.header, r.data), columns=names)


#: Image pairs that a task reads one after the other.
PAIRS_PER_TASK = 16


def image_pairs(spark: SparkSession, root: str, session_re: str = r"(OAS1_\d+_MR\d+)", header_glob: str = "*.hdr") -> DataFrame:
    """(session_id, header, data): the paths of every header and of its data file (null without one), without contents."""
    p = F.col("path")
    stem = F.regexp_replace(p, r"\.(hdr|img|nii(\.gz)?)$", "")
    heads = list_files(spark, root, header_glob).select(stem.alias("stem"), p.alias("header"), F.regexp_extract(p, session_re, 1).alias("session_id"))
    data = list_files(spark, root, "*.img").select(stem.alias("stem"), p.alias("data"))
    return heads.join(data, "stem", "left").select("session_id", "header", "data")


def read_volumes(spark: SparkSession, root: str, session_re: str = r"(OAS1_\d+_MR\d+)",
                 header_glob: str = "*.hdr", pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """Decode every header (+ data file) under ``root`` into slab and meta rows (``kind`` column).

    Only paths are listed, joined and dealt out, ``pairs_per_task`` to a task; a task reads the contents of its own files,
    one image at a time, so no content is shuffled. A file that cannot be read becomes a ``meta`` row with status
    'error'. ``.nii`` / ``.nii.gz`` single files work with ``header_glob='*.nii*'``.
    """
    ship_package(spark)
    pairs = stored(image_pairs(spark, root, session_re, header_glob), "image-pairs")
    tasks = max(1, -(-pairs.count() // pairs_per_task))
    return pairs.repartition(tasks, "header").mapInPandas(_decode_batches, VOLUME_SCHEMA)


def split_volumes(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(slabs, meta) frames of :func:`read_volumes` output."""
    slabs = decoded.where(F.col("kind") == "slab").select("session_id", "k", "ni", "nj", "labels", "values")
    meta = decoded.where(F.col("kind") == "meta").select("session_id", "dims", "zooms", "affine", "status", "error")
    return slabs, meta
