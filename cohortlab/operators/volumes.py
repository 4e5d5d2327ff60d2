"""Per-session image statistics, mid-plane slices and session QC.

Intensities live in the slab ``values`` arrays. Foreground statistics explode the
values once, into a histogram: equal values are counted where their slabs are,
and the counts are merged per session. All statistics are then read from the
histogram, percentiles by running counts along its sorted values
(``ranks.running``), which no session's size puts into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.columns import q
from cohortlab.operators.ranks import running
from cohortlab.session import stored

FOREGROUND_STATS = ("min", "max", "mean", "std", "median", "p01", "p99")


def foreground_stats(sessions: DataFrame, slabs: DataFrame, values: str = "values",
                     key: str = "session_id", accuracy: int | None = None) -> DataFrame:
    """Over values > 0 only: min, max, mean, population std, median, p01, p99, count.

    Every session of ``sessions`` gets a row; one with no foreground voxel (or
    no image) gets zeros, as the reference does.
    """
    probs = {"median": 0.5, "p01": 0.01, "p99": 0.99}
    histogram = (slabs.select("session_id", F.explode(F.col(values).cast("array<double>")).alias("v")).where(F.col("v") > 0)
                 .groupBy("session_id", "v").agg(F.count(F.lit(1)).alias("c")))
    if accuracy is None:
        ranked = running(histogram, ["session_id"], "v", "c")
    else:
        ranked = stored(histogram, "histogram")
    total = ranked.groupBy("session_id").agg(F.min("v").alias("min"), F.max("v").alias("max"), F.sum("c").alias("nonzero_voxels"),
                                             (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"))
    total = stored(total, "totals")  # one row a session: Spark knows its size
    rows, n = ranked.join(total, "session_id"), F.col("nonzero_voxels")
    spread = F.sqrt(F.sum(F.col("c") * F.pow(F.col("v") - F.col("mean"), 2)) / F.first("nonzero_voxels")).alias("std")
    if accuracy is None:
        def at(rank):
            return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("c")), F.col("v")))
        picks = [x for name, p in probs.items() for x in (at(F.floor((n - 1) * p)).alias(f"{name}0"), at(F.ceil((n - 1) * p)).alias(f"{name}1"),
                                                          F.first((n - 1) * p - F.floor((n - 1) * p)).alias(f"{name}f"))]
        read = rows.groupBy("session_id").agg(spread, *picks).select("session_id", "std", *[
            (F.col(f"{name}0") + (F.col(f"{name}1") - F.col(f"{name}0")) * F.col(f"{name}f")).alias(name) for name in probs])
    else:  # a sketch over the values as often as they occur
        p = F.expr(f"approx_percentile(v, array({', '.join(map(str, probs.values()))}), {int(accuracy)})")
        sketch = slabs.select("session_id", F.explode(F.col(values).cast("array<double>")).alias("v")).where(F.col("v") > 0).groupBy("session_id").agg(p.alias("p"))
        read = rows.groupBy("session_id").agg(spread).join(sketch, "session_id").select(
            "session_id", "std", *[F.col("p")[i].alias(name) for i, name in enumerate(probs)])
    st = total.join(read, "session_id").select("session_id", *FOREGROUND_STATS, "nonzero_voxels")
    s = sessions.select(F.col(q(key)).alias("session_id")).distinct()
    j = s.join(st, "session_id", "left")
    return j.select("session_id", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in FOREGROUND_STATS],
                    F.coalesce("nonzero_voxels", F.lit(0)).cast("long").alias("nonzero_voxels"))


def image_stats(slabs: DataFrame, meta: DataFrame, values: str = "values", dtype: str = "float64") -> DataFrame:
    """Shape, zooms, dtype, min, max, mean, population std over ALL voxels of each image."""
    v = slabs.select("session_id", F.explode(values).alias("v"))
    st = v.groupBy("session_id").agg(F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"),
                                     F.stddev_pop("v").alias("std"), F.count(F.lit(1)).alias("n_voxels"))
    m = meta.select("session_id", F.col("dims").alias("shape"), "zooms")
    return (m.join(st, "session_id", "left")
            .select("session_id", "shape", "zooms", F.lit(dtype).alias("dtype"), "min", "max", "mean", "std",
                    "n_voxels",
                    F.when(F.col("n_voxels").isNull(), "failed").otherwise("success").alias("status")))


def mid_slices(slabs: DataFrame, meta: DataFrame, values: str = "labels") -> DataFrame:
    """The three planes through the volume centre, dims // 2 on each axis.

    Output (session_id, plane, u, v, value): plane 'axial' (k fixed; u=i, v=j),
    'coronal' (j fixed; u=i, v=k), 'sagittal' (i fixed; u=j, v=k).
    """
    m = meta.select("session_id", (F.col("dims")[0] / 2).cast("int").alias("ci"),
                    (F.col("dims")[1] / 2).cast("int").alias("cj"), (F.col("dims")[2] / 2).cast("int").alias("ck"))
    j = slabs.select("session_id", "k", "nj", F.col(values).alias("arr")).join(m, "session_id")
    nj, k = F.col("nj"), F.col("k")

    def cell(plane, u, v, x):
        return F.struct(F.lit(plane).alias("plane"), u.cast("int").alias("u"), v.cast("int").alias("v"),
                        x.alias("value"))

    # pick the plane elements inside each slab array before exploding (index arithmetic, no voxel rows)
    axial = F.when(k == F.col("ck"), F.transform("arr", lambda x, p: cell("axial", F.floor(p / nj), p % nj, x)))
    coronal = F.transform(F.filter(F.transform("arr", lambda x, p: F.struct(p.alias("p"), x.alias("x"))),
                                   lambda s: s["p"] % nj == F.col("cj")),
                          lambda s: cell("coronal", F.floor(s["p"] / nj), k, s["x"]))
    sagittal = F.transform(F.slice("arr", F.col("ci") * nj + 1, nj), lambda x, p: cell("sagittal", p, k, x))
    elem = dict(j.dtypes)["arr"][len("array<"):-1]
    none = F.array().cast(f"array<struct<plane:string,u:int,v:int,value:{elem}>>")
    return j.select("session_id", F.inline(F.concat(F.coalesce(axial, none), coronal, sagittal)))


def session_qc(sessions: DataFrame, images: dict[str, tuple], key: str = "session_id") -> DataFrame:
    """Per session, per image type: status and foreground stats; qc_pass and error list.

    ``images`` maps an image type to (slabs, values column) or (slabs, values column, meta) with the reader's
    meta rows (session_id, status, error, dims, zooms). A missing image gives status ``missing`` and an error entry
    but does NOT fail qc_pass; a status of ``failed`` or ``error`` in meta does. With meta, the shape and the voxel
    sizes of good images are added.
    """
    s = sessions.select(F.col(q(key)).alias("session_id")).distinct()
    out = s
    statuses, errors = [], []
    for t, (sl, col, *more) in images.items():
        have = sl.select("session_id").distinct().withColumn(f"__has_{t}", F.lit(True))
        fg = foreground_stats(s, sl, col)
        fg = fg.select("session_id", *[F.col(c).alias(f"{t}_{c}") for c in fg.columns if c != "session_id"])
        out = out.join(have, "session_id", "left").join(fg, "session_id", "left")
        st = F.when(F.col(f"__has_{t}"), "success").otherwise("missing")
        if more:  # one row a session; a broken file wins over a good one
            told = more[0].groupBy("session_id").agg(
                F.max(F.when(F.col("status") != "success", F.struct("status", "error"))).alias(f"__bad_{t}"),
                F.max("dims").alias(f"{t}_shape"), F.max("zooms").alias(f"{t}_voxel_dims"))
            out = out.join(told, "session_id", "left")
            st = F.coalesce(F.col(f"__bad_{t}.status"), st)
        out = out.withColumn(f"{t}_status", st).drop(f"__has_{t}")
        for c in FOREGROUND_STATS + ("nonzero_voxels",):
            out = out.withColumn(f"{t}_{c}", F.when(F.col(f"{t}_status") == "success", F.col(f"{t}_{c}")))
        statuses.append(F.col(f"{t}_status"))
        said = F.when(F.col(f"{t}_status") == "missing", F.lit(f"{t} file missing"))
        if more:
            out = out.withColumn(f"{t}_error", F.col(f"__bad_{t}.error")).drop(f"__bad_{t}")
            said = said.when(F.col(f"{t}_error").isNotNull(), F.concat(F.lit(f"{t}: "), F.col(f"{t}_error")))
        errors.append(said)
    bad = F.lit(False)
    for st in statuses:
        bad = bad | st.isin("failed", "error")
    return (out.withColumn("qc_pass", ~bad)
            .withColumn("errors", F.filter(F.array(*errors), lambda e: e.isNotNull())))


def qc_summary(qc: DataFrame) -> DataFrame:
    """Totals of sessions, passes and failures."""
    return qc.agg(F.count(F.lit(1)).alias("total_sessions"), F.count_if("qc_pass").alias("qc_pass"),
                  F.count_if(~F.col("qc_pass")).alias("qc_fail"))
