"""Exact k-nearest-neighbour classification (C6 / J12), distance-weighted, pruned by a pivot index.

1. Pivots are fitted by a few Lloyd steps on a bounded sample of training rows (``SAMPLE`` rows, those with the smallest
   hash of their key); there are about the root of the training rows of them, ``MAX_CELLS`` at most. Every training row
   belongs to the cell of its nearest pivot and keeps its distance from it; a cell's count and smallest and largest
   distance are the index (one row a cell).
2. A query is first compared with its home: the nearest cells that hold k rows together. The k-th distance found there
   bounds all that can still matter.
3. Then it visits the other cells whose lower bound is within that: by the triangle inequality on the cell's ring of
   distances, and by the plane between two pivots. Inside a cell the rows are sorted by their distance from the
   pivot, so that only a ring of them is compared, by numpy, query chunk by query chunk. The result is exact.
4. The k best of a query are kept by a ranked window with a limit, which Spark applies before and after the shuffle; no
   list of candidates is collected.

Cells of many rows or queries are split into blocks, so a task holds two blocks at most whatever the data. The driver sees
the sample and one row a cell.

Ties in distance go to the smaller train id. Weights are 1/d; when a query has neighbours at distance 0 only those vote
(each with weight 1). Rows with a null or NaN feature are neighbours of nothing and have none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.columns import nan_to_null, q
from cohortlab.session import ship_package, stored

K = 5
BLOCK_ROWS = 50_000
QUERY_CHUNK = 64
SAMPLE, MAX_CELLS = 16_384, 1_024
#: Bounds are widened by this share, so that rounding never cuts a neighbour off.
SLACK = 1e-9


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` from all of ``b``, feature by feature from left to right."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        out += diff * diff
    return np.sqrt(out)


def fit_pivots(sample: np.ndarray, cells: int, steps: int = 4) -> np.ndarray:
    """At most ``cells`` different pivots: Lloyd steps from the first rows of the sample."""
    pivots = np.unique(sample[:cells], axis=0)
    for _ in range(steps if len(pivots) > 1 else 0):
        near = np.concatenate([distances(sample[i:i + 512], pivots).argmin(axis=1) for i in range(0, len(sample), 512)])
        count = np.bincount(near, minlength=len(pivots))
        sums = np.stack([np.bincount(near, sample[:, j], len(pivots)) for j in range(sample.shape[1])], axis=1)
        pivots = np.unique(sums[count > 0] / count[count > 0, None], axis=0)
    return pivots


def home_cells(to_pivot: np.ndarray, count: np.ndarray, k: int) -> np.ndarray:
    """Mask of the nearest cells that hold ``k`` rows together, by query."""
    order = np.argsort(to_pivot, axis=1, kind="stable")
    before = np.cumsum(count[order], axis=1) - count[order]
    out = np.zeros(to_pivot.shape, bool)
    np.put_along_axis(out, order, before < k, axis=1)
    return out


def lower_bounds(to_pivot: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """No row of a cell is nearer to a query than this: by the cell's ring, and by the plane between the cell's pivot
    and the query's own (rows belong to their nearest pivot)."""
    plane = (to_pivot - to_pivot.min(axis=1, keepdims=True)) / 2
    return np.maximum(np.maximum(to_pivot - high, low - to_pivot), plane)


def nearest_rows(x: np.ndarray, tid: np.ndarray, ring: np.ndarray, queries: np.ndarray, to_pivot: np.ndarray,
                 reach: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, row, distance) of the ``k`` nearest rows of a cell block for every query that may have any within its reach,
    and how many distances that took. Rows are sorted by ``ring``, their distance from the pivot."""
    found, compared = ([], [], []), 0
    order = np.argsort(to_pivot, kind="stable")  # queries of a chunk need about the same ring
    margin = reach + SLACK * (1 + np.where(np.isfinite(reach), reach, 0) + to_pivot)
    first, last = np.searchsorted(ring, to_pivot - margin, "left"), np.searchsorted(ring, to_pivot + margin, "right")
    for s in range(0, len(order), QUERY_CHUNK):
        part = order[s:s + QUERY_CHUNK]
        part = part[first[part] < last[part]]
        if not len(part):
            continue
        a, b = first[part].min(), last[part].max()
        d = distances(queries[part], x[a:b])
        compared += d.size
        kk = min(k, d.shape[1])
        edge = np.minimum(np.partition(d, kk - 1, axis=1)[:, kk - 1], margin[part])
        i, j = np.nonzero(d <= edge[:, None])
        far = d[i, j]
        best = np.lexsort((tid[a + j], far, i))
        i, j, far = i[best], j[best], far[best]
        place = np.arange(len(i)) - np.searchsorted(i, i, "left")
        keep = place < k
        for out, got in zip(found, (part[i[keep]], a + j[keep], far[keep])):
            out.append(got)
    return (*(np.concatenate(f) if f else np.zeros(0, t) for f, t in zip(found, (int, int, float))), compared)


def knn_candidates(train: DataFrame, queries: DataFrame, features: list[str], label: str, train_key: str,
                   query_key: str, k: int = K, block_rows: int = BLOCK_ROWS, counter=None) -> DataFrame:
    """(qid, tid, d, y): the k nearest train rows of every query row (exact). ``counter``: an accumulator that receives
    the number of distances between queries and training rows."""
    spark = train.sparkSession
    ship_package(spark)
    cols = [f"x{i}" for i in range(len(features))]
    xs = [nan_to_null(F.col(q(c)).cast("double")).alias(x) for c, x in zip(features, cols)]
    t = train.select(F.col(q(train_key)).cast("long").alias("tid"), F.col(q(label)).cast("int").alias("y"), *xs).na.drop(subset=cols)
    asked = queries.select(F.col(q(query_key)).cast("long").alias("qid"), *xs).na.drop(subset=cols)
    vector = ", ".join(f"{c} double" for c in cols)
    cells = min(MAX_CELLS, math.ceil(math.sqrt(t.count())))
    sample = t.orderBy(F.xxhash64("tid"), "tid").limit(SAMPLE).select(*cols).toPandas().to_numpy(float)
    pivots = fit_pivots(sample, max(1, cells))
    if not len(pivots):
        return spark.createDataFrame([], "qid long, tid long, d double, y int")

    def to_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            d = distances(pdf[cols].to_numpy(float), pivots)
            near = d.argmin(axis=1)
            yield pdf.assign(cell=near.astype(np.int32), ring=d[np.arange(len(d)), near])

    rows = stored(t.mapInPandas(to_cells, f"tid long, y int, {vector}, cell int, ring double"), "knn-rows")
    index = rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("ring").alias("low"), F.max("ring").alias("high")).toPandas()
    count, low, high = (np.zeros(len(pivots)) for _ in range(3))
    count[index["cell"]], low[index["cell"]], high[index["cell"]] = index["n"], index["low"], index["high"]

    def visits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The cells that a query visits: its home without a ``reach``, the others within it."""
        for pdf in frames:
            for a in range(0, len(pdf), 4096):
                part = pdf.iloc[a:a + 4096]
                d = distances(part[cols].to_numpy(float), pivots)
                home, reach = home_cells(d, count, k), part["reach"].to_numpy(float)
                near = lower_bounds(d, low, high) <= (reach + SLACK * (1 + np.where(np.isfinite(reach), reach, 0)))[:, None] + SLACK * d
                i, c = np.nonzero((home if part["first"].iloc[0] else ~home & near) & (count > 0))
                yield part.iloc[i][["qid", *cols, "reach"]].assign(cell=c.astype(np.int32), ring=d[i, c])

    def search(wanted: DataFrame) -> DataFrame:
        wanted = stored(wanted.mapInPandas(visits, f"qid long, {vector}, reach double, cell int, ring double"), "knn-visits")
        asked_of = {r.cell: r.n for r in wanted.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row a cell
        parts = spark.createDataFrame([(int(c), max(1, math.ceil(count[c] / block_rows)), max(1, math.ceil(n / block_rows)))
                                       for c, n in asked_of.items()], "cell int, tparts int, qparts int")
        numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = (rows.join(F.broadcast(parts), "cell").withColumn("tp", F.pmod(F.xxhash64("tid"), F.col("tparts")).cast("int"))
                .withColumn("qp", numbers("qparts")).drop("tparts", "qparts"))
        right = (wanted.join(F.broadcast(parts), "cell").withColumn("qp", F.pmod(F.xxhash64("qid"), F.col("qparts")).cast("int"))
                 .withColumn("tp", numbers("tparts")).drop("tparts", "qparts"))

        def compare(tp: pd.DataFrame, qp: pd.DataFrame) -> pd.DataFrame:
            tp = tp.sort_values(["ring", "tid"], kind="stable")
            tid = tp["tid"].to_numpy()
            i, j, d, compared = nearest_rows(tp[cols].to_numpy(float), tid, tp["ring"].to_numpy(), qp[cols].to_numpy(float),
                                             qp["ring"].to_numpy(), qp["reach"].to_numpy(float), k)
            if counter is not None:
                counter.add(compared)
            return pd.DataFrame({"qid": qp["qid"].to_numpy()[i], "tid": tid[j], "d": d, "y": tp["y"].to_numpy()[j]})

        by = ("cell", "tp", "qp")
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(compare, "qid long, tid long, d double, y int")

    def best(found: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("qid").orderBy("d", "tid"))
        return found.withColumn("place", place).where(F.col("place") <= k).drop("place")

    near = stored(best(search(asked.withColumn("reach", F.lit(float("inf"))).withColumn("first", F.lit(True)))), "knn-home")
    bound = near.groupBy("qid").agg(F.when(F.count("*") >= k, F.max("d")).otherwise(float("inf")).alias("reach"))
    further = search(asked.join(bound, "qid").withColumn("first", F.lit(False)))
    return best(near.unionByName(further))


def knn_vote(cands: DataFrame) -> DataFrame:
    """(qid, p1, pred) from the neighbour rows with 1/d weights (zero distance takes all the weight)."""
    g = cands.groupBy("qid").agg(
        F.count_if(F.col("d") == 0).alias("nz"),
        F.sum(F.when(F.col("d") == 0, F.col("y").cast("double"))).alias("z1"),
        F.sum(F.when(F.col("d") > 0, F.col("y") / F.col("d"))).alias("w1"),
        F.sum(F.when(F.col("d") > 0, 1.0 / F.col("d"))).alias("w"))
    p1 = F.when(F.col("nz") > 0, F.coalesce(F.col("z1"), F.lit(0.0)) / F.col("nz")).otherwise(
        F.coalesce(F.col("w1"), F.lit(0.0)) / F.col("w"))
    return g.select("qid", p1.alias("p1"), (p1 > 0.5).cast("int").alias("pred"))


def fit_knn(train: DataFrame, features: list[str], label: str = "target", train_key: str | None = None,
            k: int = K, block_rows: int = BLOCK_ROWS):
    """Lazy 'fit' (kNN keeps the training frame); transform needs a unique key column on both sides."""
    from cohortlab.models.classifiers import Fitted
    tk = train_key or "__rid"
    tr = train if train_key else train.withColumn("__rid", F.monotonically_increasing_id())

    def predict(df: DataFrame, key: str = "__qid") -> DataFrame:
        qd = df if key in df.columns else df.withColumn(key, F.monotonically_increasing_id())
        votes = knn_vote(knn_candidates(tr, qd, features, label, tk, key, k, block_rows))
        out = qd.join(votes, qd[q(key)].cast("long") == votes["qid"], "left").drop("qid")
        return out.drop("__qid") if key == "__qid" else out

    return Fitted("knn", features, predict, extra={"k": k, "label": label, "train_key": tk, "train": tr, "block_rows": block_rows})
