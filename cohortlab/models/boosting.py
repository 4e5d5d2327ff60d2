"""Discrete SAMME AdaBoost over depth-1 trees that try every threshold.

The distinct values of each feature are numbered once in sorted order (``ranks.numbered``) and dealt into at most ``buckets``
buckets of consecutive values, a value a bucket where there are no more. Rows are written once with their bucket numbers and
kept as packed blocks, and the stumps so far become one table of votes by bucket a feature, so a round's work a row does not
grow with the rounds. A round is:

1. one pass sums the weights of both classes by (feature, bucket): per task an array of feature x bucket sums, added up
   by Spark. From prefix sums over the buckets the driver knows the Gini impurity of every cut between buckets (at most
   ``buckets`` a feature), and for every bucket a bound: the impurity is concave in the class weights to the left, so no cut
   inside can be better than the better corner of what the bucket may send to the left;
2. buckets whose bound beats the best cut are opened: their rows' weights are summed by value and added up along the sorted
   values: on the driver where all opened buckets hold at most ``COLLECTED_VALUES`` distinct values, else in a window a
   bucket, from which the best cut comes back as one row. With few distinct values no bucket is opened.

So every threshold between two distinct values is considered, as by a sorted scan, and the choice is exact; ties go to the
first feature, then to the smallest threshold. A threshold is the middle of the two values around it. Weights are a function
of the stumps, so they are never stored and a lost task repeats its part only.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.columns import q
from cohortlab.models.gradient import BLOCK_ROWS, PACK_ROWS, added
from cohortlab.operators.ranks import numbered
from cohortlab.session import ship_package, stored

BUCKETS = 4_096
#: Impurities that differ by less are ties.
DIGITS = 12
#: Opened buckets of so many distinct values are finished on the driver, of more by Spark.
COLLECTED_VALUES = 200_000


def impurity(l0, l1, t0: float, t1: float):
    """Weighted Gini impurity of a cut that sends (l0, l1) of the class weights (t0, t1) to the left; arrays or numbers."""
    def part(a, b):
        n = a + b
        return 2 * a * b / np.where(n > 0, n, 1.0)  # n (1 - (a/n)^2 - (b/n)^2)
    return (part(l0, l1) + part(np.maximum(t0 - l0, 0.0), np.maximum(t1 - l1, 0.0))) / (t0 + t1)


def votes(stumps: list, alphas: list[float], low: list, high: list) -> tuple[list, list, float]:
    """The stumps' summed votes for class 1 as (table by bucket a feature or None, corrections, sum of the rest).

    All rows of a bucket get the same answer of a stump unless its threshold lies inside; there the table says the right
    side and a correction (feature, bucket, threshold, difference) is due to the rows that are not above the threshold.
    Behind a feature's buckets is a place for values that lie in none (right side). So a row costs a look-up a feature,
    however many stumps there are."""
    tables, inside, rest = [None] * len(low), [], 0.0
    for (f, threshold, left, right), a in zip(stumps, alphas):
        if f is None:
            rest += a * left
            continue
        if tables[f] is None:
            tables[f] = np.zeros(len(high[f]) + 1)
        below, above = np.append(high[f] <= threshold, False), np.append(low[f] > threshold, True)
        tables[f] += a * np.where(below, left, right)
        if left != right:
            inside += [(f, int(b), threshold, a * (left - right)) for b in np.flatnonzero(~below & ~above)]
    return tables, inside, rest


def row_weights(at: dict, values: dict, y: np.ndarray, alphas: list[float], voted: tuple) -> np.ndarray:
    """Boosting weights: exp of the sum of the alphas of the stumps that miss a row. ``at``: bucket numbers by feature,
    ``values``: values of the features with corrections."""
    tables, inside, rest = voted
    said = np.full(len(y), rest)
    for f, table in enumerate(tables):
        if table is not None:
            said += table[at[f]]
    for f, b, threshold, difference in inside:
        i = np.flatnonzero(at[f] == b)
        said[i[values[f][i] <= threshold]] += difference
    return np.exp(np.where(y == 0, said, sum(alphas) - said))


def best_cut(sums: np.ndarray, low: list, high: list) -> tuple[tuple, list[tuple]]:
    """((impurity, feature, threshold, l0, l1) or None, buckets to open) from the class sums by (feature, bucket).

    ``low`` and ``high``: smallest and largest value of each bucket, by feature."""
    best, bounds = None, []
    t0, t1 = sums[0].sum(axis=0)
    for f in range(len(sums)):
        n = len(low[f])
        if not n:
            continue
        upto = sums[f, :n].cumsum(axis=0)
        if n > 1:
            g = np.round(impurity(upto[:-1, 0], upto[:-1, 1], t0, t1), DIGITS)
            b = int(g.argmin())
            cut = (float(g[b]), f, float(high[f][b] + low[f][b + 1]) / 2, float(upto[b, 0]), float(upto[b, 1]))
            if best is None or cut[0] < best[0]:
                best = cut
        before = np.vstack([np.zeros((1, 2)), upto[:-1]])
        corners = np.minimum(impurity(upto[:, 0], before[:, 1], t0, t1), impurity(before[:, 0], upto[:, 1], t0, t1))
        for b in np.flatnonzero(low[f] < high[f]):
            bounds.append((float(corners[b]), f, int(b), float(before[b, 0]), float(before[b, 1])))
    edge = (best[0] if best else 1.0) + 10.0**-DIGITS
    return best, [x[1:] for x in bounds if x[0] <= edge]


def best_inside(sums: pd.DataFrame, open_buckets: list[tuple], t0: float, t1: float):
    """(impurity, feature, threshold, l0, l1) of the best cut between two values of a bucket, or None, from class weights by value."""
    sums = sums.groupby(["f", "b", "v"], as_index=False).sum()
    start = pd.DataFrame(open_buckets, columns=["f", "b", "l0", "l1"])
    at = sums.merge(start, on=["f", "b"]).sort_values(["f", "b", "v"], kind="stable")
    by = at.groupby(["f", "b"])
    cuts = pd.DataFrame({"f": at["f"], "t": (at["v"] + by["v"].shift(-1)) / 2, "a0": at["l0"] + by["w0"].cumsum(), "a1": at["l1"] + by["w1"].cumsum()}).dropna(subset="t")
    if not len(cuts):
        return None
    cuts["g"] = np.round(impurity(cuts["a0"].to_numpy(), cuts["a1"].to_numpy(), t0, t1), DIGITS)
    r = cuts.sort_values(["g", "f", "t"]).iloc[0]
    return float(r["g"]), int(r["f"]), float(r["t"]), float(r["a0"]), float(r["a1"])


def packer(xs: list[str], bs: list[str]):
    """Arrow batches of (values, label, bucket numbers) to blocks of values, bucket numbers and labels (-1 where there is none)."""
    def block(tables):
        t = pa.Table.from_batches(tables)
        of = lambda names, dtype: np.stack([t.column(c).to_numpy().astype(dtype) for c in names]).tobytes() if names else b""
        y = t.column("y").fill_null(-1).to_numpy()
        return pa.RecordBatch.from_pydict({"x": [of(xs, float)], "b": [of(bs, np.int32)], "y": [np.where((y == 0) | (y == 1), y, -1).astype(np.int8).tobytes()]})

    def pack(batches):
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= PACK_ROWS:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)
    return pack


def merged(d: int):
    """The packed blocks of a partition as few (bucket numbers [feature, row], values [feature, row], labels)."""
    def whole(held):
        return tuple(np.concatenate(x, axis=-1) for x in zip(*held))

    def merge(rows):
        held, n = [], 0
        for r in rows:
            y = np.frombuffer(r.y, np.int8)
            held.append((np.frombuffer(r.b, np.int32).reshape(d, len(y)), np.frombuffer(r.x).reshape(d, len(y)), y))
            n += len(y)
            if n >= BLOCK_ROWS:
                yield whole(held)
                held, n = [], 0
        if n:
            yield whole(held)
    return merge


def fit_stumps(train: DataFrame, features: list[str], label: str, rounds: int, rate: float,
               buckets: int = BUCKETS) -> tuple[list, list[float]]:
    """(stumps, alphas); a stump is (feature number or None, threshold, class left, class right)."""
    spark, d = train.sparkSession, len(features)
    ship_package(spark)
    xs = [f"x{i}" for i in range(d)]
    base = train.select(*[F.col(q(c)).cast("double").alias(x) for c, x in zip(features, xs)], F.col(q(label)).cast("int").alias("y"))
    distinct = base.select(F.inline(F.array(*[F.struct(F.lit(i).alias("f"), F.col(x).alias("v")) for i, x in enumerate(xs)]))).distinct()
    placed = numbered(distinct.where("v IS NOT NULL"), ["f"], ["v"])
    sizes = placed.groupBy("f").agg(F.count("*").alias("n"))  # one row a feature
    bucket = F.when(F.col("n") <= buckets, F.col("place")).otherwise(F.floor(F.col("place") * F.lit(float(buckets)) / F.col("n"))).cast("int")
    edges = (placed.join(F.broadcast(sizes), "f").groupBy("f", bucket.alias("b")).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))
             .orderBy("f", "b").toPandas())  # at most ``buckets`` rows a feature
    low, high, held_values = ([edges.loc[edges["f"] == f, c].to_numpy(float) for f in range(d)] for c in ("low", "high", "n"))
    bs = [f"b{i}" for i in range(d)]

    def place(frames):
        for pdf in frames:
            yield pdf.assign(**{b: np.searchsorted(high[f], pdf[xs[f]].to_numpy(float), "left").astype(np.int32) for f, b in enumerate(bs)})

    rows = stored(base.mapInPandas(place, ", ".join([f"{x} double" for x in xs] + ["y int"] + [f"{b} int" for b in bs])), "boosting-rows")
    most = max([len(x) for x in low] + [1])
    parts = max(1, min(-(-rows.count() // PACK_ROWS), max(spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())))
    blocks = (rows.mapInArrow(packer(xs, bs), "x binary, b binary, y binary").repartition(parts).rdd.mapPartitions(merged(d))
              .persist(StorageLevel.MEMORY_AND_DISK))

    def weighed(block: tuple, alphas: list[float], voted: tuple) -> np.ndarray:
        at, values, y = block
        return row_weights(dict(enumerate(at)), dict(enumerate(values)), y, alphas, voted)

    def sums_of(stumps: list, alphas: list[float]) -> np.ndarray:
        voted = votes(stumps, alphas, low, high)

        def task(held):
            out = np.zeros((d, 2 * (most + 1)))
            for block in held:
                at, _, y = block
                w = np.where((y == 0) | (y == 1), weighed(block, alphas, voted), 0.0)
                second = np.where(y == 1, most + 1, 0)
                for f in range(d):
                    out[f] += np.bincount(second + at[f], w, 2 * (most + 1))
            yield out

        out = added(blocks.mapPartitions(task)).reshape(d, 2, most + 1).transpose(0, 2, 1).copy()
        for f in range(d):
            out[f, len(high[f]):] = 0.0  # NaN and null lie beyond all
        return out[:, :most]

    def opened_sums(open_buckets: list[tuple], stumps: list, alphas: list[float]):
        """Blocks to their class weights by value of the opened buckets, as rows (f, b, v, w0, w1)."""
        wanted, voted = {}, votes(stumps, alphas, low, high)
        for f, b, *_ in open_buckets:
            wanted.setdefault(f, np.zeros(len(high[f]) + 1, bool))[b] = True

        def task(held):
            parts = []
            for block in held:
                at, values, y = block
                w = weighed(block, alphas, voted)
                for f, opened in wanted.items():
                    i = np.flatnonzero(opened[at[f]])
                    parts.append(pd.DataFrame({"f": np.int32(f), "b": at[f][i].astype(np.int32), "v": values[f][i], "w0": w[i] * (y[i] == 0), "w1": w[i] * (y[i] == 1)}))
            if parts:
                yield pd.concat(parts).groupby(["f", "b", "v"], as_index=False).sum()
        return blocks.mapPartitions(task)

    def inside(open_buckets: list[tuple], stumps: list, alphas: list[float], t0: float, t1: float):
        """Best cut between two values of the same bucket, among the opened ones."""
        summed = opened_sums(open_buckets, stumps, alphas)
        if sum(held_values[f][b] for f, b, *_ in open_buckets) <= COLLECTED_VALUES:
            frames = summed.collect()
            return best_inside(pd.concat(frames), open_buckets, t0, t1) if frames else None
        start = spark.createDataFrame(open_buckets, "f int, b int, l0 double, l1 double")
        summed = summed.flatMap(lambda pdf: zip(*(pdf[c].tolist() for c in pdf)))
        values = (spark.createDataFrame(summed, "f int, b int, v double, w0 double, w1 double", verifySchema=False).groupBy("f", "b", "v")
                  .agg(F.sum("w0").alias("w0"), F.sum("w1").alias("w1")).join(F.broadcast(start), ["f", "b"]))
        order = Window.partitionBy("f", "b").orderBy("v")
        run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cuts = (values.withColumn("next", F.lead("v").over(order)).withColumn("a0", F.col("l0") + F.sum("w0").over(run))
                .withColumn("a1", F.col("l1") + F.sum("w1").over(run)).where("next IS NOT NULL"))
        part = lambda a, b: F.when(a + b > 0, 2 * a * b / (a + b)).otherwise(0.0)
        right = [F.greatest(F.lit(t) - F.col(c), F.lit(0.0)) for t, c in ((t0, "a0"), (t1, "a1"))]
        g = F.round((part(F.col("a0"), F.col("a1")) + part(*right)) / F.lit(t0 + t1), DIGITS)
        r = cuts.agg(F.min(F.struct(g.alias("g"), "f", ((F.col("v") + F.col("next")) / 2).alias("t"), "a0", "a1")).alias("x")).first().x
        return (r.g, r.f, r.t, r.a0, r.a1) if r else None

    stumps, alphas = [], []
    try:
        for _ in range(rounds):
            sums = sums_of(stumps, alphas)
            t0, t1 = (float(x) for x in sums[0].sum(axis=0)) if d else (0.0, 0.0)
            best, to_open = best_cut(sums, low, high) if t0 + t1 > 0 else (None, [])
            if to_open and (found := inside(to_open, stumps, alphas, t0, t1)) and (best is None or found[:3] < best[:3]):
                best = found
            if best is None:  # nothing to cut: one leaf with the heavier class
                stump, err = (None, None, int(t1 > t0), int(t1 > t0)), (min(t0, t1) / (t0 + t1) if t0 + t1 else 0.0)
            else:
                _, f, threshold, l0, l1 = best
                left, right = int(l1 > l0), int(t1 - l1 > t0 - l0)
                err = ((l1 if left == 0 else l0) + (t1 - l1 if right == 0 else t0 - l0)) / (t0 + t1)
                stump = (f, threshold, left, right)
            if err <= 1e-15 or err >= 0.5:  # perfect, or no better than chance for two classes: stop
                if err <= 1e-15 or not stumps:
                    stumps.append(stump)
                    alphas.append(1.0)
                break
            stumps.append(stump)
            alphas.append(rate * math.log((1.0 - err) / err))
    finally:
        blocks.unpersist()
    return stumps, alphas
