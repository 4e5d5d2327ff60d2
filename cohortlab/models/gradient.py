"""Gradient-boosted trees for two classes (C4, C5) from histograms over blocks of binned rows.

The model is that of Spark's ``GBTClassifier`` and is returned as a ``GBTClassificationModel``: logistic loss, regression
trees on the negative gradients, the best of all bin borders by variance, the first tree with weight 1 and the others with
the step size. Candidate borders follow the same rule (all midpoints where they fit, else equal strides over a sample of
``max_bins ** 2`` rows, all rows if there are no more). Where all rows are taken the trees are Spark's; where a sample is
drawn it is another one than Spark's of the same size, so borders, and with them trees and scores, differ from Spark's a little.

Rows are binned once and packed into blocks of one byte a feature, with the label and the score so far. A level of a tree
is one pass: tasks find their rows' nodes and sum gradients and their squares by node, feature and bin; the sums of the
tasks are added and the driver, which sees nodes x features x bins, takes the best border of each node. Scores are carried
on with the blocks (kept in memory or on disk, checkpointed every ``CHECKPOINT_ROUNDS`` rounds).

Several fits may grow side by side: they share the blocks and the passes, each has its features, its scores and its depth and
may leave out a fold, whose rows are not seen by its borders either.

Missing or infinite features, labels other than 0 and 1, and a table without rows are errors, as they are in Spark.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.columns import q
from cohortlab.session import ensure_checkpoint_dir, ship_package

PACK_ROWS = 16_384       # rows of a packed block when blocks are dealt out
BLOCK_ROWS = 131_072     # rows of a block in the passes; a task has one at least where there are as many rows
CHECKPOINT_ROUNDS = 20
STEP_ROWS = 16_384       # rows that walk down a tree at once: what a step needs stays in the processor's cache
COLLECTED_PARTS = 32     # sums of more tasks are added in two steps
EPSILON = 2.0 ** -52     # a node with less variance is pure

NODE_TYPE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                       ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                       ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]))])


@dataclass
class Tree:
    """Nodes in arrays: the right child follows the left one; a leaf is its own child, and no bin goes right of it."""

    feature: list = field(default_factory=lambda: [0])
    border: list = field(default_factory=lambda: [np.iinfo(np.int64).max])
    left: list = field(default_factory=lambda: [0])
    stats: list = field(default_factory=lambda: [None])     # (count, sum, sum of squares); the squares come with the node's own pass
    gain: list = field(default_factory=lambda: [-1.0])
    depth: int = 0

    def split(self, node: int, feature: int, border: int, gain: float, left, right) -> tuple[int, int]:
        first = len(self.left)
        self.feature[node], self.border[node], self.left[node], self.gain[node] = feature, border, first, gain
        for at, stats in ((first, left), (first + 1, right)):
            self.feature.append(0)
            self.border.append(np.iinfo(np.int64).max)
            self.left.append(at)
            self.stats.append(stats)
            self.gain.append(-1.0)
        return first, first + 1

    def arrays(self):
        return np.array(self.feature), np.array(self.border), np.array(self.left), self.depth

    def values(self) -> np.ndarray:
        return np.array([s[1] / s[0] for s in self.stats])


def variance(n: float, total: float, squares: float) -> float:
    return (squares - total * total / n) / n


def candidate_borders(values: np.ndarray, counts: np.ndarray, n_samples: float, n_rows: int, n_splits: int) -> np.ndarray:
    """Borders between the sorted distinct ``values`` (zeros left out; what is missing of ``n_samples`` is zeros)."""
    if len(values) == 0:
        return np.zeros(0)
    if n_samples - counts.sum() > EPSILON * n_rows * 100:
        at = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, at, 0.0), np.insert(counts.astype(float), at, n_samples - counts.sum())
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) <= n_splits:
        return middle
    stride, seen = n_samples / (n_splits + 1), np.cumsum(counts)
    target, borders = stride, []
    for i in range(1, len(values)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            borders.append(middle[i - 1])
            target += stride
    return np.array(borders)


def find_borders(rows: DataFrame, n: int, d: int, max_bins: int, seed: int) -> list[np.ndarray]:
    """Each feature's candidate borders; a task a feature sees the distinct values of a sample of max_bins ** 2 rows."""
    wanted, n_splits = max(max_bins * max_bins, 10_000), min(max_bins, n) - 1
    fraction = wanted / n if wanted < n else 1.0
    sample = rows if fraction == 1.0 else rows.sample(False, fraction, seed)
    cells = sample.select(F.posexplode(F.array(*[F.col(f"f{i}") for i in range(d)])).alias("f", "v")).where("v <> 0")

    def borders(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("v")
        found = candidate_borders(pdf["v"].to_numpy(), pdf["n"].to_numpy(), fraction * n, n, n_splits)
        return pd.DataFrame({"f": key[0], "border": found})

    found = cells.groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")).groupBy("f").applyInPandas(borders, "f int, border double").collect()
    out: list[list[float]] = [[] for _ in range(d)]
    for r in found:
        out[r.f].append(r.border)
    return [np.array(sorted(b)) for b in out]


def packer(borders: list[list[np.ndarray]], dtype):
    """Arrow batches of (features, label, fold) to blocks of bin numbers, set of borders after set and feature after feature,
    labels -1 / 1 and folds."""
    def block(tables):
        t = pa.Table.from_batches(tables)
        values = [t.column(f"f{i}").to_numpy() for i in range(len(borders[0]))]
        bins = np.vstack([np.searchsorted(b, v).astype(dtype) for one in borders for b, v in zip(one, values)])
        y, fold = (2.0 * t.column("y").to_numpy() - 1.0).astype(np.int8), t.column("fold").to_numpy().astype(np.int32)
        return pa.RecordBatch.from_pydict({"n": pa.array([len(y)], pa.int32()), "bins": [bins.tobytes()], "y": [y.tobytes()], "fold": [fold.tobytes()]})

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


def merged(sets: int, d: int, dtype, n_fits: int, folds: bool):
    """The packed blocks of a partition as few blocks of (bins [set, feature, row], labels, folds or None, scores [fit, row])."""
    def whole(held, n):
        return (np.concatenate([b for b, *_ in held], axis=2), np.concatenate([y for _, y, _ in held]),
                np.concatenate([f for *_, f in held]) if folds else None, np.zeros((n_fits, n)))

    def merge(rows):
        held, n = [], 0
        for r in rows:
            held.append((np.frombuffer(r.bins, dtype).reshape(sets, d, r.n), np.frombuffer(r.y, np.int8), np.frombuffer(r.fold, np.int32)))
            n += r.n
            if n >= BLOCK_ROWS:
                yield whole(held, n)
                held, n = [], 0
        if n:
            yield whole(held, n)
    return merge


def walked(flat: np.ndarray, n: int, rows: np.ndarray, feature, border, left, depth: int) -> np.ndarray:
    """The node that each of ``rows`` has reached after ``depth`` steps; ``flat``: bins of n rows, feature after feature."""
    node = np.zeros(len(rows), dtype=np.int64)
    at, left = feature.astype(np.int64) * n, left.astype(np.int64)
    border = np.minimum(border, np.iinfo(flat.dtype).max).astype(flat.dtype)  # no bin is above that
    for _ in range(depth):
        where = at.take(node)
        where += rows
        right = flat.take(where) > border.take(node)
        node = left.take(node)
        node += right
    return node


def nodes_of(bins: np.ndarray, feature, border, left, depth: int) -> np.ndarray:
    """The node that each row has reached after ``depth`` steps."""
    n, flat = bins.shape[1], bins.ravel()
    out = np.empty(n, dtype=np.int64)
    for s in range(0, n, STEP_ROWS):
        out[s:s + STEP_ROWS] = walked(flat, n, np.arange(s, min(n, s + STEP_ROWS)), feature, border, left, depth)
    return out


def gradients(y: np.ndarray, score: np.ndarray, first: bool) -> np.ndarray:
    """What the next tree is fitted to: the labels first, then the logistic loss's negative gradients."""
    y = y.astype(float)
    if first:
        return y
    with np.errstate(over="ignore"):
        return 4.0 * y / (1.0 + np.exp(2.0 * y * score))


def adder(done: list[tuple]):
    """Blocks with the values of finished trees (fit, set of borders, tree, values, weight) added to the scores of their fits."""
    def add(block):
        bins, y, fold, scores = block
        scores = scores.copy()
        for fit, at_set, tree, values, weight in done:
            scores[fit] += weight * values[nodes_of(bins[at_set], *tree)]
        return bins, y, fold, scores
    return add


def sums_size(widths: np.ndarray, n_open: int, last: bool) -> int:
    return (3 if last else 2) * n_open * int(widths.sum()) + n_open


def summer(work: list[tuple], first: bool):
    """A partition's (count, sum) x open node x feature x bin, then its sum of squares x node, fit after fit; the last level,
    whose children are not opened, sums the squares by feature and bin too. ``work``: a fit's number, set of borders, fold that
    it leaves out, features, their numbers of bins, tree, place of each open node, number of them, and whether it is its last level."""
    def sums(blocks):
        out = None
        for bins, y, fold, scores in blocks:
            if out is None:
                out = np.zeros(sum(sums_size(w[4], w[7], w[8]) for w in work))
            start = 0
            for fit, at_set, held, at, widths, tree, slots, n_open, last in work:
                kinds, wide = 3 if last else 2, int(widths.sum())
                end = start + sums_size(widths, n_open, last)
                by_bin, by_node = out[start:end - n_open].reshape(kinds, n_open, wide), out[end - n_open:end]
                start = end
                own, g = bins[at_set], gradients(y, scores[fit], first)
                slot = slots.take(nodes_of(own, *tree))
                if held is not None:
                    slot = np.where(fold == held, -1, slot)
                if (held is not None or n_open < len(slots)) and not (kept := slot >= 0).all():
                    own, g, slot = own[:, kept], g[kept], slot[kept]
                squares, to, places = g * g, 0, {}
                by_node += np.bincount(slot, weights=squares, minlength=n_open)
                for f, width in zip(at, widths):
                    if width not in places:
                        places[width] = slot * width
                    cell = places[width] + own[f]
                    for k, w in zip(range(kinds), (None, g, squares)):
                        by_bin[k, :, to:to + width] += np.bincount(cell, weights=w, minlength=n_open * width).reshape(n_open, width)
                    to += width
        if out is not None:
            yield out
    return sums


def added(rdd):
    if rdd.getNumPartitions() > COLLECTED_PARTS:
        return rdd.treeReduce(np.add)
    return np.sum(rdd.collect(), axis=0)


def best_borders(by_bin: np.ndarray, n_splits: np.ndarray):
    """Per node the first (feature, border) that lowers the variance most: what it takes away, feature, border, and the
    sums of all rows and of those on the left. Nothing is taken away where there is no border with rows on both sides."""
    n_open, d, n_bins = by_bin.shape[1:]
    total = by_bin.sum(axis=3)[:, :, 0]                          # kinds x nodes
    left = np.cumsum(by_bin, axis=3)                             # kinds x nodes x features x borders
    right, left = left[..., -1:] - left[..., :-1], left[..., :-1]
    n, s = (x[:, None, None] for x in total[:2])
    allowed = (left[0] >= 1) & (right[0] >= 1) & (np.arange(n_bins - 1) < n_splits[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - s ** 2 / n) / n
    gain = np.where(allowed, gain, -np.inf).reshape(n_open, -1)
    best = np.argmax(gain, axis=1)
    at, f, b = np.arange(n_open), best // (n_bins - 1), best % (n_bins - 1)
    return gain[at, best], f, b, total.T, left[:, at, f, b].T


def even(by_bin: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Sums by the features' own numbers of bins as kinds x nodes x features x bins, zeros behind a feature's last bin."""
    out = np.zeros((*by_bin.shape[:2], len(widths), max(2, int(widths.max()))))
    for f, (width, end) in enumerate(zip(widths, np.cumsum(widths))):
        out[:, :, f, :width] = by_bin[:, :, end - width:end]
    return out


@dataclass
class Boosting:
    """One of the fits side by side: its features (numbers), set of borders, fold that it leaves out, and its trees so far."""

    est: GBTClassifier
    at: np.ndarray
    at_set: int
    held: int | None
    n_splits: np.ndarray
    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)

    def walk(self):
        feature, border, left, depth = self.trees[-1].arrays()
        return self.at[feature], border, left, depth


def grow(blocks, first: bool, fits: dict[int, Boosting]) -> None:
    """One more regression tree a fit, on the gradients of the blocks; a level of all of them is a pass."""
    opened = {i: [0] for i in fits}
    for fit in fits.values():
        fit.trees.append(Tree())
    for level in range(max(fit.est.getMaxDepth() for fit in fits.values())):
        work = []
        for i, nodes in opened.items():
            fit = fits[i]
            if nodes and level < fit.est.getMaxDepth():
                slots = np.full(len(fit.trees[-1].left), -1, dtype=np.int64)
                slots[nodes] = np.arange(len(nodes))
                work.append((i, fit.at_set, fit.held, fit.at, fit.n_splits + 1, fit.walk(), slots, len(nodes), level == fit.est.getMaxDepth() - 1))
        if not work:
            break
        sums, start = added(blocks.mapPartitions(summer(work, first))), 0
        for i, _, _, _, widths, _, _, m, last in work:
            fit, tree, end = fits[i], fits[i].trees[-1], start + sums_size(widths, m, last)
            by_bin, squares = sums[start:end - m].reshape(-1, m, int(widths.sum())), sums[end - m:end]
            gain, f, b, total, left = best_borders(even(by_bin, widths), fit.n_splits)
            after, start = [], end
            for k, node in enumerate(opened[i]):
                tree.stats[node] = (*total[k, :2].tolist(), float(squares[k]))
                if gain[k] > 0 and abs(variance(*tree.stats[node])) >= EPSILON:
                    after += tree.split(node, int(f[k]), int(b[k]), float(gain[k]), left[k].tolist(), (total[k] - left[k]).tolist())
                    tree.depth = level + 1
            opened[i] = after


def mean_leaf(stats) -> tuple:
    return float(stats[1] / stats[0]), float(variance(*stats)), list(stats), int(stats[0])


def saved_nodes(tree_id: int, tree: Tree, borders: list[np.ndarray], leaf_of=mean_leaf, place=None) -> list[tuple]:
    """A tree's nodes in prefix order, as Spark ML stores them; sibling leaves with one answer become a leaf. ``leaf_of``: a
    node's (answer, impurity, statistics, rows); ``place``: numbers of the features in the model, if they are others."""
    def node(i):
        leaf = leaf_of(tree.stats[i])
        if tree.left[i] == i:
            return leaf
        a, b = node(tree.left[i]), node(tree.left[i] + 1)
        if len(a) == len(b) == 4 and a[0] == b[0]:
            return (a[0], *leaf[1:])
        f = tree.feature[i]
        return (*leaf, tree.gain[i], place[f] if place else f, float(borders[f][tree.border[i]]), a, b)

    rows = []

    def saved(*x):
        return dict(zip(NODE_TYPE.names, (*x[:8], {"featureIndex": x[8], "leftCategoriesOrThreshold": x[9], "numCategories": -1})))

    def write(x):
        at = len(rows)
        rows.append(None)
        if len(x) == 4:
            rows[at] = (tree_id, saved(at, *x, -1.0, -1, -1, -1, []))
            return at
        a, b = write(x[7]), write(x[8])
        rows[at] = (tree_id, saved(at, *x[:5], a, b, x[5], [x[6]]))
        return at
    write(node(0))
    return rows


def stored_trees(spark, est, kind: str, one, one_kind: str, about: dict, nodes: list[tuple], weights: list[float]) -> str:
    """Folder of an ensemble of trees in the format of Spark's model writer. ``est``, ``one``: estimators with the parameters
    of the ensemble and of a tree; ``kind``, ``one_kind``: classes of the models."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    texts = []
    for name, stage in ((kind, est), (one_kind, one)):
        stage.save(f"{path}/{stage.uid}")
        texts.append({**json.loads(spark.read.text(f"{path}/{stage.uid}/metadata").first().value), "class": f"org.apache.spark.ml.{name}"})
    whole, single = texts
    about = json.dumps({**whole, **about, "numTrees": len(weights)})
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    spark.createDataFrame([(i, json.dumps({**single, "uid": f"{one.uid}_{i}"}), float(w)) for i, w in enumerate(weights)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    table = pa.Table.from_arrays([pa.array([n[0] for n in nodes], pa.int32()), pa.array([n[1] for n in nodes], NODE_TYPE)], ["treeID", "nodeData"])
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/model/data")
    return f"{path}/model"


def spark_model(spark, est: GBTClassifier, trees: list[Tree], weights: list[float], borders: list[np.ndarray], n_features: int) -> GBTClassificationModel:
    """The trees as Spark's model: written in the format of its model writer and loaded."""
    one = DecisionTreeRegressor(featuresCol=est.getFeaturesCol(), labelCol=est.getLabelCol(), maxBins=est.getMaxBins(), maxDepth=est.getMaxDepth(), seed=est.getSeed())
    nodes = [r for i, t in enumerate(trees) for r in saved_nodes(i, t, borders)]
    return GBTClassificationModel.load(stored_trees(spark, est, "classification.GBTClassificationModel", one, "regression.DecisionTreeRegressionModel",
                                                    {"numFeatures": n_features}, nodes, weights))


def checked_rows(train: DataFrame, features: list[str], label: str, fold: str | None, what: str) -> tuple[DataFrame, dict]:
    """(f0.., y, fold) of the training rows and the number of rows by fold (0 where there is no such column)."""
    rows = train.select(*[F.col(q(c)).cast("double").alias(f"f{i}") for i, c in enumerate(features)], F.col(q(label)).cast("double").alias("y"),
                        (F.col(q(fold)) if fold else F.lit(0)).cast("int").alias("fold"))
    bad = F.lit(False)
    for i in range(len(features)):
        bad = bad | F.col(f"f{i}").isNull() | F.isnan(f"f{i}") | (F.abs(f"f{i}") == float("inf"))
    seen = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"),
                                    F.count_if(~F.coalesce(F.col("y").isin(0.0, 1.0), F.lit(False))).alias("odd")).collect()
    n, bad, odd = (sum(r[c] for r in seen) for c in ("n", "bad", "odd"))
    if not n or bad or odd:
        raise ValueError(f"{what} needs rows with finite features and labels 0 or 1: {n} rows, {bad} with features that are "
                         f"missing or infinite, {odd} with other labels")
    return rows, {r.fold: r.n for r in seen}


def fit_boosted(train: DataFrame, features: list[str], label: str, est: GBTClassifier) -> GBTClassificationModel:
    """Boosted trees with the parameters of ``est`` (rounds, depth, step size, bins, seed, column names)."""
    return fit_boosted_together(train, features, label, [(features, None, est)])[0]


def fit_boosted_together(train: DataFrame, features: list[str], label: str, fits: list[tuple[list[str], int | None, GBTClassifier]],
                         fold: str | None = None) -> list[GBTClassificationModel]:
    """Boosted trees a fit, all of them a level further with every pass. A fit is its features, some of ``features``, the value of
    the column ``fold`` whose rows it leaves out (None: none), and its estimator; all have the same number of bins and seed."""
    spark, d, max_bins, seed = train.sparkSession, len(features), fits[0][2].getMaxBins(), fits[0][2].getSeed()
    if any((est.getMaxBins(), est.getSeed()) != (max_bins, seed) for *_, est in fits):
        raise ValueError("boosted trees side by side need the same number of bins and the same seed")
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    rows, sizes = checked_rows(train, features, label, fold, "a boosted tree")
    left_out = list(dict.fromkeys(h for _, h, _ in fits))
    n_of = {h: sum(n for k, n in sizes.items() if h is None or k != h) for h in left_out}
    if not all(n_of.values()):
        raise ValueError("a boosted tree needs rows beside those of the fold that it leaves out")
    borders = [find_borders(rows if h is None else rows.where(F.col("fold") != h), n_of[h], d, max_bins, seed) for h in left_out]
    dtype, all_fits = np.uint8 if max_bins <= 256 else np.int32, []
    for names, held, est in fits:
        at, at_set = np.array([features.index(c) for c in names]), left_out.index(held)
        all_fits.append(Boosting(est, at, at_set, held, np.array([len(borders[at_set][f]) for f in at])))
    parts = max(1, min(spark.sparkContext.defaultParallelism, -(-sum(sizes.values()) * len(fits) // BLOCK_ROWS)))
    packed = rows.mapInArrow(packer(borders, dtype), "n int, bins binary, y binary, fold binary").repartition(parts)
    blocks = packed.rdd.mapPartitions(merged(len(borders), d, dtype, len(fits), fold is not None)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    before = None
    try:
        for m in range(max(est.getMaxIter() for *_, est in fits)):
            live = {i: fit for i, fit in enumerate(all_fits) if m < fit.est.getMaxIter()}
            grow(blocks, m == 0, live)
            for fit in live.values():
                fit.weights.append(1.0 if m == 0 else fit.est.getStepSize())
            if before is not None:  # the blocks with the trees before these are kept now
                before.unpersist()
            done = [(i, fit.at_set, fit.walk(), fit.trees[-1].values(), fit.weights[-1]) for i, fit in live.items()]
            before, blocks = blocks, blocks.map(adder(done)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
            if (m + 1) % CHECKPOINT_ROUNDS == 0:
                blocks.checkpoint()
    finally:
        blocks.unpersist()
        if before is not None:
            before.unpersist()
    return [spark_model(spark, fit.est, fit.trees, fit.weights, [borders[fit.at_set][f] for f in fit.at], len(fit.at)) for fit in all_fits]
