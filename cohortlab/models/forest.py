"""Random forests for two classes (C1) from histograms over blocks of binned rows; several forests may grow side by side.

The method is that of Spark's ``RandomForestClassifier`` and the result is its ``RandomForestClassificationModel``: Gini
impurity, the best bin border of a random subset of the features at each node, rows drawn by a Poisson count a tree, and
Spark's rule for candidate borders (see :mod:`cohortlab.models.gradient`). Without drawn rows and features the trees are
Spark's; the draws are others, as they are in Spark too when the rows lie in other partitions.

Rows are binned once and packed into blocks. A level of all trees is one pass, or a few where there are many open nodes: tasks
walk their rows down each tree and count them by open node, drawn feature, bin and class; the counts of a few nodes of a tree
meet in a group that takes their best borders, so the driver gets one row a node. The draws of a block are repeated from its
number and the tree's, so nothing is kept but the blocks.

Forests side by side share the blocks: each has its features and may leave out a fold, whose rows are not seen by its
borders either.

Missing or infinite features, labels other than 0 and 1, and a table without rows are errors, as they are in Spark.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.models.gradient import EPSILON, PACK_ROWS, STEP_ROWS, Tree, checked_rows, find_borders, saved_nodes, stored_trees, walked
from cohortlab.session import ensure_checkpoint_dir, ship_package

CHUNK_ROWS = 262_144        # rows that a task counts at once
PART_ROWS = 4_194_304       # rows of a task at most
PIECE_NODES = 64            # nodes of a tree whose counts meet in a group
PASS_CELLS = 32_000_000     # counts of a task in a pass at most, one tree at least

BLOCK_SCHEMA = "number long, n int, bins binary, y binary, fold binary"
COUNT_SCHEMA = "tree int, piece int, counts binary"
CUT_SCHEMA = "tree int, slot int, gain double, feature int, border int, n0 double, n1 double, l0 double, l1 double"


def packer(borders: list[list[np.ndarray]], dtype):
    """Arrow batches of (features, label, fold) to blocks of bin numbers: set of borders after set, feature after feature."""
    def block(tables, number):
        t = pa.Table.from_batches(tables)
        values = [t.column(f"f{i}").to_numpy() for i in range(len(borders[0]))]
        bins = np.vstack([np.searchsorted(b, v).astype(dtype) for one in borders for b, v in zip(one, values)])
        y, fold = t.column("y").to_numpy().astype(np.int8), t.column("fold").to_numpy().astype(np.int32)
        return pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int64()), "n": pa.array([len(y)], pa.int32()),
                                           "bins": [bins.tobytes()], "y": [y.tobytes()], "fold": [fold.tobytes()]})

    def pack(batches):
        first = TaskContext.get().partitionId() << 32
        held, n, at = [], 0, 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= PACK_ROWS:
                yield block(held, first + at)
                held, n, at = [], 0, at + 1
        if n:
            yield block(held, first + at)
    return pack


def chunks(batches, sets: int, d: int, dtype):
    """The packed blocks of a task as few large (bins [set, feature, row], labels, folds, [(number, rows)])."""
    held, n = [], 0

    def merged():
        return (np.concatenate([b for b, *_ in held], axis=2), *(np.concatenate(x) for x in list(zip(*held))[1:3]), [h[3] for h in held])

    for batch in batches:
        for number, rows, bins, y, fold in zip(*(batch.column(i).to_pylist() for i in range(5))):
            held.append((np.frombuffer(bins, dtype).reshape(sets, d, rows), np.frombuffer(y, np.int8), np.frombuffer(fold, np.int32), (number, rows)))
            n += rows
            if n >= CHUNK_ROWS:
                yield merged()
                held, n = [], 0
    if n:
        yield merged()


def drawn(seed: int, tree: int, numbers: list[tuple[int, int]], rate: float | None) -> np.ndarray:
    """How often each row of the blocks is taken for a tree."""
    if rate is None:
        return np.ones(sum(n for _, n in numbers), dtype=np.uint8)
    upto = np.cumsum([math.exp(-rate) * rate**i / math.factorial(i) for i in range(40)])  # Poisson's distribution
    u = np.concatenate([np.random.default_rng((seed, tree, number)).random(n) for number, n in numbers])
    times = np.zeros(len(u), dtype=np.uint8)
    for edge in upto[:4]:
        times += u >= edge
    often = np.flatnonzero(times == 4)
    times[often] = np.searchsorted(upto, u[often], "right")
    return times


def counter(group: list[tuple], sets: int, d: int, dtype, n_bins: int, seed: int, rate: float | None):
    """Tasks' counts by open node, drawn feature, bin and class, for each tree of a group, in pieces of a few nodes."""
    def count(batches):
        held = []
        for bins, y, fold, numbers in chunks(batches, sets, d, dtype):  # with the place of a row's bin and class among a node's and feature's counts
            held.append((bins, bins.astype(np.int32) * 2 + y, len(y), fold, numbers))
        for tree, at_set, left_out, arrays, slots, subset in group:
            m, k = subset.shape
            wide = n_bins * 2
            out = np.zeros((m, k, wide), dtype=np.int32)
            for bins, places, n, fold, numbers in held:
                times = drawn(seed, tree, numbers, rate)
                if left_out is not None:
                    times[fold == left_out] = 0
                taken, flat, place = np.flatnonzero(times), bins[at_set].ravel(), places[at_set].ravel()
                cells, weights, found = np.empty((k, len(taken)), dtype=np.int64), np.empty(len(taken)), 0
                starts = [subset[:, j].astype(np.int64) * n for j in range(k)]
                for s in range(0, len(taken), STEP_ROWS):
                    rows = taken[s:s + STEP_ROWS]
                    slot = slots.take(walked(flat, n, rows, *arrays))
                    if m < len(slots):
                        kept = slot >= 0
                        rows, slot = rows[kept], slot[kept]
                    to, first = found + len(rows), slot * wide
                    weights[found:to] = times.take(rows)
                    for j in range(k):
                        where = starts[j].take(slot)
                        where += rows
                        np.add(first, place.take(where), out=cells[j, found:to])
                    found = to
                for j in range(k):
                    out[:, j] += np.bincount(cells[j, :found], weights[:found], m * wide).astype(np.int32).reshape(m, wide)
            pieces = range(0, m, PIECE_NODES)
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([tree] * len(pieces), pa.int32()), "piece": pa.array([s // PIECE_NODES for s in pieces], pa.int32()),
                "counts": [out[s:s + PIECE_NODES].tobytes() for s in pieces]})
    return count


def gini(n0, n1):
    n = n0 + n1
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1.0 - (n0 / n) ** 2 - (n1 / n) ** 2


def best_cuts(counts: np.ndarray, subset: np.ndarray, n_splits: np.ndarray, fewest: int):
    """Per node the first (feature, border) that lowers Gini's impurity most: (gain, feature, border, counts of both classes,
    those on the left). ``counts``: node x drawn feature x bin x class; the gain is -inf where no border may be taken."""
    m, k, n_bins, _ = counts.shape
    total = counts[:, 0].sum(axis=1)
    left = np.cumsum(counts, axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    n, nl, nr = total.sum(axis=1)[:, None, None], left.sum(axis=3), right.sum(axis=3)
    allowed = (nl >= fewest) & (nr >= fewest) & (np.arange(n_bins - 1) < n_splits[subset][:, :, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gini(total[:, 0], total[:, 1])[:, None, None] - nl / n * gini(left[..., 0], left[..., 1]) - nr / n * gini(right[..., 0], right[..., 1])
    gain = np.where(allowed, gain, -np.inf).reshape(m, -1)
    best = np.argmax(gain, axis=1)
    at, j, b = np.arange(m), best // (n_bins - 1), best % (n_bins - 1)
    return gain[at, best], subset[at, j], b, total, left[at, j, b]


def cutter(subsets: dict[int, np.ndarray], splits: dict[int, np.ndarray], n_bins: int, fewest: int):
    """A group's counts, summed, to the best border of each of its nodes."""
    def cut(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree, first = int(key[0]), int(key[1]) * PIECE_NODES
        subset = subsets[tree][first:first + PIECE_NODES]
        counts = np.zeros(subset.size * n_bins * 2)
        for part in pdf["counts"]:
            counts += np.frombuffer(part, np.int32)
        gain, f, b, total, left = best_cuts(counts.reshape(*subset.shape, n_bins, 2), subset, splits[tree], fewest)
        return pd.DataFrame({"tree": np.int32(tree), "slot": (first + np.arange(len(subset))).astype(np.int32), "gain": gain, "feature": f.astype(np.int32),
                             "border": b.astype(np.int32), "n0": total[:, 0], "n1": total[:, 1], "l0": left[:, 0], "l1": left[:, 1]})
    return cut


def subset_size(est: RandomForestClassifier, d: int) -> int:
    strategy = est.getFeatureSubsetStrategy()
    if strategy == "all" or (strategy == "auto" and est.getNumTrees() == 1):
        return d
    if strategy in ("sqrt", "auto"):
        return math.ceil(math.sqrt(d))
    raise ValueError(f"a forest's feature subsets are 'all', 'sqrt' or 'auto', not {strategy!r}")


def class_leaf(stats) -> tuple:
    n0, n1 = stats
    return float(n1 > n0), float(gini(*np.array(stats, float)[:, None])[0]), [float(n0), float(n1)], int(n0 + n1)


def fit_forests(train: DataFrame, features: list[str], label: str, est: RandomForestClassifier, fits: list[tuple[list[str], int | None]],
                fold: str | None = None) -> list[RandomForestClassificationModel]:
    """A forest a fit, with the parameters of ``est``; a fit is its features, some of ``features``, and the value of the column
    ``fold`` whose rows it leaves out (None: none)."""
    spark, d, max_bins = train.sparkSession, len(features), est.getMaxBins()
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    rows, sizes = checked_rows(train, features, label, fold, "a forest")
    left_out = list(dict.fromkeys(h for _, h in fits))
    n_of = {h: sum(n for k, n in sizes.items() if h is None or k != h) for h in left_out}
    borders = [find_borders(rows if h is None else rows.where(F.col("fold") != h), n_of[h], d, max_bins, est.getSeed()) for h in left_out]
    n_splits = [np.array([len(b) for b in one]) for one in borders]
    dtype, n_bins = np.uint8 if max_bins <= 256 else np.int32, max(2, int(max(s.max() for s in n_splits)) + 1)
    n_all, tasks = sum(sizes.values()), spark.sparkContext.defaultParallelism
    parts = max(1, min(tasks, -(-n_all // PACK_ROWS)), -(-n_all // PART_ROWS))
    packed = rows.mapInArrow(packer(borders, dtype), BLOCK_SCHEMA).repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
    rate, n_trees, seed = est.getSubsamplingRate() if est.getBootstrap() else None, est.getNumTrees(), est.getSeed() % 2**32
    rng = np.random.default_rng(seed)
    at = [[features.index(c) for c in names] for names, _ in fits]
    owner = [i for i in range(len(fits)) for _ in range(n_trees)]  # tree -> fit
    trees, opened = [Tree() for _ in owner], [[0] for _ in owner]
    try:
        for level in range(est.getMaxDepth()):
            group, cells, cuts = [], 0, []

            def passed():
                counts = packed.mapInArrow(counter(group, len(borders), d, dtype, n_bins, seed, rate), COUNT_SCHEMA)
                found = cutter({g[0]: g[5] for g in group}, {g[0]: n_splits[g[1]] for g in group}, n_bins, est.getMinInstancesPerNode())
                cuts.append(counts.repartition(tasks, "tree", "piece").groupBy("tree", "piece").applyInPandas(found, CUT_SCHEMA).toPandas())  # a row a node

            for t, nodes in enumerate(opened):
                if not nodes:
                    continue
                mine, (_, held) = np.array(at[owner[t]]), fits[owner[t]]
                subset = mine[np.sort(np.argsort(rng.random((len(nodes), len(mine))), axis=1)[:, :subset_size(est, len(mine))], axis=1)]
                size = subset.size * n_bins * 2
                if group and cells + size > PASS_CELLS:
                    passed()
                    group, cells = [], 0
                slots = np.full(len(trees[t].left), -1, dtype=np.int64)
                slots[nodes] = np.arange(len(nodes))
                feature, border, left, depth = trees[t].arrays()
                arrays = feature.astype(np.int16), np.minimum(border, 2**31 - 1).astype(np.int32), left.astype(np.int32), depth
                group.append((t, left_out.index(held), held, arrays, slots, subset))
                cells += size
            if group:
                passed()
            before, opened = opened, [[] for _ in owner]
            for c in cuts:
                for t, slot, gain, f, b, n0, n1, l0, l1 in c.sort_values(["tree", "slot"]).itertuples(index=False):
                    node, tree = before[t][slot], trees[t]
                    tree.stats[node] = (n0, n1)
                    if gain > 0 and gain >= est.getMinInfoGain():
                        for child, stats in zip(tree.split(node, f, b, gain, (l0, l1), (n0 - l0, n1 - l1)), ((l0, l1), (n0 - l0, n1 - l1))):
                            if level + 1 < est.getMaxDepth() and min(stats) > 0:
                                opened[t].append(child)
                        tree.depth = level + 1
            if not any(opened):
                break
    finally:
        packed.unpersist()

    def model(i):
        own = [t for t in range(len(trees)) if owner[t] == i]
        place = {f: p for p, f in enumerate(at[i])}
        nodes = [r for n, t in enumerate(own) for r in saved_nodes(n, trees[t], borders[left_out.index(fits[i][1])], class_leaf, place)]
        one = DecisionTreeClassifier(featuresCol=est.getFeaturesCol(), labelCol=est.getLabelCol(), maxBins=max_bins, maxDepth=est.getMaxDepth(),
                                     minInstancesPerNode=est.getMinInstancesPerNode(), seed=est.getSeed())
        path = stored_trees(spark, est, "classification.RandomForestClassificationModel", one, "classification.DecisionTreeClassificationModel",
                            {"numFeatures": len(at[i]), "numClasses": 2}, nodes, [1.0] * len(own))
        return RandomForestClassificationModel.load(path)

    return [model(i) for i in range(len(fits))]
