"""A linear SVM over random Fourier features (C3) of many rows: Newton steps on a smoothed hinge loss.

The problem is that of Spark's ``LinearSVC``: mean hinge loss plus half of ``regParam`` times the squared coefficients of the
features divided by their sample deviations, intercept without penalty; the model comes back as its class. LinearSVC keeps all
features (2 KB a row with 256 of them) and reads them in each of its steps, often until ``maxIter``. Here only the rows that
they come from are kept, packed into blocks (8 bytes a column and one for the label); a pass makes the features of a few
rows at a time and forgets them.

The kink of the hinge is rounded over a band of margins 1 - h to 1 + h. A step is one pass that sums gradient and
second derivatives (of the rows in the band) and the loss along the step; the driver sees one features x features matrix. A full
step halves the band from then on, a step that does not lower the loss is shortened. The end is LinearSVC's: the (unrounded)
loss falls by less than the tolerance, here on a narrow band, or ``maxIter`` steps. So the loss is not above LinearSVC's, which
is still falling where it stops at ``maxIter``; coefficients differ from its by that.

Missing or infinite features, labels other than 0 and 1, and a table without rows are errors, as they are in Spark.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame

from cohortlab.models.gradient import EPSILON, PACK_ROWS, added, checked_rows
from cohortlab.session import ensure_checkpoint_dir, ship_package

CHUNK_ROWS = 1_024
PART_ROWS = 4_194_304    # rows of a task at most
NARROW, NARROWEST = 1 / 32, 1 / 2_048    # half widths of the band: from which on the tolerance ends the steps, and the last one
CONSTANT = 1e-14         # a feature with a smaller share of variance in its squares has none
SHORTER = 0.5 ** np.arange(12)
SINE = [(-1) ** i * (2 * math.pi) ** (2 * i + 1) / math.factorial(2 * i + 1) for i in range(9)]


def cosines(turns: np.ndarray) -> np.ndarray:
    """cos(2 pi turns) within 1e-13, in place: a few products are cheaper than numpy's cosine."""
    a = np.rint(turns)
    a -= turns
    np.abs(a, out=a)
    np.subtract(0.25, a, out=a)     # the cosine is the sine of what is left to a quarter turn
    square = np.multiply(a, a, out=turns)
    out = np.full_like(a, SINE[-1])
    for c in SINE[-2::-1]:
        out *= square
        out += c
    out *= a
    return out


class Features:
    """Cosines of random projections (w, b) of the rows of ``x``, without their common factor."""

    def __init__(self, w: np.ndarray, b: np.ndarray):
        self.w, self.b, self.scale = np.ascontiguousarray(w.T) / (2 * math.pi), b / (2 * math.pi), math.sqrt(2.0 / len(b))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        turns = x @ self.w
        turns += self.b
        return cosines(turns)

    def margins(self, x: np.ndarray, coefficients: np.ndarray, intercept: float) -> np.ndarray:
        """Decision values of a linear model over the features."""
        c = coefficients * self.scale
        return np.concatenate([self(x[i:i + CHUNK_ROWS]) @ c for i in range(0, len(x), CHUNK_ROWS)] or [np.zeros(0)]) + intercept


def packer(d: int):
    """Arrow batches of (features, label) to blocks of rows and labels -1 / 1."""
    def block(tables):
        t = pa.Table.from_batches(tables)
        x = np.stack([t.column(f"f{i}").to_numpy() for i in range(d)], axis=1)
        return pa.RecordBatch.from_pydict({"x": [x.tobytes()], "y": [(2.0 * t.column("y").to_numpy() - 1.0).astype(np.int8).tobytes()]})

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


def rounded_hinge(short: np.ndarray, h: float) -> np.ndarray:
    """The loss of rows whose margins are ``short`` of 1."""
    inside = np.clip(short + h, 0.0, 2 * h)
    return inside * inside / (4 * h) + np.maximum(short - h, 0.0)


def summer(features: Features, d: int, model: np.ndarray, step: np.ndarray, h: float, next_h: float):
    """A partition's sums at ``model`` (coefficients of the features, intercept): losses along the step that led there (in whole, half,
    ...; band h), hinge loss, and for the band next_h the loss, the gradient and the second derivatives (of the rows in the band)."""
    def sums(blocks):
        k = len(model)
        losses, ends, grad, second = np.zeros(len(SHORTER)), np.zeros(2), np.zeros(k), np.zeros((k, k))
        for r in blocks:
            x, labels = np.frombuffer(r.x).reshape(-1, d), np.frombuffer(r.y, np.int8).astype(float)
            for i in range(0, len(x), CHUNK_ROWS):
                z, y = features(x[i:i + CHUNK_ROWS]), labels[i:i + CHUNK_ROWS]
                short = 1.0 - y * (z @ model[:-1] + model[-1])
                back = y * (z @ step[:-1] + step[-1])
                losses += [rounded_hinge(short + (1 - t) * back, h).sum() for t in SHORTER]
                ends += np.maximum(short, 0.0).sum(), rounded_hinge(short, next_h).sum()
                pull = np.clip((short + next_h) / (2 * next_h), 0.0, 1.0) * y
                grad[:-1] -= pull @ z
                grad[-1] -= pull.sum()
                band = z[np.abs(short) <= next_h]
                second[:-1, :-1] += band.T @ band
                second[-1, :-1] += band.sum(axis=0)
                second[-1, -1] += len(band)
        second[:-1, -1] = second[-1, :-1]
        yield np.concatenate([losses, ends, grad, second.ravel()])
    return sums


def moments(features: Features, d: int):
    """A partition's sums of the features and of their squares."""
    def sums(blocks):
        total = np.zeros((2, len(features.b)))
        for r in blocks:
            x = np.frombuffer(r.x).reshape(-1, d)
            for i in range(0, len(x), CHUNK_ROWS):
                z = features(x[i:i + CHUNK_ROWS])
                total += z.sum(axis=0), np.einsum("ij,ij->j", z, z)
        yield total
    return sums


def minimise(passed, n: int, mean: np.ndarray, std: np.ndarray, reg: float, steps: int, tolerance: float) -> tuple[np.ndarray, list[float]]:
    """The model over the features as they are, and the objective before and after each step. ``passed``: (model, step, h, next h) to the
    sums of all rows. Steps are taken over features less their mean and divided by their deviation; those without any have no part."""
    used = std > 0
    scale = np.where(used, 1.0 / np.where(used, std, 1.0), 0.0)
    k = len(mean) + 1
    to = np.zeros((k, k))                     # coefficients of the scaled features to a model over the features as they are
    to[np.arange(k - 1), np.arange(k - 1)], to[-1, :-1], to[-1, -1] = scale, -mean * scale, 1.0
    penalty = np.append(np.where(used, reg, 0.0), 0.0)

    def at(theta, step, h, next_h):
        sums, m = passed(to @ theta, to @ step, h, next_h) / n, len(SHORTER)
        costs = [0.5 * (penalty * (theta - (1 - t) * step) ** 2).sum() for t in SHORTER]
        hinge, loss = sums[m:m + 2] + costs[0]
        second = to.T @ sums[m + 2 + k:].reshape(k, k) @ to / (2 * next_h) + np.diag(penalty)
        return sums[:m] + costs, hinge, loss, to.T @ sums[m + 2:m + 2 + k] + penalty * theta, second

    h, theta, still = 1.0, np.zeros(k), np.zeros(k)
    _, hinge, loss, grad, second = at(theta, still, h, h)
    best, history = theta, [hinge]
    for _ in range(steps):
        second[np.diag_indices(k)] += 1e-10 * np.trace(second) / k + EPSILON
        step = -np.linalg.solve(second, grad)
        slope, narrower = float(grad @ step), max(h / 2, NARROWEST)
        found = at(theta + step, step, h, narrower)
        if found[0][0] > loss + 1e-4 * slope and -slope > tolerance * loss:  # too far: where the loss is lowest along the step
            t = SHORTER[np.argmin(found[0])] if found[0].min() < loss else 0.0
            step, narrower = t * step, h if t else narrower
            found = at(theta + step, step, h, narrower)
        theta = theta + step
        _, hinge, loss, grad, second = found
        fell = min(history) - hinge
        if fell > 0:
            best = theta
        history.append(hinge)
        if h <= NARROW and fell <= tolerance * abs(hinge):
            break
        h = narrower
    return to @ best, history


def fit_hinge(train: DataFrame, features: list[str], label: str, made: Features, est: LinearSVC) -> tuple[LinearSVCModel, list[float]]:
    """LinearSVC's model with the parameters of ``est`` over ``made`` of the features, and the objective before and after each step."""
    spark, d = train.sparkSession, len(features)
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    rows, sizes = checked_rows(train, features, label, None, "a linear SVM")
    n = sum(sizes.values())
    parts = max(1, min(-(-n // PACK_ROWS), max(spark.sparkContext.defaultParallelism, -(-n // PART_ROWS))))
    blocks = rows.mapInArrow(packer(d), "x binary, y binary").repartition(parts).rdd.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total, squares = added(blocks.mapPartitions(moments(made, d)))
        mean = total / n
        var = np.maximum(squares - n * mean * mean, 0.0) / max(n - 1, 1)
        std = np.where(var > CONSTANT * squares / n, np.sqrt(var), 0.0)
        model, history = minimise(lambda m, step, h, after: added(blocks.mapPartitions(summer(made, d, m, step, h, after))),
                                  n, mean, std, est.getRegParam(), est.getMaxIter(), est.getTol())
    finally:
        blocks.unpersist()
    java = spark.sparkContext._jvm.org.apache.spark.ml.classification.LinearSVCModel(
        est.uid, _py2java(spark.sparkContext, DenseVector(model[:-1] / made.scale)), float(model[-1]))
    return est._copyValues(LinearSVCModel(java)), history
