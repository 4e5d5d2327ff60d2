"""Whitening of embeddings: principal components by FEAST contour integration.

Method. Entries c become long x = floor(64 c) + 1,000,000. One pass sums them exactly, a second sums the products of the
centred rows (every row is moved by the exact mean S/n before it is multiplied), so the driver sees one d x d covariance V
and never a row. Its spectrum is sliced: Sturm sequences of the tridiagonal form of V count the eigenvalues below any shift
(inertia), bisection on those counts places the cuts in gaps, and every slice becomes a row of a Spark job. There FEAST
solves it: Gauss-Legendre quadrature on a circle around the slice sums the solutions of the complex shifted systems
(zI - V) Q = Y, which projects Y onto the eigenvectors inside; Rayleigh-Ritz on that subspace gives values and vectors,
and both steps are repeated until the residuals vanish. A slice must return as many pairs as its inertia counts say, so
none is missed or found twice. A last Rayleigh-Ritz over all slices makes the vectors orthogonal across the cuts.

Bounds. d x d doubles in a task and on the driver (the dimension of the embedding, not of the table) and one row a task and
dimension in the sums' shuffle. Sums are exact in 64 bits up to 9e12 rows of entries around zero.

Defined cases: rows whose vector is null, empty, or holds a null, NaN or infinite entry are dropped, and so are entries
beyond 2**40, whose x would not be exact; rows stay whatever their key (null, repeated). Vectors of other lengths than the
most frequent one (the longest at a tie) have no common covariance with it and are dropped. Components whose eigenvalue
is lost in the rounding of V (constant or repeated vectors) are not returned, so a table without spread gives empty
``whitened`` arrays. A deviation beyond a long is null. Columns whose names clash with the new ones get a trailing ``_in``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.llm.common import col, keep_clashes, ready

SCALE, OFFSET, LARGEST = 64.0, 1_000_000, 2.0**40


@dataclass
class Whitening:
    """n and sums S of the fit list, eigenvalues (falling), unit eigenvectors (columns) and the trace of V."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


# ------------------------------------------------------------------ spectrum

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of the tridiagonal matrix that Householder reflections make of a symmetric one."""
    a = np.array(v, float)
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if size == 0.0:
            continue
        x[0] += size if x[0] >= 0 else -size
        x /= np.linalg.norm(x)
        block = a[k + 1:, k + 1:]
        p = block @ x
        p -= (x @ p) * x
        block -= 2 * np.outer(x, p) + 2 * np.outer(p, x)
        a[k + 1:, k] -= 2 * x * (x @ a[k + 1:, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(tri: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift: the positive pivots of T - shift (its inertia)."""
    diagonal, off = tri
    shifts = np.atleast_1d(np.asarray(shifts, float))
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, pivot = np.zeros(len(shifts), int), np.ones(len(shifts))
    for i, a in enumerate(diagonal):
        pivot = a - shifts - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot > 0
    return count


def _floor(tri: tuple[np.ndarray, np.ndarray], top: float) -> tuple[float, int]:
    """A shift above the rounding of V, in the widest gap there, and how many eigenvalues lie above it."""
    tries = top * len(tri[0]) * np.finfo(float).eps * 2.0 ** np.arange(3, 14)
    counts = above(tri, tries)
    rank, runs = np.unique(counts, return_counts=True)
    best = int(rank[runs.argmax()])
    at = np.flatnonzero(counts == best)
    return float(tries[at[len(at) // 2]]), best


def slices(v: np.ndarray, k: int, width: int = 6) -> tuple[list[tuple[float, float, int]], int]:
    """Intervals (low, high, eigenvalues inside) that hold at least the ``k`` largest eigenvalues above rounding, and
    their number. Cuts lie in the widest gaps that leave at most ``width`` values to a slice; values that tie stay
    together, whatever their number."""
    tri = tridiagonal(v)
    off = np.concatenate([[0.0], np.abs(tri[1]), [0.0]])
    top = float((tri[0] + off[:-1] + off[1:]).max())
    if top <= 0:
        return [], 0
    noise, rank = _floor(tri, top)
    k = min(k, rank)
    if not k:
        return [], 0
    seek = min(rank, k + width)
    while True:
        low, high = np.full(seek, noise), np.full(seek, top * (1 + 1e-12))
        for _ in range(60):  # all eigenvalues at once
            mid = (low + high) / 2
            over = above(tri, mid) > np.arange(seek)
            low, high = np.where(over, mid, low), np.where(over, high, mid)
        values = np.minimum.accumulate((low + high) / 2)
        gaps = values[:-1] - values[1:]
        ends = np.flatnonzero(gaps > noise) + 1
        gaps = gaps[ends - 1]
        if seek == rank:
            ends, gaps = np.append(ends, rank), np.append(gaps, values[-1])
        if len(ends) and ends[-1] >= k:
            break
        seek = min(rank, 2 * seek)  # ties reach beyond what was sought
    out, start, edge = [], 0, float(values[0] * 1.1)
    while start < k:
        near = (ends > start) & (ends <= start + width)
        if (near & (ends >= k)).any():
            near &= ends >= k
        end = int(ends[near][gaps[near].argmax()]) if near.any() else int(ends[ends > start][0])
        cut = noise if end == rank else float(values[end - 1] + values[end]) / 2
        # no wider above its values than below them: the filter of a wide slice hardly tells apart what lies close to one end
        upper = min(edge, float(values[start]) + max(float(values[end - 1]) - cut, 1e-6 * top))
        got = above(tri, [cut, upper])
        out.append((cut, upper, int(got[0] - got[1])))
        start, edge = end, cut
    return out, k


def feast(v: np.ndarray, low: float, high: float, inside: int, points: int = 8, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``inside`` eigenpairs of ``v`` between ``low`` and ``high``, falling."""
    d = len(v)
    size = min(d, 2 * inside + 8)
    y = np.random.default_rng(d).standard_normal((d, size))
    nodes, weights = np.polynomial.legendre.leggauss(points)
    turn = np.exp(-1j * np.pi / 2 * (nodes - 1))  # the upper half circle; the lower one is its conjugate
    middle, radius = (low + high) / 2, (high - low) / 2
    unit, goal = np.eye(d), d * np.finfo(float).eps * np.abs(v).sum(axis=1).max()
    best = None
    for _ in range(rounds):
        q = np.zeros((d, size))
        for t, w in zip(turn, weights):
            q += w / 2 * (radius * t * np.linalg.solve((middle + radius * t) * unit - v, y)).real
        q, _ = np.linalg.qr(q)
        values, small = np.linalg.eigh(q.T @ v @ q)
        y = q @ small
        error = np.linalg.norm(v @ y - y * values, axis=0)
        chosen = np.flatnonzero((values > low) & (values < high) & (error < (high - low) / 4))
        if len(chosen) == inside:
            worst = float(error[chosen].max(initial=0.0))
            if best is None or worst < best[0]:
                best = (worst, values[chosen][::-1], y[:, chosen][:, ::-1])
            elif best[0] <= goal:
                break  # at the limit of rounding
    if best is None or best[0] > 1e3 * goal:
        raise RuntimeError(f"the slice ({low}, {high}) did not give its {inside} eigenpairs")
    return best[1], best[2]


def eigenpairs(spark, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues above rounding and their vectors; every slice is solved in a task of its own."""
    cuts, k = slices(v, k)
    if not k:
        return np.zeros(0), np.zeros((len(v), 0))
    given = spark.sparkContext.broadcast(v)  # d x d: bounded by the dimension

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, low, high, inside in batch.itertuples(index=False):
                values, vectors = feast(given.value, low, high, int(inside))
                yield pd.DataFrame({"at": [at] * len(values), "value": values, "vector": list(vectors.T)})

    rows = [(i, a, b, n) for i, (a, b, n) in enumerate(cuts) if n]
    todo = spark.createDataFrame(rows, "at int, low double, high double, inside int").repartition(len(rows), "at")
    found = todo.mapInPandas(solve, "at int, value double, vector array<double>").collect()
    found.sort(key=lambda r: (r.at, -r.value))
    if len(found) != sum(n for _, _, n in cuts):
        raise RuntimeError("inertia counts and eigenpairs differ")
    q, _ = np.linalg.qr(np.array([r.vector for r in found]).T)
    values, small = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], q @ small[:, order]


# ------------------------------------------------------------------ passes over the rows

def _vectors(array: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, x as long matrix) for every length among the good vectors of a list column."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False)
    flat = array.flatten()
    entries = pc.fill_null(pc.cast(flat, pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    scaled = np.floor(entries * SCALE)
    bad = np.concatenate([[0], np.cumsum(~(np.abs(scaled) <= LARGEST))])
    good = (sizes > 0) & (bad[ends] == bad[ends - sizes])
    for d in np.unique(sizes[good]):
        at = np.flatnonzero(good & (sizes == d))
        yield int(d), at, scaled[(ends[at] - d)[:, None] + np.arange(d)].astype(np.int64) + OFFSET


def sums(df: DataFrame, vector: str) -> tuple[int, np.ndarray]:
    """Rows and exact sums by dimension of the vectors of the most frequent length."""
    def task(batches):
        held = {}

        def rows():
            made = pa.RecordBatch.from_pylist([{"d": d, "n": n, "s": s.tolist()} for d, (n, s) in held.items()], schema=kind)
            held.clear()
            return made

        kind = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))])
        for batch in batches:
            for d, at, x in _vectors(batch.column(0)):
                n, s = held.get(d, (0, 0))
                held[d] = (n + len(at), s + x.sum(axis=0))
            if len(held) > 64:
                yield rows()
        if held:
            yield rows()

    parts = df.select(col(vector)).mapInArrow(task, "d int, n long, s array<long>").select("d", "n", F.posexplode("s"))
    most = (parts.groupBy("d", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("s"))
            .groupBy("d").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "s"))).alias("s"))
            .orderBy(F.desc("n"), F.desc("d")).first())
    return (most.n, np.array([x.s for x in most.s], np.int64)) if most else (0, np.zeros(0, np.int64))


def covariance(df: DataFrame, vector: str, n: int, total: np.ndarray, basis: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of x, or of the centred x projected on ``basis``. Rows are centred, then multiplied."""
    d, k = len(total), len(total) if basis is None else basis.shape[1]

    def task(batches):
        c = np.zeros((k, k))
        seen = False
        for batch in batches:
            for size, _, x in _vectors(batch.column(0)):
                if size == d:
                    y = _centred(x, n, total)
                    y = y if basis is None else y @ basis
                    c, seen = c + y.T @ y, True
        if seen:
            i, j = np.tril_indices(k)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(c[i, j])], names=["i", "j", "c"])

    got = df.select(col(vector)).mapInArrow(task, "i int, j int, c double").groupBy("i", "j").agg(F.sum("c").alias("c")).toPandas()
    out = np.zeros((k, k))
    out[got["i"], got["j"]] = out[got["j"], got["i"]] = got["c"].to_numpy(float) / n
    return out


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x - S/n: whole and fractional part of the mean apart, so nothing but the last rounding is lost."""
    whole = total // n
    return (x - whole) - (total - whole * n) / n


def _deviation(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Exact sum of (n x - S)^2 by row; None beyond a long."""
    whole = total // n
    rest = total - whole * n  # n x - S = n (x - whole) - rest
    far = x - whole
    reach = (float(np.abs(far).max(initial=0)) + 1) * float(n)
    if reach * reach * max(1, x.shape[1]) < 2.0**62:
        y = far * n - rest
        return (y * y).sum(axis=1).tolist()
    exact = (sum((int(a) * n - int(b)) ** 2 for a, b in zip(row, rest)) for row in far)
    return [v if v < 2**63 else None for v in exact]


def fit(df: DataFrame, vector: str = "embedding", components: int = 32) -> Whitening:
    """Fit on all good vectors (two passes)."""
    spark = df.sparkSession
    ready(spark)
    n, total = sums(df, vector)
    if not n:
        return Whitening(0, total, np.zeros(0), np.zeros((0, 0)), 0.0)
    v = covariance(df, vector, n, total)
    values, vectors = eigenpairs(spark, v, components)
    return Whitening(n, total, values, vectors, float(np.trace(v)))


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest entry of the covariance of the whitened rows less the identity, measured in a pass over all rows. Their
    mean is zero as the rows are centred by the exact mean of the same list."""
    k = len(model.values)
    if not k:
        return 0.0
    c = covariance(df, vector, model.n, model.sums, model.vectors / np.sqrt(model.values))
    return float(np.abs(c - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening, vector: str = "embedding", whitened: str = "whitened",
           deviation: str = "deviation") -> DataFrame:
    """Good rows with all their columns, their whitened components (array, falling eigenvalue) and their deviation."""
    ready(df.sparkSession)
    df, taken = keep_clashes(df, whitened, deviation)
    vector = taken.get(vector, vector)
    d, n, total, at = len(model.sums), model.n, model.sums, df.columns.index(vector)
    basis = model.vectors / np.sqrt(model.values) if len(model.values) else np.zeros((d, 0))
    schema = T.StructType([*df.schema.fields, T.StructField(whitened, T.ArrayType(T.DoubleType())), T.StructField(deviation, T.LongType())])

    def task(batches):
        for batch in batches:
            for size, rows, x in _vectors(batch.column(at)):
                if size != d:
                    continue
                w = _centred(x, n, total) @ basis
                k = w.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(rows) + 1) * k, k) if k else np.zeros(len(rows) + 1), pa.int32()), pa.array(w.ravel()))
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*kept.columns, lists, pa.array(_deviation(x, n, total), pa.int64())], names=schema.names)

    return df.mapInArrow(task, schema)
