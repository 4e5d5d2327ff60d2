"""FEAST against numpy's eigenvalues, inertia counts, exact deviations and odd rows."""

import numpy as np
import pytest

import __spark_entry__ as entry
from cohortlab.llm import whitening as w
from llm_samples import SF, needs_data


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * values) @ q.T


SPECTRA = {"even": np.linspace(1, 40, 40), "bulk": np.r_[90, 70, 50, np.linspace(1, 1.4, 50)], "ties": np.r_[[5.0] * 20, [3.0] * 20, [1.0] * 8],
           "wide": 10.0 ** np.arange(-6, 6), "low rank": np.r_[np.zeros(30), 1, 2, 3], "one": np.array([7.0]), "two": np.array([2.0, 1.0]),
           "equal": np.ones(12), "zero": np.zeros(9)}


@pytest.mark.parametrize("name", SPECTRA)
def test_eigenpairs_against_numpy(spark, name):
    v = symmetric(SPECTRA[name])
    true = np.sort(np.linalg.eigvalsh(v))[::-1]
    values, vectors = w.eigenpairs(spark, v, 32)
    real = int((true > max(true[0], 0) * len(v) * 2e-15).sum())
    assert len(values) == min(32, real)
    scale = max(1e-300, abs(true[0]))
    assert np.abs(values - true[:len(values)]).max(initial=0) < 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-13
    assert np.abs(v @ vectors - vectors * values).max(initial=0) < 1e-13 * scale


def test_inertia_counts():
    v = symmetric(SPECTRA["bulk"], 3)
    tri, true = w.tridiagonal(v), np.linalg.eigvalsh(v)
    shifts = np.linspace(-1, 100, 333)
    assert (w.above(tri, shifts) == [(true > s).sum() for s in shifts]).all()


def plain(rows):
    """x, n, S and exact deviations in Python's integers."""
    good = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    n, s = len(good), [sum(c) for c in zip(*(x for _, x in good))]
    return good, n, s, [sum((n * a - b) ** 2 for a, b in zip(x, s)) for _, x in good]


def test_rows_against_plain_python(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(6) * [9, 5, 3, 2, 1, .5]).tolist()) for i in range(300)]
    rows += [(None, rows[0][1]), (7, rows[7][1]), (400, None), (401, []), (402, [1.0] * 5 + [None]), (403, [float("nan")] * 6),
             (404, [float("inf")] + [0.0] * 5), (405, [1.0] * 3)]
    df = spark.createDataFrame([(i, v, "kept", 1.5) for i, v in rows], "vec_id long, embedding array<double>, label string, Whitened double").repartition(5)
    good, n, s, deviations = plain(rows[:-1])
    m = w.fit(df)
    assert (m.n, m.sums.tolist()) == (n, s)
    x = np.array([v for _, v in good]) - 1_000_000.0
    true = np.linalg.eigh(np.cov(x.T, bias=True))
    assert np.allclose(m.values, true[0][::-1], rtol=1e-12)
    assert np.allclose(np.abs((m.vectors * true[1][:, ::-1]).sum(axis=0)), 1, atol=1e-12)
    assert w.identity_error(df, m) < 1e-10
    got = w.whiten(df, m).collect()
    assert got[0].asDict().keys() == {"vec_id", "embedding", "label", "Whitened_in", "whitened", "deviation"}
    assert sorted((r.vec_id or -1, r.deviation) for r in got) == sorted((i or -1, d) for (i, _), d in zip(good, deviations))
    c = np.array([r.whitened for r in got])
    assert np.abs(np.cov(c.T, bias=True) - np.eye(6)).max() < 1e-10 and all(r.Whitened_in == 1.5 for r in got)


def test_deviations_beyond_a_long():
    x = np.array([[1_000_001, 999_991], [1_000_000, 1_000_000]])
    n = 10**9
    s = np.array([n * 1_000_000 + 3, n * 999_990 + 7])
    true = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    assert w._deviation(x, n, s) == [true[0], None] and true[0] < 2**63 < true[1]


def test_tables_without_spread(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25])], "vec_id long, embedding array<float>")
    for df, n in ((one, 1), (one.union(one), 2), (one.where("vec_id = 2"), 0)):
        m = w.fit(df)
        assert m.n == n and len(m.values) == 0 and w.identity_error(df, m) == 0.0
        assert [(r.whitened, r.deviation) for r in w.whiten(df, m).collect()] == [([], 0)] * n


@needs_data
def test_query(spark):
    got = entry.queries()["op11_whitening"](spark, SF).toPandas()
    raw = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(64 * np.array([r.embedding for r in raw], float)) + 1_000_000
    v = np.cov(x.T, bias=True)
    values, vectors = np.linalg.eigh(v)
    k = min(32, int((values > values[-1] * 1e-12).sum()))
    assert set(got["component"]) == set(range(1, k + 1)) and len(got) == k * len(raw)
    true = (x - x.mean(axis=0)) @ vectors[:, ::-1][:, :k] / np.sqrt(values[::-1][:k])
    mine = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    mine = mine * np.sign((mine * true).sum(axis=0))
    assert np.abs(mine - true).max() < 1e-6 and got["identity_error"].max() < 1e-9
    share = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(share, values[::-1][:k] / v.trace(), rtol=1e-9)
