"""Stumps against a plain search over all thresholds, whatever the number of buckets."""

import math

import numpy as np
import pytest

from cohortlab.models import boosting
from cohortlab.models.classifiers import fit_adaboost


def brute(x, y, rounds):
    w, out = np.ones(len(y)), []
    for _ in range(rounds):
        t, best = [w[y == k].sum() for k in (0, 1)], None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for a, b in zip(values, values[1:]):
                left = x[:, f] <= a
                l0, l1 = w[left & (y == 0)].sum(), w[left & (y == 1)].sum()
                g = round(float(boosting.impurity(l0, l1, *t)), boosting.DIGITS)
                if best is None or (g, f, (a + b) / 2) < best[:3]:
                    best = (g, f, (a + b) / 2, l0, l1)
        _, f, thr, l0, l1 = best
        left, right = int(l1 > l0), int(t[1] - l1 > t[0] - l0)
        miss = np.where(x[:, f] <= thr, left, right) != y
        err = w[miss].sum() / w.sum()
        out.append((f, thr, left, right, math.log((1 - err) / err)))
        w = w * np.exp(out[-1][4] * miss)
    return out


@pytest.mark.parametrize("buckets", [4, 32, 4096])
def test_stumps_against_all_thresholds(spark, buckets):
    rng = np.random.default_rng(8)
    n = 700
    x = np.stack([rng.normal(size=n), rng.integers(0, 6, n), np.round(rng.exponential(size=n), 1), np.ones(n)], axis=1)
    y = ((x[:, 0] + 0.4 * x[:, 1] + rng.normal(size=n) > 1) ^ (rng.random(n) < 0.1)).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, `c d` double, one double, target int")
    stumps, alphas = boosting.fit_stumps(df, ["a", "b", "c d", "one"], "target", 6, 1.0, buckets=buckets)
    for got, a, want in zip(stumps, alphas, brute(x, y, 6)):
        assert got[0] == want[0] and got[1] == pytest.approx(want[1]) and got[2:] == want[2:4] and a == pytest.approx(want[4])


def test_nothing_to_cut(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (1.0, 1)], "a double, target int")
    f = fit_adaboost(df, ["a"])
    assert f.extra["stumps"][0] == (None, None, 0, 0) and f.transform(df).where("pred <> 0").count() == 0
    pure = spark.createDataFrame([(1.0, 0), (2.0, 1)], "a double, target int")
    assert fit_adaboost(pure, ["a"]).extra["stumps"] == [(0, 1.5, 0, 1)]


def test_votes_by_bucket():
    low, high = [np.array([0.0, 2.0, 5.0]), np.array([1.0])], [np.array([1.0, 4.0, 6.0]), np.array([1.0])]
    stumps, alphas = [(0, 1.5, 0, 1), (0, 3.0, 1, 0), (0, 3.5, 0, 1), (None, None, 1, 1), (1, 1.5, 0, 1)], [0.5, 1.0, 0.25, 2.0, 4.0]
    x = np.array([[0.5, 1], [2.0, 1], [3.0, 1], [3.2, 1], [4.0, np.nan], [5.5, 1], [np.nan, 1]])
    voted = boosting.votes(stumps, alphas, low, high)
    assert {c[:3] for c in voted[1]} == {(0, 1, 3.0), (0, 1, 3.5)}  # only the bucket that holds the threshold needs values
    at = {f: np.searchsorted(high[f], x[:, f], "left") for f in (0, 1)}
    for label in (0, 1):
        miss = np.zeros(len(x))
        for (f, t, left, right), a in zip(stumps, alphas):
            miss += a * ((np.full(len(x), left) if f is None else np.where(x[:, f] <= t, left, right)) != label)
        got = boosting.row_weights(at, {0: x[:, 0]}, np.full(len(x), label), alphas, voted)
        assert got == pytest.approx(np.exp(miss))


def test_rows_are_placed_once(spark, monkeypatch):
    kept, plain = {}, boosting.stored
    monkeypatch.setattr(boosting, "stored", lambda df, stem: kept.setdefault(stem, plain(df, stem)))
    df = spark.createDataFrame([(float(i % 9), None if i % 4 == 0 else float(i), int(i % 9 > 3)) for i in range(60)], "a double, b double, target int")
    stumps, _ = boosting.fit_stumps(df, ["a", "b"], "target", 3, 1.0)
    assert stumps == [(0, 3.5, 0, 1)] and {"b0", "b1"} <= set(kept["boosting-rows"].columns)


@pytest.mark.parametrize("collected", [0, 10_000])
def test_rounds_read_packed_blocks(spark, monkeypatch, collected):
    monkeypatch.setattr(boosting, "PACK_ROWS", 100)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 150)
    monkeypatch.setattr(boosting, "COLLECTED_VALUES", collected)
    rng = np.random.default_rng(4)
    x = np.stack([rng.normal(size=600), rng.integers(0, 5, 600)], axis=1)
    y = ((x[:, 0] + 0.3 * x[:, 1] + rng.normal(size=600) > 0.6)).astype(int)
    data = [(*map(float, r), int(v)) for r, v in zip(x, y)]
    odd = [(0.1, 2.0, 7), (0.2, 1.0, None)]  # no class: no weight, but their values are borders
    df = spark.createDataFrame(data + odd, "a double, b double, target int").repartition(3)
    stumps, alphas = boosting.fit_stumps(df, ["a", "b"], "target", 5, 1.0, buckets=8)
    for got, a, want in zip(stumps, alphas, brute(x, y, 5)):
        assert got[0] == want[0] and got[1] == pytest.approx(want[1], abs=0.2) and got[2:] == want[2:4] and a == pytest.approx(want[4])
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    empty = boosting.fit_stumps(df.limit(0), ["a", "b"], "target", 3, 1.0)
    assert empty == ([(None, None, 0, 0)], [1.0])
    missing = df.union(spark.createDataFrame([(None, 1.0, 0), (float("nan"), 1.0, 1)], df.schema))
    assert len(boosting.fit_stumps(missing, ["a", "b"], "target", 3, 1.0)[0]) == 3
