"""Rows walk down trees in steps, and the draws of a forest are Poisson counts by their thresholds."""

import math

import numpy as np
import pytest

from cohortlab.models import forest, gradient


@pytest.mark.parametrize("dtype", [np.uint8, np.int32])
def test_walk_in_steps(monkeypatch, dtype):
    monkeypatch.setattr(gradient, "STEP_ROWS", 7)
    rng = np.random.default_rng(6)
    bins = rng.integers(0, 256, (3, 50)).astype(dtype)
    bins[:, 0] = 255  # the last bin does not go right of a leaf
    tree = gradient.Tree()
    left, right = tree.split(0, 1, 120, 1.0, (1, 1), (1, 1))
    tree.split(right, 2, 30, 1.0, (1, 1), (1, 1))
    tree.depth = 2
    want = [left if a <= 120 else 3 if b <= 30 else 4 for a, b in zip(bins[1], bins[2])]
    assert gradient.nodes_of(bins, *tree.arrays()).tolist() == want
    some = np.array([0, 9, 49])
    assert gradient.walked(bins.ravel(), 50, some, *tree.arrays()).tolist() == [want[i] for i in some]


def test_draws():
    numbers = [(0, 30_000), (5, 10)]
    u = np.concatenate([np.random.default_rng((42, 3, k)).random(n) for k, n in numbers])
    upto = np.cumsum([math.exp(-1.0) / math.factorial(i) for i in range(40)])
    got = forest.drawn(42, 3, numbers, 1.0)
    assert got.dtype == np.uint8 and got.max() > 4 and (got == np.searchsorted(upto, u, "right")).all()
    assert forest.drawn(42, 3, numbers, None).sum() == 30_010
