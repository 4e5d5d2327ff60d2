"""The pruned search against all pairs: ties, hot points, clusters, few rows, blocks; and the distances that it saves."""

import numpy as np
import pytest

from cohortlab.models import knn


def brute(x, tid, y, queries, k):
    out = {}
    for qid, p in queries:
        d = np.zeros(len(x))
        for j in range(x.shape[1]):
            d += (p[j] - x[:, j]) ** 2
        d = np.sqrt(d)
        best = np.lexsort((tid, d))[:k]
        out[qid] = [(float(d[b]), int(tid[b]), int(y[b])) for b in best]
    return out


def clustered(rng, n, width=3):
    return rng.normal(size=(8, width))[rng.integers(0, 8, n)] * 20 + rng.normal(size=(n, width))


CASES = {"clusters": lambda r: clustered(r, 1500), "grid with ties": lambda r: r.integers(0, 4, (900, 3)).astype(float),
         "one point": lambda r: np.ones((400, 2)), "hot point": lambda r: np.concatenate([np.zeros((500, 3)), r.normal(size=(700, 3))]),
         "few rows": lambda r: r.normal(size=(3, 2)), "no rows": lambda r: np.zeros((0, 2))}


@pytest.mark.parametrize("name", CASES)
def test_against_all_pairs(spark, name):
    rng = np.random.default_rng(11)
    x = CASES[name](rng)
    tid, y = rng.permutation(len(x)) + 10, rng.integers(0, 2, len(x))
    asked = np.concatenate([x[:60], (x[:40] if len(x) else np.zeros((5, 2))) + rng.normal(size=(min(40, len(x)) or 5, x.shape[1]))])
    width = x.shape[1]
    names = [f"f {j}" for j in range(width)]
    schema = ", ".join(f"`{c}` double" for c in names)
    train = spark.createDataFrame([(int(i), int(v), *map(float, p)) for i, v, p in zip(tid, y, x)] + [(9_999, 1, *[None] * width)], f"id long, label int, {schema}")
    queries = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(asked)] + [(8_888, *[None] * width)], f"id long, {schema}")
    got = {}
    for r in knn.knn_candidates(train, queries, names, "label", "id", "id", k=5, block_rows=150).collect():
        got.setdefault(r.qid, []).append((r.d, r.tid, r.y))
    want = {i: v for i, v in brute(x, tid, y, list(enumerate(asked)), 5).items() if v}
    assert {i: sorted(v) for i, v in got.items()} == want


def test_fewer_distances_than_pairs(spark):
    rng = np.random.default_rng(3)
    x, asked = clustered(rng, 6000), clustered(rng, 400)
    train = spark.createDataFrame([(i, i % 2, *map(float, p)) for i, p in enumerate(x)], "id long, label int, a double, b double, c double")
    queries = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(asked)], "id long, a double, b double, c double")
    counter = spark.sparkContext.accumulator(0)
    found = knn.knn_candidates(train, queries, ["a", "b", "c"], "label", "id", "id", counter=counter)
    assert found.count() == 5 * len(asked)
    assert counter.value < 0.25 * len(x) * len(asked)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "WindowGroupLimit" in plan
