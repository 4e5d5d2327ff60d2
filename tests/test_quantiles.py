"""Distributed exact quantiles against numpy's linear interpolation."""

import numpy as np
import pytest

from cohortlab.operators import quantiles
from cohortlab.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_exact_quantiles_small_and_tied_groups(spark):
    rng = np.random.default_rng(7)
    rows, expect = [], {}
    for g, n in enumerate([1, 2, 3, 5, 21, 37, 200, 1500]):
        vals = np.round(rng.normal(size=n), 1 if g % 2 else 6)   # odd groups are full of ties
        rows += [(g, float(v)) for v in vals]
        expect[g] = np.percentile(vals, [p * 100 for p in PROBS])
    rows.append((99, None))   # a group with only nulls has no row
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r for r in exact_quantiles(df, "v", PROBS, ["g"], accuracy=100).collect()}
    assert set(got) == set(expect)
    for g, e in expect.items():
        assert [got[g][f"q{i}"] for i in range(len(PROBS))] == pytest.approx(list(e), abs=1e-12)


def test_half_tied_column_is_counted_not_collected(spark):
    """Half of the rows share one value: the plan aggregates equal values first and holds no per-group list."""
    df = spark.range(20_000).selectExpr("cast(id % 2 as int) as g", "case when id % 4 < 2 then 5.0 else cast(id as double) end as v")
    got = exact_quantiles(df, "v", [0.25, 0.5, 0.9], ["g"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan
    for r in got.collect():
        vals = np.array([5.0 if i % 4 < 2 else float(i) for i in range(20_000) if i % 2 == r.g])
        assert [r.q0, r.q1, r.q2] == pytest.approx([np.percentile(vals, p) for p in (25, 50, 90)])


def test_exact_quantiles_global(spark):
    df = spark.range(10001).selectExpr("cast(id * 7 % 10001 as double) / 3 as v")
    r = exact_quantiles(df, "v", [0.5, 0.333], accuracy=50).first()
    vals = np.arange(10001) / 3.0
    assert r.n == 10001
    assert r.q0 == pytest.approx(np.percentile(vals, 50)) and r.q1 == pytest.approx(np.percentile(vals, 33.3))


def test_windows_do_not_grow_with_the_rows(spark, monkeypatch):
    """Brackets of a coarse sketch are narrowed until few values are left, for any number of rows and any distribution."""
    seen, real = [], quantiles.narrowed

    def spy(*args):
        out = real(*args)
        most = out.groupBy("g", "__i").count().agg({"count": "max"}).first()[0]
        seen.append((args[0].groupBy("g", "__i").count().agg({"count": "max"}).first()[0], most))
        return out

    monkeypatch.setattr(quantiles, "narrowed", spy)
    for n in (4_000, 40_000):
        rng = np.random.default_rng(n)
        vals = {0: np.exp(rng.normal(size=n) * 40), 1: rng.integers(0, 300, n) / 7.0, 2: np.concatenate([np.zeros(n // 2), rng.normal(size=n // 2)])}
        df = spark.createDataFrame([(g, float(x)) for g, v in vals.items() for x in v], "g int, v double")
        probs = [0.0, 0.25, 0.5, 0.9, 1.0]
        got = {r.g: r for r in exact_quantiles(df, "v", probs, ["g"], accuracy=20, limit=40).collect()}
        for g, v in vals.items():
            assert [got[g][f"q{i}"] for i in range(5)] == pytest.approx([np.percentile(v, p * 100) for p in probs], rel=1e-12, abs=1e-12)
    assert seen[0][0] > 400 and seen[1][0] > 4000 and max(x[1] for x in seen) <= 42
