import numpy as np

from cohortlab.llm.vector_dedup import measure_recall, near_vectors


def brute(rows, threshold=0.9):
    good = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, float) / np.linalg.norm(v)
    links = {i: {j for j in good if j != i and len(good[j]) == len(good[i]) and good[i] @ good[j] >= threshold} for i in good}
    out = []
    for i, (k, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        comp = min(ids) if k is not None and ids else None
        out.append((k, len(links.get(i, ())), comp, k is None or k == comp))
    return sorted(out, key=repr)


def rows():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    out = [(i, v.tolist()) for i, v in enumerate(base)]
    for i in range(40, 400):  # groups of near copies, one large
        v = base[0 if i % 3 else rng.integers(40)]
        out.append((i, (v + rng.normal(size=16) * 0.22).tolist()))
    out += [(500 + i, base[1].tolist()) for i in range(30)] + [(600, (base[1] * 3).tolist())]
    out += [(700, None), (701, []), (702, [0.0] * 16), (703, [float("nan")] * 16), (704, [None, 1.0]), (705, [float("inf"), 1.0]),
            (706, base[2][:8].tolist()), (707, base[2][:8].tolist()), (None, base[3].tolist()), (708, [1e-200] * 16), (709, [-0.0, 1.0]), (710, [0.0, 1.0])]
    return out


def test_against_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(k, v, k) for k, v in data], "vec_id long, embedding array<double>, rep long")
    for block in (4096, 40):
        got = near_vectors(df, block_rows=block)
        assert sorted(map(tuple, got.collect()), key=repr) == brute(data)
    clean = df.where("vec_id < 700")
    assert measure_recall(clean, near_vectors(clean), every=10) >= 0.9


def test_cells_keep_the_links_of_many_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(1500, 32))
    v = np.concatenate([base, base[rng.integers(1500, size=1500)] + rng.normal(size=(1500, 32)) * 0.25])
    data = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = near_vectors(df)
    unit = v.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in got.collect()}
    assert all(found[i] <= n for i, n in enumerate(want)) and sum(found.values()) >= 0.98 * want.sum()


def test_empty(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in near_vectors(df).collect()] == [(1, 0, 1, True)]
    assert near_vectors(df.where("vec_id = 2")).count() == 0
