import random

import numpy as np

from cohortlab.llm.text_dedup import keep_one, near_texts, shingles, signature
from llm_samples import ODD


def jaccard(a, b, counted):
    x, y = (dict(zip(e.tolist(), c.tolist() if counted else [1] * len(e))) for e, c in (shingles(a), shingles(b)))
    keys = x.keys() | y.keys()
    return sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)


def classes(rows, similarity=0.8):
    """Brute force: all pairs of different texts."""
    texts = sorted({t or "" for _, t in rows})
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if a.split() and b.split() and jaccard(a, b, False) >= similarity:
                root[find(a)] = find(b)
    low = {}
    for i, t in rows:
        if i is not None:
            low[find(t or "")] = min(i, low.get(find(t or ""), i))
    return sorted(((i, low.get(find(t or ""))) for i, t in rows), key=repr)


def test_signatures_estimate_weighted_similarity():
    rng, k = random.Random(1), 3000
    base = [f"w{rng.randrange(900)}" for _ in range(300)]
    for edits, extra in ((3, 0), (12, 200), (40, 60)):
        a = base[:50] + ["again"] * extra + base[50:]
        b = list(a)
        for _ in range(edits):
            b[rng.randrange(len(b))] = f"z{rng.randrange(99)}"
        a, b = " ".join(a), " ".join(b)
        for counted in (False, True):
            s = [signature(e, (c if counted else np.ones(len(c))).astype(float), k) for e, c in (shingles(a), shingles(b))]
            assert abs((s[0] == s[1]).mean() - jaccard(a, b, counted)) < 5 * 0.5 / k**0.5


def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(3, 120)))) for i in range(60)]
    for i in range(60, 260):  # chains and groups of copies around a few texts
        base = rows[rng.choice([0, 1, 2, 3, 4, i - 1])][1].split()
        for _ in range(rng.randrange(3)):
            base[rng.randrange(len(base))] = rng.choice(words)
        rows.append((i, " ".join(base)))
    return rows


def test_classes_against_brute_force(spark):
    rows = corpus()
    rng = random.Random(2)
    hub = rng.choices([f"v{i}" for i in range(500)], k=100)
    for i in range(300, 1000):  # a large group: copies that are near their hub, hardly near each other
        text = list(hub)
        text[rng.randrange(100)] = f"u{i}"
        text[rng.randrange(100)] = f"t{i}"
        rows.append((i, " ".join(text)))
    got = near_texts(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=repr) == classes(rows)


def test_odd_rows(spark, odd, none):
    got = near_texts(odd).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == classes(ODD)
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 4, 5, 7, 8, 9, 9, 10]
    assert near_texts(none).count() == 0 and keep_one(none).count() == 0


def test_one_document_stays_where_ids_repeat_or_are_missing(spark):
    rng = random.Random(4)
    a, b, c, d = (" ".join(rng.choices([f"w{i}" for i in range(400)], k=80)) for _ in range(4))
    rows = [(1, a), (2, a), (2, b), (None, a), (None, c), (None, c), (None, f"{c} end"), (3, d), (3, f"{d} end"), (4, d), (None, None), (None, "")]
    got = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    stays = sorted((r.doc_id or 0, (r.text or "")[:-4] if (r.text or "").endswith(" end") else r.text or "") for r in got)
    assert stays == sorted([(1, a), (2, b), (0, c), (3, d), (0, "")])
