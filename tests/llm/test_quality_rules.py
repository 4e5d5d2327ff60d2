"""Counts against plain Python, votes and expectation-maximisation against loops, verdicts against labels."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from cohortlab.llm import quality_rules as q
from cohortlab.llm.common import table
from llm_samples import SF, needs_data


def plain(text):
    text = text or ""
    words, n = re.findall(r"[^\x20\x09-\x0D]+", text), len
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(n(words) - 4)]
    often = Counter(windows)
    twice = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    chars = lambda p: n(re.findall(p, text))
    return {"n_words": n(words), "word_chars": sum(map(n, words)), "n_symbols": chars(r"[#*$%&|<>]"), "n_dup_lines": n(lines) - n(set(lines)),
            "n_repeat_words": n(twice), "n_lines": n(lines), "n_top_word": max(Counter(words).values(), default=0), "n_upper": chars("[A-Z]"),
            "n_letters": chars("[A-Za-z]"), "n_wide": chars(r"[^\x00-\x7F]"), "n_digits": chars("[0-9]"), "n_exclaims": chars("!"), "n_stops": chars("[.!?]"),
            "n_marked_words": sum(bool(re.search(r"[#*$%&|<>]", w)) for w in words), "n_distinct": n(set(words)),
            "n_loud_words": sum(bool(re.fullmatch(r"[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*", w)) for w in words)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab AB\n\t\x0b\x0c\r\x1c\x85\xa0é😀#|.!7\0", max_size=60), st.lists(st.sampled_from(["a", "b", "c", "\n"]), max_size=60).map(" ".join)), max_size=6))
def test_counts_against_plain_python(texts):
    for kind in (pa.string(), pa.large_string()):
        got = q.count_texts(pa.array(["dropped", *texts], kind).slice(1))
        assert {k: v.tolist() for k, v in got.items()} == {c: [plain(t)[c] for t in texts] for c in q.COUNTS}


def test_pieces(monkeypatch):
    texts = ["a b c d e f a b c d e", "", "x\nx\ny", None, "one two " * 20] * 5
    whole = q.count_texts(pa.array(texts))
    monkeypatch.setattr(q, "PIECE", 16)
    assert all((q.count_texts(pa.array(texts))[c] == whole[c]).all() for c in q.COUNTS)


def loops(votes, counts, rules, rounds):
    """Expectation-maximisation by loops over documents' patterns, classes and rules."""
    m = q.start(rules)
    share, says, first = list(m.shares), m.says_good.tolist(), m.says_good.tolist()
    kinds = [None, *dict.fromkeys(r.kind for r in rules)]
    for _ in range(rounds):
        posts = []
        for v in votes:
            z = [math.log(s) + sum(math.log(a if x > 0 else 1 - a) for a, x in zip(row, v) if x) for s, row in zip(share, says)]
            e = [math.exp(x - max(z)) for x in z]
            posts.append([x / sum(e) for x in e])
        for k in range(len(kinds)):
            share[k] = (sum(c * p[k] for c, p in zip(counts, posts)) + 1) / (sum(counts) + len(kinds))
            for j, r in enumerate(rules):
                yes = sum(c * p[k] for c, p, v in zip(counts, posts, votes) if v[j] > 0)
                no = sum(c * p[k] for c, p, v in zip(counts, posts, votes) if v[j] < 0)
                a = (yes + 10 * first[k][j]) / (yes + no + 10)
                says[k][j] = max(a, 0.5) if k == 0 else min(a, says[0][j]) if r.kind == kinds[k] else a
    return share, says


def test_estimates_against_loops():
    rng = np.random.default_rng(2)
    votes = np.unique(rng.integers(-1, 2, (40, len(q.RULES))), axis=0)
    counts = rng.integers(1, 50, len(votes))
    m = q.estimate(votes, counts, rounds=25)
    share, says = loops(votes.tolist(), counts.tolist(), q.RULES, 25)
    assert np.allclose(m.shares, share, rtol=1e-9) and np.allclose(m.says_good, says, rtol=1e-9)


def test_estimates_recover_planted_accuracies():
    rng = np.random.default_rng(4)
    true = q.start(q.RULES)
    true.says_good = np.clip(true.says_good + rng.uniform(-0.15, 0.04, true.says_good.shape), 0.02, 0.98)
    k = rng.choice(5, 40_000, p=true.shares)
    votes = np.where(rng.random((len(k), 12)) < 0.2, 0, np.where(rng.random((len(k), 12)) < true.says_good[k], 1, -1))
    pats, c = np.unique(votes, axis=0, return_counts=True)
    m = q.estimate(pats, c)
    assert np.abs(m.shares - true.shares).max() < 0.02 and np.abs(m.says_good[0] - true.says_good[0]).max() < 0.02
    right = [((q.posterior(x, votes)[:, 0] >= 0.5) == (k == 0)).mean() for x in (m, true)]
    assert right[0] > right[1] - 0.005  # as good as with the true accuracies


def test_odd_rows(spark, odd, none):
    clash = odd.withColumnRenamed("score_", "Counts").withColumnRenamed("source", "kept")
    counted = q.measure(clash)
    assert counted.columns == ["doc_id", "text", "lang", "kept", "n_chars", "Counts_in", "counts"]
    got = q.judge(counted, q.fit(counted)).collect()
    assert len(got) == odd.count() and "kept_in" in got[0].__fields__
    for r in got:
        assert r.counts.asDict() == {c: plain(r.text)[c] for c in q.COUNTS}
        assert r.base_failed == (r.counts.n_words < 10 or 100 * r.counts.n_repeat_words > 20 * r.counts.n_words) and not (r.base_failed and r.kept)
    empty = q.measure(none)
    assert q.judge(empty, q.fit(empty)).count() == 0


@needs_data
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_verdicts_against_labels(spark, sf):
    got = entry.queries()["op12_quality_rules"](spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    good, bad = [r for r in got if r.quality == 1 and not r.base_failed], [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good) and sum(r.kept for r in bad) <= 0.03 * len(bad)


@needs_data
def test_query_against_plain_python(spark):
    got = entry.queries()["op12_quality_rules"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    assert len(got) == len(texts)
    for r in got:
        p = plain(texts[r.doc_id])
        assert all(r[c] == p[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
