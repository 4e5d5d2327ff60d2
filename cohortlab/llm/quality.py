"""Quality classifier: a generalised additive model with pairwise interactions.

Method. Every text becomes a few numbers (counts of characters, words and lines). Each feature is cut into quantile
bins; shallow trees of three leaves are boosted on the logistic loss one feature after the other, round after round
with a small step, and what they add is kept as one lookup table a feature. Then the pairs of features whose 2 x 2
split of the residual gains most get tables of their own, boosted in the same cyclic way by trees of two levels.
Scoring is a bin search and a sum of table entries for whole columns.

The model is fitted on a bounded sample of labelled rows: the ``train_rows`` labelled documents with the smallest hash
of their id; only those reach the driver, as features. Scoring reads every whole text once, without a shuffle.

Defined cases: null text counts as empty, and the empty text has features (all zero) and a score like any other; rows
without a label do not train; repeated labels of a document count as their mean, from 0.5 on as 1; without training
rows of both classes the score is the share of label 1 (0.5 without any). Extra columns pass through, but one named like
the result is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import col, text_of

FEATURES = ("words", "word_length", "distinct_words", "distinct_pairs", "repeats", "upper", "digit", "stop", "mark",
            "bar", "space", "other", "line_words", "repeated_lines", "char_entropy", "capital_words", "longest_word")

#: Classes of code points below 1024 and one for all above: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 stop, 6 mark, 7 bar.
_CLASS = np.zeros(1025, np.uint8)
for _i in range(1024):
    _c = chr(_i)
    _CLASS[_i] = (1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c.isspace() else 5 if _c in ".,;:?'\"-()"
                  else 7 if _c == "|" else 6 if 32 < _i < 127 else 0)


def features(text: str) -> list[float]:
    """The numbers of one text, in the order of FEATURES."""
    words = text.split()
    n, k = len(text), len(words)
    if not k:
        return [0.0] * len(FEATURES)
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 1024)
    kinds = np.bincount(_CLASS[codes], minlength=8) / n
    share = np.bincount(codes)
    share = share[share > 0] / n
    lines = [x for x in text.split("\n") if x]
    return [float(np.log1p(k)), sum(map(len, words)) / k, len(set(words)) / k,
            len(set(zip(words, words[1:]))) / max(1, k - 1), sum(a == b for a, b in zip(words, words[1:])) / k,
            kinds[2], kinds[3], kinds[5], kinds[6], kinds[7], kinds[4], kinds[0], k / max(1, len(lines)),
            1 - len(set(lines)) / max(1, len(lines)), float(-(share * np.log2(share)).sum()),
            sum(w[0].isupper() for w in words) / k, float(np.log1p(max(map(len, words))))]


@dataclass
class AdditiveModel:
    """Intercept, bin edges and lookup tables."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, f], "right")]
        if self.pairs:
            coarse = {f: np.searchsorted(self.pair_edges[f], x[:, f], "right") for f in {f for p in self.pairs for f in p}}
            for (a, b), t in zip(self.pairs, self.pair_tables):
                z += t[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g, h, l2=1.0):
    return -g / (h + l2)


def _tree3(g: np.ndarray, h: np.ndarray, least: float) -> np.ndarray:
    """Values by bin of the best tree of at most three leaves over ordered bins."""
    gc, hc = np.concatenate([[0], g.cumsum()]), np.concatenate([[0], h.cumsum()])
    n = len(g)
    i, j = np.triu_indices(n + 1)  # cuts: [0, i), [i, j), [j, n)
    parts = [(gc[i], hc[i]), (gc[j] - gc[i], hc[j] - hc[i]), (gc[n] - gc[j], hc[n] - hc[j])]
    gain = sum(a * a / (b + 1.0) for a, b in parts)
    gain[np.any([(b > 0) & (b < least) for _, b in parts], axis=0)] = -1
    best = int(gain.argmax())
    cuts = np.arange(n)
    which = (cuts >= i[best]).astype(int) + (cuts >= j[best])
    return np.array([_leaf(a[best], b[best]) for a, b in parts])[which]


def _tree_pair(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values over a grid of the best tree that cuts one axis, then each side on the other axis, and its gain."""
    best, out = -1.0, np.zeros_like(g)
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        for cut in range(1, a.shape[0]):
            values, gain = np.zeros_like(a), 0.0
            for rows in (slice(0, cut), slice(cut, None)):
                gc = np.concatenate([[0], a[rows].sum(axis=0).cumsum()])
                hc = np.concatenate([[0], b[rows].sum(axis=0).cumsum()])
                each = gc ** 2 / (hc + 1) + (gc[-1] - gc) ** 2 / (hc[-1] - hc + 1)
                k = int(each.argmax())
                gain += each[k]
                values[rows, :k], values[rows, k:] = _leaf(gc[k], hc[k]), _leaf(gc[-1] - gc[k], hc[-1] - hc[k])
            if gain > best:
                best, out = gain, values if axis == 0 else values.T
    return out, best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, step: float = 0.1, pairs: int = 6,
        pair_bins: int = 8, pair_rounds: int = 40) -> AdditiveModel:
    """Cyclic boosting of the tables on the logistic loss."""
    n, k = x.shape if len(x) else (0, 0)
    share = y.mean() if n else 0.5
    if not n or share in (0.0, 1.0):
        return AdditiveModel(float(np.log((share * n + 1) / ((1 - share) * n + 1))))
    m = AdditiveModel(float(np.log(share / (1 - share))))
    m.edges = [_edges(x[:, f], bins) for f in range(k)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    at = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(m.edges)]
    z = np.full(n, m.base)
    for _ in range(rounds):
        for f in range(k):
            p = 1 / (1 + np.exp(-z))
            size = len(m.tables[f])
            values = step * _tree3(np.bincount(at[f], p - y, size), np.bincount(at[f], p * (1 - p), size), 1e-3)
            m.tables[f] += values
            z += values[at[f]]
    m.pair_edges = [_edges(x[:, f], pair_bins) for f in range(k)]
    cell = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(m.pair_edges)]

    def grids(a, b):
        shape = (len(m.pair_edges[a]) + 1, len(m.pair_edges[b]) + 1)
        p = 1 / (1 + np.exp(-z))
        flat = cell[a] * shape[1] + cell[b]
        return [np.bincount(flat, w, shape[0] * shape[1]).reshape(shape) for w in (p - y, p * (1 - p))]

    gains = sorted(((-_tree_pair(*grids(a, b))[1], a, b) for a in range(k) for b in range(a + 1, k)))
    m.pairs = [(a, b) for _, a, b in gains[:pairs]]
    m.pair_tables = [np.zeros((len(m.pair_edges[a]) + 1, len(m.pair_edges[b]) + 1)) for a, b in m.pairs]
    for _ in range(pair_rounds):
        for t, (a, b) in zip(m.pair_tables, m.pairs):
            values = step * _tree_pair(*grids(a, b))[0]
            t += values
            z += values[cell[a], cell[b]]
    return m


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, keep, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(text, label) of the ``rows`` labelled documents with the smallest hash of their id among those that ``keep``
    (a condition on the key) admits. The sample's ids are bounded by ``rows`` and so are broadcast."""
    ids = (labels.where(keep).select(col(key).alias("k"), col(label).cast("double").alias("y")).where("k IS NOT NULL AND y IS NOT NULL")
           .groupBy("k").agg((F.avg("y") >= 0.5).cast("double").alias("y")).orderBy(F.xxhash64("k"), "k").limit(rows))
    return (docs.select(col(key).alias("k"), text_of(text).alias("t")).join(F.broadcast(ids), "k").select("t", "y"))


def train(docs: DataFrame, labels: DataFrame, keep, label: str = "quality", train_rows: int = 20_000, key: str = "doc_id",
          text: str = "text") -> AdditiveModel:
    """Fit on the bounded sample of labelled rows that ``keep`` admits."""
    @F.pandas_udf("array<double>")
    def numbers(t: pd.Series) -> pd.Series:
        return t.map(features)

    got = labelled_sample(docs, labels, label, train_rows, keep, key, text).select(numbers("t").alias("x"), "y").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    order = np.lexsort((*x.T, got["y"].to_numpy(float))) if len(got) else []  # the model does not depend on row order
    return fit(x[order], got["y"].to_numpy(float)[order]) if len(got) else fit(x, np.zeros(0))


def score(docs: DataFrame, model: AdditiveModel, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability of label 1 for every whole text."""
    @F.pandas_udf("double")
    def value(t: pd.Series) -> pd.Series:
        x = np.array([features(v) for v in t], float).reshape(len(t), len(FEATURES))
        return pd.Series(model.predict(x))

    return docs.withColumn(out, value(text_of(text)))
