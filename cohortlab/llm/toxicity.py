"""Toxicity: subword-bag embeddings averaged into a linear softmax.

Method. A word (a run of letters and digits, in lower case) is the bag of its character n-grams, ends marked, hashed
into a table of vectors; a window of a few words, from every word on, is the average of its words (by running sums), a
word the average of its n-grams; a linear softmax reads the window. Vectors and softmax are trained jointly in numpy, from labels of whole documents:
a document's windows share its gradient by how toxic each looks (a softmax that sharpens as training goes on), so a
toxic document needs one toxic window and a clean one none. Only n-grams whose share of documents differs between the
classes by ``least_z`` standard errors are trained; the others would learn single documents by heart. Misspellings that were never seen share n-grams with
words that were. A document's score is that of its most toxic window, over the whole text.

Training takes a bounded sample: of each class the ``train_rows`` // 2 documents with the smallest hash of their id among
the labelled ones of at most ``train_chars`` characters; only those reach the driver. For scoring, every n-gram's vector
folds into one number, so whole columns are scored by table look-ups and sums, in one pass without a shuffle.

Defined cases: null text counts as empty; a text without words has the score of an empty window (the softmax's bias);
repeated labels count as their mean, from 0.5 on as 1; without both classes every score is the share of label 1
(0 without any). Extra columns pass through, but one named like the result is replaced by it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import col, stored, text_of

GRAMS, BUCKETS, WINDOW, DIM = (3, 4, 5), 2**18, 4, 16
_BLANK = re.compile(r"\s").search
_WORD = re.compile(r"[^\W_]+").finditer
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts at once: bucket and word of every n-gram, and the text of every word."""
    plain = (t.lower().replace("\0", " ") for t in texts)  # U+0000 parts texts here, and words as a blank does
    codes = np.frombuffer("\0".join(["", *plain, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.cumsum(codes == 0) - 1
    wordy = _WORDY[np.minimum(codes, len(_WORDY) - 1)]
    c = np.where(wordy, codes, 0).astype(np.uint64)
    starts = wordy & ~np.concatenate([[False], wordy[:-1]])
    word = np.cumsum(starts) - 1
    keys, words = [], []
    for n in GRAMS:
        m = len(c) - n + 1
        if m <= 0:
            continue
        inner = wordy[1:1 + m].copy()
        for k in range(2, n - 1):
            inner &= wordy[k:k + m]
        at = np.flatnonzero(inner)
        h = np.full(len(at), np.uint64(n))
        for k in range(n):
            h = (h ^ c[at + k]) * _PRIME
            h ^= h >> np.uint64(29)
        keys.append((h % np.uint64(BUCKETS)).astype(np.int32))
        words.append(word[at + 1])
    return (np.concatenate(keys) if keys else np.zeros(0, np.int32), np.concatenate(words) if words else np.zeros(0, np.int64),
            text[np.flatnonzero(starts)])


_WORDY = np.array([chr(i).isalnum() for i in range(0x3000)] + [True])


def windows(texts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, end) of all windows: ``size`` words from every word on that has so many after it in its text; a
    shorter text is one window."""
    at = np.arange(len(texts))
    new = np.concatenate([[True], texts[1:] != texts[:-1]]) if len(texts) else np.zeros(0, bool)
    ends = np.append(np.flatnonzero(new)[1:], len(texts)) if len(texts) else at
    end = np.repeat(ends, np.diff(np.append(np.flatnonzero(new), len(texts)))) if len(texts) else at
    first = at[new | (at + size <= end)]
    return first, np.minimum(first + size, end[first])


@dataclass
class SubwordModel:
    """One number a bucket (the difference of the two logits) and the bias."""

    table: np.ndarray
    bias: float

    def predict(self, texts: list[str]) -> np.ndarray:
        pieces, whose = [], []
        for i, t in enumerate(texts):
            for piece in _pieces(t):
                pieces.append(piece)
                whose.append(i)
        z, best = np.full(len(pieces), self.bias), np.full(len(texts), -np.inf)
        for first, grams, words, owner in _parts(pieces):
            if not len(owner):
                continue
            n = len(owner)
            mean = np.bincount(words, self.table[grams], n) / np.bincount(words, minlength=n)
            start, end = windows(owner, WINDOW)
            sums = np.concatenate([[0.0], mean.cumsum()])
            value = (sums[end] - sums[start]) / (end - start) + self.bias
            text = owner[start]
            at = np.concatenate([[True], text[1:] != text[:-1]])
            z[text[at] + first] = np.maximum.reduceat(value, np.flatnonzero(at))
        np.maximum.at(best, np.array(whose, np.int64), z)
        return 1 / (1 + np.exp(-np.clip(best, -50, 50)))


def _pieces(text: str, chars: int = 500_000):
    """A text, or its pieces between blanks if it is very long; a piece starts with the last words of the one before, so
    that no window is cut."""
    a = 0
    while len(text) - a > chars and (blank := _BLANK(text, a + chars)):
        yield text[a:blank.start()]
        a, words = blank.start(), 0
        for m in reversed(list(_WORD(text, max(0, a - 1_000), a))):
            words += 1
            a = m.start()
            if words == WINDOW - 1:
                break
    yield text[a:]


def _parts(texts: list[str], chars: int = 500_000):
    """(first text, grams, words, owner) of a few texts at a time, so that their n-grams stay few."""
    a = 0
    while a < len(texts):
        b, n = a, 0
        while b < len(texts) and (b == a or n + len(texts[b]) <= chars):
            n += len(texts[b])
            b += 1
        yield (a, *bags(texts[a:b]))
        a = b


def fit(texts: list[str], y: np.ndarray, rounds: int = 120, step: float = 1.0, seed: int = 7,
        least_z: float = 3.0) -> SubwordModel:
    """Joint training of vectors and softmax by Adagrad on all documents of the sample."""
    n = len(texts)
    share = float(np.mean(y)) if n else 0.0
    if share in (0.0, 1.0):
        return SubwordModel(np.zeros(BUCKETS, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    y = np.asarray(y, float)
    # grams whose share of documents does not differ between the classes can only name documents: they stay at zero
    hits = np.zeros((2, BUCKETS))
    for at, grams, words, owner in _parts(texts):
        pair = np.unique(grams.astype(np.int64) * n + owner[words] + at)
        for v in (0, 1):
            hits[v] += np.bincount(pair[y[pair % n] == v] // n, minlength=BUCKETS)
    sizes = [max(1, int((y == v).sum())) for v in (0, 1)]
    both = hits.sum(axis=0) / sum(sizes)
    error = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / sizes[0] + 1 / sizes[1]))
    seen = (np.abs(hits[1] / sizes[1] - hits[0] / sizes[0]) >= least_z * error) & (hits.sum(axis=0) > 1)
    # windows with such grams, and one without for each document
    kept: list[tuple[np.ndarray, ...]] = []
    doc, count = [np.arange(n)], n
    for at, grams, words, owner in _parts(texts):
        start, end = windows(owner, WINDOW)
        every = (start - np.searchsorted(owner, owner[start])) % WINDOW == 0  # training takes windows side by side
        start, end = start[every], end[every]
        number = np.full(len(owner) + 1, -1)
        number[start] = np.arange(len(start))  # a window is numbered by its first word
        on = np.flatnonzero(seen[grams])
        share_of_word = 1.0 / np.bincount(words, minlength=len(owner))[words[on]]
        parts = []
        for back in range(WINDOW):  # a word is in the windows that start at it and up to three words before
            win = np.where(words[on] >= back, number[words[on] - back], -1)
            fits = (win >= 0) & (words[on] < end[win])
            parts.append((grams[on[fits]], (share_of_word[fits] / (end - start)[win[fits]]).astype(np.float32), win[fits]))
        held, weights, wins = (np.concatenate(c) for c in zip(*parts))
        names, place = np.unique(wins, return_inverse=True)
        kept.append((held, weights, place + count))
        doc.append(owner[start[names]] + at)
        count += len(names)
    grams, weight, gwin = (np.concatenate(c) for c in zip(*kept))
    doc = np.concatenate(doc)
    order = np.argsort(doc, kind="stable")  # windows by document
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    doc, gwin = doc[order], place[gwin]
    order = np.argsort(gwin, kind="stable")
    grams, weight, gwin = grams[order], weight[order], gwin[order]
    starts, target = np.searchsorted(doc, np.arange(n)), y
    used, local = np.unique(grams, return_inverse=True)
    if not len(used):
        return SubwordModel(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32)
    heads, bias = rng.normal(0, 0.5, (2, DIM)), np.zeros(2)
    sums = [np.full(vectors.shape, 1e-3, np.float32), np.full(heads.shape, 1e-3), np.full(2, 1e-3)]
    even = np.where(target == 1, 0.5 / max(1, (target == 1).sum()), 0.5 / max(1, (target == 0).sum()))
    spread = np.diff(np.append(starts, count))
    for r in range(rounds):
        sharp = 1.0 + 9.0 * min(1.0, 2 * r / rounds)
        fold = vectors @ (heads[1] - heads[0]).astype(np.float32)
        z = np.bincount(gwin, weight * fold[local], count) + (bias[1] - bias[0])
        top = np.repeat(np.maximum.reduceat(z, starts), spread)
        part = np.exp(sharp * (z - top))
        part /= np.repeat(np.add.reduceat(part, starts), spread)
        pooled = np.add.reduceat(part * z, starts)
        err = (1 / (1 + np.exp(-np.clip(pooled, -50, 50))) - target) * even  # of the document's logit
        coef = np.repeat(err, spread) * part
        push = np.bincount(local, weight * coef[gwin], len(used))
        mean = push @ vectors  # gradient of the difference of the heads
        for value, total, grad in ((heads, sums[1], np.stack([-mean, mean])), (bias, sums[2], np.array([-coef.sum(), coef.sum()]))):
            total += grad ** 2
            value -= 0.1 * step * grad / np.sqrt(total)
        rows = np.flatnonzero(push)
        grad = (push[rows, None] * (heads[1] - heads[0]) * n).astype(np.float32)
        sums[0][rows] += grad ** 2
        vectors[rows] -= 0.1 * step * grad / np.sqrt(sums[0][rows])
    table = np.zeros(BUCKETS, np.float32)
    table[used] = vectors @ (heads[1] - heads[0])
    return SubwordModel(table, float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, keep, label: str = "toxic", train_rows: int = 4000, train_chars: int = 50_000,
          key: str = "doc_id", text: str = "text") -> SubwordModel:
    """Fit on the bounded sample of labelled rows that ``keep`` (a condition on the key) admits."""
    ids = (labels.where(keep).select(col(key).alias("k"), col(label).cast("double").alias("y")).where("k IS NOT NULL AND y IS NOT NULL")
           .groupBy("k").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    short = docs.select(col(key).alias("k"), text_of(text).alias("t")).where(F.length("t") <= train_chars)
    fit_for = stored(ids.join(short.select("k"), "k", "left_semi"), "labelled")
    part = lambda v: fit_for.where(F.col("y") == v).orderBy(F.xxhash64("k"), "k").limit(train_rows // 2)
    chosen = F.broadcast(part(0).unionByName(part(1)))  # train_rows ids at most
    got = short.join(chosen, "k").groupBy("k", "t").agg(F.first("y").alias("y")).toPandas().sort_values(["k", "t"])
    return fit(got["t"].tolist(), got["y"].to_numpy(float))


def score(docs: DataFrame, model: SubwordModel, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability that each whole text is toxic."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # 1 MB whatever the corpus

    @F.pandas_udf("double")
    def value(t: pd.Series) -> pd.Series:
        return pd.Series(held.value.predict(t.tolist()))

    return docs.withColumn(out, value(text_of(text)))
