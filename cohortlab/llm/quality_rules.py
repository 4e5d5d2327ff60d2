"""Quality rules by weak supervision: rules vote or abstain, their accuracies are estimated without labels.

Method. Every whole text is counted once (words, lines, marks, repeats). A rule compares the ratio of two counts with four
limits: within the inner two it votes good, outside the outer two bad, between them it abstains. The votes of all documents
are counted by pattern, and expectation-maximisation on those counts estimates the share of good documents, those of the kinds
of defects that the rules know, and how often each rule is right on each; abstaining says nothing. A document is kept if its posterior
probability of being good is at least one half, so that a weak rule's vote does not decide alone, as it would if all rules
had to pass. The base conditions (too few words, too much repetition) hold besides.

Bounds. A pattern has three votes a rule, so the driver sees at most 3 ** 12 counts however many documents there are; all
else stays in Spark. Counting is vectorised over pieces of Arrow batches of some megabytes (a longer text is a piece of its
own); repeated windows are found exactly, by sorting numbered words, not by hashes.

Defined cases: null text counts as empty. A ratio over nothing abstains. Without documents, or where no rule votes, the
prior is what remains: nothing is kept that the base refuses, all else is. Repeated rows vote once each. Other columns
pass through; those whose names clash with the new ones get a trailing ``_in``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.llm.common import keep_clashes, ready, text_of, tidy_name

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_top_word", "n_upper",
          "n_letters", "n_wide", "n_digits", "n_exclaims", "n_stops", "n_marked_words", "n_loud_words", "n_distinct")
WINDOW = 5
PIECE = 4_000_000  # bytes of text that are counted at once


@dataclass(frozen=True)
class Rule:
    """Limits are thousandths of ``over`` / ``under`` (sums of counts); None does not limit. ``kind`` names the defect."""

    name: str
    kind: str
    over: str
    under: str
    bad_below: int | None
    good_from: int | None
    good_to: int | None
    bad_above: int | None


RULES = (
    Rule("symbols", "marks", "n_symbols", "n_words", None, None, 20, 100),
    Rule("marked_words", "marks", "n_marked_words", "n_words", None, None, 20, 100),
    Rule("letters", "marks", "n_letters+n_wide", "word_chars", 880, 930, None, None),
    Rule("upper", "shouting", "n_upper", "n_letters", None, None, 100, 300),
    Rule("loud_words", "shouting", "n_loud_words", "n_words", None, None, 50, 200),
    Rule("exclaims", "shouting", "n_exclaims", "n_words", None, None, 20, 100),
    Rule("repeats", "repeats", "n_repeat_words", "n_words", None, None, 100, 200),
    Rule("lines", "repeats", "n_dup_lines", "n_lines", None, None, 300, 500),
    Rule("top_word", "repeats", "n_top_word", "n_words", None, None, 120, 250),
    Rule("stops", "form", "n_stops", "n_words", 5, 20, 250, 500),
    Rule("word_length", "form", "word_chars", "n_words", 2_500, 3_500, 9_000, 12_000),
    Rule("digits", "form", "n_digits", "word_chars", None, None, 50, 200),
)

#: Byte classes that are counted: continuation bytes and blanks are those that word characters are not.
_SETS = {"n_symbols": b"#*$%&|<>", "n_upper": bytes(range(65, 91)), "n_letters": bytes([*range(65, 91), *range(97, 123)]),
         "n_digits": b"0123456789", "n_exclaims": b"!", "n_stops": b".!?"}
_WORDS = {"n_marked_words": r"[#*$%&|<>]", "n_loud_words": r"^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*$"}
_BLANK = b" \t\n\v\f\r"


def _mask(members) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_MASKS = {k: _mask(v) for k, v in _SETS.items()} | {"n_wide": _mask(range(0xC0, 256)), "word_chars": ~_mask([*_BLANK, *range(0x80, 0xC0)])}


def _numbers(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _repeated(ids: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Words of each document that lie in windows found twice or more in it."""
    n = len(ids)
    if n < WINDOW:
        return np.zeros(docs, np.int64)
    two = _numbers(ids[:-1] * (int(ids.max()) + 1) + ids[1:])  # numbers of word pairs, then of fours and fives
    four = _numbers(two[:-2] * (int(two.max()) + 1) + two[2:])
    starts = np.flatnonzero(doc[:n - WINDOW + 1] == doc[WINDOW - 1:])
    five = _numbers(four[starts] * (int(ids.max()) + 1) + ids[starts + WINDOW - 1])
    _, back, often = np.unique(five * docs + doc[starts], return_inverse=True, return_counts=True)
    edge = np.zeros(n + 1, np.int64)
    hit = starts[often[back] > 1]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + WINDOW, -1)
    return np.bincount(doc[edge[:-1].cumsum() > 0], minlength=docs)


def _count(texts: pa.Array) -> dict[str, np.ndarray]:
    """All COUNTS of an array of texts without nulls."""
    docs, out = len(texts), {}
    ends = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset] if docs else 0
    data = data[first:first + (int(ends[-1]) if docs else 0)]
    for name, mask in _MASKS.items():
        sums = np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])[np.concatenate([[0], ends])]
        out[name] = np.diff(sums)
    parts = pc.ascii_split_whitespace(texts)
    owner, words = pc.list_parent_indices(parts), pc.list_flatten(parts)
    real = pc.greater(pc.binary_length(words), 0)
    doc = pc.filter(owner, real).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.filter(words, real).dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    for name, pattern in _WORDS.items():  # looked at once a distinct word
        hit = pc.match_substring_regex(coded.dictionary, pattern).to_numpy(zero_copy_only=False)
        out[name] = np.bincount(doc[hit[ids]] if len(ids) else doc, minlength=docs)
    out["n_words"] = np.bincount(doc, minlength=docs)
    size = int(ids.max(initial=0)) + 1
    keys, often = np.unique(doc * size + ids, return_counts=True)
    out["n_distinct"] = np.bincount(keys // size, minlength=docs)
    out["n_top_word"] = np.zeros(docs, np.int64)
    np.maximum.at(out["n_top_word"], keys // size, often)
    out["n_repeat_words"] = _repeated(ids, doc, docs)
    parts = pc.split_pattern(texts, "\n")
    owner, lines = pc.list_parent_indices(parts), pc.list_flatten(parts)
    real = pc.and_(pc.greater(pc.binary_length(lines), 0), pc.invert(pc.ascii_is_space(lines)))
    doc = pc.filter(owner, real).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = pc.filter(lines, real).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    out["n_lines"] = np.bincount(doc, minlength=docs)
    size = int(ids.max(initial=0)) + 1
    out["n_dup_lines"] = out["n_lines"] - np.bincount(np.unique(doc * size + ids) // size, minlength=docs)
    return out


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of every text, piece by piece."""
    texts = pc.fill_null(texts, "")
    ends = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    cuts = [0, *(np.flatnonzero(np.diff(ends // PIECE)) + 1).tolist(), len(texts)]
    parts = [_count(texts.slice(a, b - a)) for a, b in zip(cuts, cuts[1:]) if b > a]
    return {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in COUNTS}


def measure(df: DataFrame, text: str = "text", out: str = "counts", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add the struct ``out`` of all COUNTS of every whole text (one pass, no shuffle); ``drop`` leaves columns out."""
    ready(df.sparkSession)
    df, _ = keep_clashes(df.withColumn(held := tidy_name(df, "text"), text_of(text)).drop(*drop), out)
    kept = [c for c in df.columns if c != held]
    counts = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    schema = T.StructType([*[df.schema[c] for c in kept], T.StructField(out, counts)])
    at = df.columns.index(held)

    def task(batches):
        for batch in batches:
            got = count_texts(batch.column(at))
            struct = pa.StructArray.from_arrays([pa.array(got[c], pa.int64()) for c in COUNTS], names=list(COUNTS))
            yield pa.RecordBatch.from_arrays([*[c for i, c in enumerate(batch.columns) if i != at], struct], names=schema.names)

    return df.mapInArrow(task, schema)


def _total(counts: Column, names: str) -> Column:
    first, *rest = [counts[n] for n in names.split("+")]
    for c in rest:
        first = first + c
    return first


def vote(rule: Rule, counts: Column) -> Column:
    """1 for good, -1 for bad, 0 where the rule abstains. Whole numbers throughout."""
    value, under = _total(counts, rule.over) * 1000, _total(counts, rule.under)
    bad, good = F.lit(False), F.lit(True)
    if rule.bad_below is not None:
        bad, good = bad | (value < F.lit(rule.bad_below) * under), good & (value >= F.lit(rule.good_from) * under)
    if rule.bad_above is not None:
        bad, good = bad | (value > F.lit(rule.bad_above) * under), good & (value <= F.lit(rule.good_to) * under)
    return F.when(under == 0, 0).when(bad, -1).when(good, 1).otherwise(0)


@dataclass
class RuleModel:
    """Shares of the classes (good first, then one a kind of defect) and, by class and rule, the share of good votes."""

    shares: np.ndarray
    says_good: np.ndarray

    def weights(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log weights of the classes: at the start, for a good vote, for a bad vote of each rule."""
        return np.log(self.shares), np.log(self.says_good), np.log(1 - self.says_good)


def start(rules: tuple[Rule, ...]) -> RuleModel:
    """Four in five documents are good and rules accuse one in twenty of them; the other classes share the rest evenly,
    each accused by the rules of its kind in four of five cases and by the others like good ones."""
    kinds = list(dict.fromkeys(r.kind for r in rules))
    says = np.array([[0.95] * len(rules), *[[0.2 if r.kind == k else 0.95 for r in rules] for k in kinds]])
    return RuleModel(np.array([0.8, *[0.2 / len(kinds)] * len(kinds)]), says)


def posterior(model: RuleModel, votes: np.ndarray) -> np.ndarray:
    """Probability of each class (columns) given the votes (rows)."""
    first, good, bad = model.weights()
    z = first + (votes > 0) @ good.T + (votes < 0) @ bad.T
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def estimate(votes: np.ndarray, counts: np.ndarray, rules: tuple[Rule, ...] = RULES, rounds: int = 200) -> RuleModel:
    """Expectation-maximisation over patterns of votes (rows) and how many documents have each.

    The bad documents are of as many classes as the rules know kinds of defects: a text of symbols is not a text of
    repeats, so the rules about repeats that call it good speak for nothing. Every class counts the votes of ten documents
    of its start besides its own, and the meanings of the classes are held: good documents are called good by every rule
    more often than not, and a class of defects is accused by the rules of its kind at least as often as good ones.
    """
    m = start(rules)
    first, kinds = m.says_good.copy(), list(dict.fromkeys(r.kind for r in rules))
    own = np.array([[r.kind == k for r in rules] for k in kinds]).reshape(len(kinds), len(rules))
    yes, no, c = (votes > 0).astype(float), (votes < 0).astype(float), counts.astype(float)
    for _ in range(rounds if len(votes) else 0):
        p = posterior(m, votes) * c[:, None]
        says = (p.T @ yes + 10 * first) / (p.T @ (yes + no) + 10)
        says[0] = np.maximum(says[0], 0.5)
        says[1:] = np.where(own, np.minimum(says[1:], says[0]), says[1:])
        m = RuleModel((p.sum(axis=0) + 1) / (c.sum() + len(p.T)), says)
    return m


def fit(df: DataFrame, counts: str = "counts", rules: tuple[Rule, ...] = RULES, rounds: int = 200) -> RuleModel:
    """Estimate from the patterns of all rows of ``measure`` (one aggregation, at most 3 ** rules groups)."""
    names = [f"v{i}" for i in range(len(rules))]
    patterns = (df.select(*[vote(r, F.col(counts)).alias(n) for r, n in zip(rules, names)]).groupBy(*names)
                .agg(F.count("*").alias("c")).orderBy(*names).collect())
    votes = np.array([[r[n] for n in names] for r in patterns], np.int64).reshape(len(patterns), len(rules))
    return estimate(votes, np.array([r.c for r in patterns], np.int64), rules, rounds)


def judge(df: DataFrame, model: RuleModel, counts: str = "counts", rules: tuple[Rule, ...] = RULES,
          keep_from: float = 0.5) -> DataFrame:
    """Add ``posterior`` (probability of being good), ``base_failed`` and ``kept`` to rows of ``measure``."""
    df, taken = keep_clashes(df, "posterior", "base_failed", "kept")
    c = F.col(taken.get(counts, counts))
    first, good, bad = model.weights()
    votes = [vote(r, c) for r in rules]
    weights = []
    for k in range(len(first)):
        z = F.lit(float(first[k]))
        for j, v in enumerate(votes):
            z = z + F.when(v == 1, float(good[k, j])).when(v == -1, float(bad[k, j])).otherwise(0.0)
        weights.append(z)
    ratio = F.lit(0.0)
    for z in weights[1:]:
        ratio = ratio + F.exp(z - weights[0])
    return (df.withColumn("posterior", 1 / (1 + ratio))
            .withColumn("base_failed", (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"]))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from)))
