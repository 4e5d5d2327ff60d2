"""Personal data: base patterns as seeds of a bootstrapped contextual extraction.

Method. Base entities (email, ip, card, phone) are matched in every whole text. They are the first seed instances, with the
values of fields whose names say that they identify (``token = "..."``, see SEED_FIELDS). Every mention, seed or not, that
looks like an identifier (with an @ or three digits) gives lexical patterns: the word before it, the two words before it,
the words on both sides, its field name, and its shape. Spark counts the instance - pattern graph and scores it by turns.
A pattern's confidence is the trusted share of all places where it stands, and that counts the places in the same texts
where the words are followed by something else, so an article is no pattern. Confident patterns with enough different
trusted instances promote the instances that they find; promoted instances are seeds of the next turn, with their
pattern's confidence as trust. What the last turn's patterns find are the identifiers that no base pattern knows, spans of
kind ``context``.

Tokens end at white space, quotes, brackets, ``=``, ``,`` and ``;`` and are cut at base spans, so the fields of a compact
record are mentions of their own. Words and shapes count whole; long ones are named by a digest.

One pass reads the texts and keeps mentions only; the graph is aggregated before every shuffle, seeds never meet in a
join on a pattern, and nothing is gathered.

Defined cases: null text counts as empty; rows that repeat key and text have the same spans; null keys are keys like
others; an empty table gives an empty result; extra columns pass through, and one that is named like the result gets a
trailing ``_in``.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import col, cut, keep_clashes, ready, text_of, tidy_name

KINDS = ("email", "ip", "card", "phone", "context")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
# a run of digits that fails at its start fails everywhere, so only starts of runs are tried
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++").finditer
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
_MARK, _DIGIT = re.compile(r"[0-9@]").search, re.compile(r"[0-9]").search
#: Names of fields whose values identify a person or give access.
SEED_FIELDS = ("account", "acct", "access_key", "api_key", "apikey", "iban", "key", "passport", "passwd", "password", "pin", "pwd",
               "secret", "ssn", "token", "user_id", "username")
_ENDS = frozenset("\"'`=,;{}[]<>")
_END = re.compile(r"""[\s"'`=,;{}\[\]<>]""").search
_CONTEXT = re.compile(r"""[^\s"'`=:,;{}\[\]<>]+|[=:]""").findall
LONG = 64  # characters of a word or shape that is not named by a digest
_DOUBLE = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def _luhn(digits: str) -> bool:
    return (sum(map(int, digits[-1::-2])) + sum(_DOUBLE[int(d)] for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base entities, by kind, then start; code points, end exclusive."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN(text, at + 1)):
            out.append(("email", start, done := m.end()))
        at = text.find("@", max(at + 1, done))
    if _DIGIT(text):
        for m in _IP(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
        for m in _PHONE(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def _named(s: str) -> str:
    return s if len(s) <= LONG else "#" + hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def _shape(s: str) -> str:
    s = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: f"9{len(m[0])}", s))
    return _named(re.sub(r"(?:a?9\d+)(?:a9\d+)+a?|a9\d+a", "h", s))  # mixed letters and digits: one sign


def _word(s: str) -> str:
    return _named(re.sub(r"[0-9]", "0", s.strip(".!?").lower()))


def _before(text: str, at: int) -> list[str]:
    """The last context words and signs before a place, at least three words where there are as many."""
    size = 120
    while True:
        got = _CONTEXT(text, max(0, at - size), at)
        if size >= at:
            return got
        got = got[1:]  # the first one may be cut
        if sum(x not in "=:" for x in got) >= 3:
            return got
        size *= 4


def _after(text: str, at: int) -> str:
    size = 60
    while True:
        got = [x for x in _CONTEXT(text, at, min(len(text), at + size)) if x not in "=:"]
        if at + size >= len(text) or len(got) > 1:
            return got[0] if got else ""
        size *= 4


def _pieces(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Parts of tokens, outside the base spans, that look like identifiers."""
    after, k = 0, 0
    while m := _MARK(text, after):
        s = m.start()
        while s > after and not (text[s - 1] in _ENDS or text[s - 1].isspace()):
            s -= 1
        e = after = end.start() if (end := _END(text, m.end())) else len(text)
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        cuts, i, at = [], k, s
        while i < len(taken) and taken[i][0] < e:
            cuts.append((at, taken[i][0]))
            at = max(at, taken[i][1])
            i += 1
        for a, b in [*cuts, (at, e)]:
            while a < b and not (text[a].isalnum() or text[a] in "+(@"):
                a += 1
            while b > a and not (text[b - 1].isalnum() or text[b - 1] in ")"):
                b -= 1
            token = text[a:b]
            if "@" in token or sum("0" <= c <= "9" for c in token) >= 3:
                yield a, b


def mentions(text: str) -> list[tuple[str, int, int, str, bool, list[str], list[int]]]:
    """(kind or '', start, end, instance, seed, patterns, others) of all that looks like an identifier; ``others`` are the
    places of each pattern in the text that no mention follows, told once a text."""
    spans = base_spans(text)
    found = [*spans, *(("", s, e) for s, e in _pieces(text, sorted((s, e) for _, s, e in spans)))]
    if not found:
        return []
    rows, uses = [], Counter()
    for kind, s, e in found:
        context = _before(text, s)
        words = [_word(x) for x in context if x not in "=:"][-2:]
        prev, after = words[-1] if words else "^", _word(_after(text, e)) or "$"
        field = prev if words and context[-1] in "=:" else None
        patterns = [f"S {_shape(text[s:e])}", f"L {prev}", f"M {' '.join(words) or '^'}", f"B {prev} {after}"]
        patterns += [f"F {field}"] if field else []
        rows.append((kind, s, e, text[s:e], bool(kind) or field in SEED_FIELDS, patterns))
        uses.update(patterns)
    all_words = [_word(x) for x in _CONTEXT(text) if x not in "=:"]
    ones = Counter(all_words)
    twos, around = Counter(zip(all_words, all_words[1:])), Counter(zip(all_words, all_words[2:]))
    out, told = [], set()
    for *row, patterns in rows:
        others = []
        for p in patterns:
            parts = p[2:].split(" ")
            seen = 0
            if p not in told and "^" not in parts and "$" not in parts:
                if p[0] in "LF":
                    seen = ones[parts[0]] if p[0] == "L" else 0
                elif p[0] == "M":
                    seen = twos[tuple(parts)] if len(parts) == 2 else 0
                elif p[0] == "B":
                    seen = around[tuple(parts)]
                seen = max(0, seen - uses[p])
            told.add(p)
            others.append(seen)
        out.append((*row, patterns, others))
    return out


def find_mentions(df: DataFrame, text: str, keys: list[Column]) -> DataFrame:
    """(k0, k1, ..., kind, start, end, instance, seed, patterns, others): one row a mention, instances as hashes."""
    names = [f"k{i}" for i in range(len(keys))]
    src = df.select(*[k.alias(n) for k, n in zip(keys, names)], text_of(text).alias("t"))
    kept = src.schema.fields[:-1]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept),
                        "kind string, start int, `end` int, instance string, seed boolean, patterns array<string>, others array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, t in enumerate(batch.column(len(names)).to_pylist()):
                got = mentions(t)
                rows += got
                at += [i] * len(got)
            if rows:
                take = pa.array(at, pa.int32())
                cols = [batch.column(i).take(take) for i in range(len(names))]
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()))
                cols += [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=[*names, "kind", "start", "end", "instance", "seed", "patterns", "others"])

    return src.mapInArrow(run, schema).withColumn("instance", F.xxhash64("instance"))


def score_patterns(found: DataFrame, rounds: int = 3, smoothing: float = 2.0, confidence: float = 0.8,
                   least_seeds: int = 3) -> DataFrame:
    """(pattern, confidence, seeds): all patterns of the graph after ``rounds`` turns of scoring and promotion.

    Confidence: trusted mentions over all mentions, the other places of the pattern and ``smoothing``. Seeds: different
    trusted instances, first the base and field seeds, then also those that the turn before promoted.
    """
    edges = cut(found.select("instance", "seed", F.inline(F.arrays_zip("patterns", "others"))).withColumnRenamed("patterns", "pattern")
                .groupBy("instance", "pattern").agg(F.count("*").alias("n"), F.max("seed").alias("seed"), F.sum("others").alias("others")))
    known = edges.groupBy("instance").agg(F.max("seed").alias("seed")).where("NOT seed").select("instance")
    fresh = cut(edges.join(known, "instance").select("instance", "pattern", "n"))
    base = cut(edges.groupBy("pattern").agg(F.sum("n").alias("n"), F.sum("others").alias("others"))
               .join(fresh.groupBy("pattern").agg(F.sum("n").alias("open"), F.count("*").alias("strangers")), "pattern", "left")
               .join(edges.groupBy("pattern").agg(F.count("*").alias("instances")), "pattern")
               .select("pattern", (F.col("n") + F.col("others") + F.lit(smoothing)).alias("places"),
                       (F.col("n") - F.coalesce("open", F.lit(0))).cast("double").alias("trusted"),
                       (F.col("instances") - F.coalesce("strangers", F.lit(0))).alias("seeds")))
    patterns = base
    for i in range(rounds):
        scored = patterns.select("pattern", (F.col("trusted") / F.col("places")).alias("confidence"), "seeds")
        if i + 1 == rounds:
            break
        good = cut(scored.where((F.col("confidence") >= confidence) & (F.col("seeds") >= least_seeds)))
        promoted = fresh.join(good.select("pattern", "confidence"), "pattern").groupBy("instance").agg(F.max("confidence").alias("trust"))
        gains = cut(fresh.join(promoted, "instance").groupBy("pattern").agg(F.sum(F.col("n") * F.col("trust")).alias("gain"), F.count("*").alias("more")))
        patterns = base.join(gains, "pattern", "left").select("pattern", "places", (F.col("trusted") + F.coalesce("gain", F.lit(0.0))).alias("trusted"),
                                                              (F.col("seeds") + F.coalesce("more", F.lit(0))).alias("seeds"))
    return scored


def find_personal(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "spans", confidence: float = 0.8,
                  least_seeds: int = 3, rounds: int = 3) -> DataFrame:
    """Add the array of spans (kind, start, end) of every whole text: base entities and what the patterns found,
    by kind as in KINDS, then start."""
    ready(df.sparkSession)
    df, taken = keep_clashes(df, out)
    key, text = taken.get(key, key), taken.get(text, text)
    mark = tidy_name(df, "mark")
    text_mark = F.xxhash64(text_of(text))
    own = col(key).cast("string")
    found = cut(find_mentions(df, text, [own, text_mark]))
    good = (score_patterns(found, rounds, confidence=confidence, least_seeds=least_seeds).where((F.col("confidence") >= confidence) & (F.col("seeds") >= least_seeds))
            .select("pattern"))
    fresh = found.where("kind = ''")
    place = ["k0", "k1", F.lit("context").alias("kind"), "start", "end"]
    new = (fresh.where("NOT seed").select("k0", "k1", "start", "end", F.explode("patterns").alias("pattern"))
           .join(good, "pattern").select(*place).unionByName(fresh.where("seed").select(*place)))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    spans = (found.where("kind <> ''").select("k0", "k1", "kind", "start", "end").unionByName(new)
             .groupBy("k0", "k1").agg(F.sort_array(F.collect_set(F.struct(order.alias("o"), "start", "end", "kind"))).alias("s"))
             .select(F.col("k0").alias(f"{mark}0"), F.col("k1").alias(f"{mark}1"),
                     F.transform("s", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias(f"{mark}s")))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    # the keys are columns, so that the texts themselves stay out of the join where nobody reads them
    marked = df.withColumns({f"{mark}a": own, f"{mark}b": text_mark})
    return (marked.join(spans, marked[f"{mark}a"].eqNullSafe(spans[f"{mark}0"]) & (marked[f"{mark}b"] == spans[f"{mark}1"]), "left")
            .withColumn(out, F.coalesce(F.col(f"{mark}s"), empty)).drop(*(f"{mark}{x}" for x in "ab01s")))


def redact(df: DataFrame, spans: str = "spans", text: str = "text") -> DataFrame:
    """Replace every span of the text by its kind in brackets; overlapping spans are replaced together."""
    @F.pandas_udf("string")
    def clean(t: pd.Series, marks: pd.Series) -> pd.Series:
        out = []
        for s, found in zip(t, marks):
            parts, at = [], 0
            for kind, a, b in sorted(((x["kind"], x["start"], x["end"]) for x in found), key=lambda x: (x[1], -x[2])):
                if a >= at:
                    parts += [s[at:a], f"[{kind.upper()}]"]
                at = max(at, b)
            out.append("".join([*parts, s[at:]]) if at else s)
        return pd.Series(out, dtype=object)

    return df.withColumn(text, F.when(F.size(col(spans)) > 0, clean(text_of(text), col(spans))).otherwise(col(text)))
