"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

Method. A text is cut without loss: sections end after empty lines, paragraphs after line ends, leaves after
sentences (long ones are cut at widths that depend on their place in the paragraph alone). A leaf's digest is a hash of its
text, a parent's a hash of its children's digests, so equal roots mean equal texts and a walk that descends only
where digests differ finds the edited leaves. The fingerprint is a string of the tree: the root, then per section
its digest and paragraphs, per paragraph its digest and leaves, per leaf digest and length.

Likeness of two fingerprints: 1 for equal roots; else twice the characters under matching branches (sections, then
paragraphs of unmatched sections, then leaves of unmatched paragraphs, each as multisets) over all characters.

Defined cases: null text counts as empty; the empty text's tree has no section, and two empty texts are alike (1).
Rows with equal ids follow each other by a hash of their texts; null ids come first; ids are whole numbers. Extra columns
are not read by ``edited_pairs``; ``fingerprints`` keeps them, but replaces one named like its result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import col, range_bounds, range_part, text_of

_SECTION = re.compile(r".+?(?:\n[ \t\r]*(?=\n)\n+|\Z)", re.S).findall
_PARAGRAPH = re.compile(r"[^\n]*\n+|[^\n]+").findall
_SENTENCE = re.compile(r"[^.!?]*[.!?]+\s*|[^.!?]+").findall


def _digest(data: bytes, size: int = 8) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def _paragraph(text: str, opening: bool) -> tuple[bytes, int, list[tuple[bytes, int]]]:
    """(digest, length, leaves). Cuts depend on what stands before them only, so an edit at the end of a paragraph
    keeps the leaves before it: widths grow with the place in it, from 16 (4 where a text opens) to 256."""
    leaves, at = [], 0
    for s in _SENTENCE(text):
        i = 0
        while i < len(s):
            width = 4 if opening and at < 64 else min(256, max(16, 1 << (at // 4).bit_length() >> 1))
            part = s[i:i + width]
            leaves.append((_digest(part.encode("utf-8", "surrogatepass")), len(part)))
            i += len(part)
            at += len(part)
    return _digest(b"p" + b"".join(d for d, _ in leaves)), len(text), leaves


class Tree:
    """The tree of one text; ``memo`` shares paragraphs between similar texts."""

    def __init__(self, text: str, memo: dict | None = None):
        memo = {} if memo is None else memo
        self.sections = []
        for i, s in enumerate(_SECTION(text)):
            parts = []
            for j, p in enumerate(_PARAGRAPH(s)):
                if (got := memo.get((p, i + j == 0))) is None:
                    got = memo[p, i + j == 0] = _paragraph(p, i + j == 0)
                parts.append(got)
            self.sections.append((_digest(b"s" + b"".join(d for d, _, _ in parts)), len(s), parts))
        self.root = _digest(b"r" + b"".join(d for d, _, _ in self.sections), 16)

    def __str__(self) -> str:
        return self.root.hex() + "".join(
            "|" + d.hex() + "".join(
                ";" + e.hex()[:8] + "".join(f",{leaf.hex()[:8]}.{n}" for leaf, n in leaves) for e, _, leaves in parts)
            for d, _, parts in self.sections)


def parse(fingerprint: str) -> tuple[str, list]:
    """(root, sections) of a fingerprint; a section is (digest, length, paragraphs), and so on."""
    root, *sections = fingerprint.split("|")
    out = []
    for s in sections:
        digest, *paragraphs = s.split(";")
        parts = []
        for p in paragraphs:
            own, *leaves = p.split(",")
            pairs = [(x[:8], int(x[9:])) for x in leaves]
            parts.append((own, sum(n for _, n in pairs), pairs))
        out.append((digest, sum(n for _, n, _ in parts), parts))
    return root, out


def _unmatched(a: list, b: list) -> tuple[int, list, list]:
    """Characters under nodes that both lists have, and the nodes that only one has."""
    have, same, left = Counter(x[0] for x in b), 0, []
    for x in a:
        if have[x[0]] > 0:
            have[x[0]] -= 1
            same += x[1]
        else:
            left.append(x)
    right = []
    for x in reversed(b):
        if have[x[0]] > 0:
            have[x[0]] -= 1
            right.append(x)
    return same, left, right[::-1]


def likeness(a: tuple[str, list], b: tuple[str, list]) -> float:
    """Likeness of two parsed fingerprints, 0 to 1."""
    if a[0] == b[0]:
        return 1.0
    total = sum(n for _, n, _ in a[1]) + sum(n for _, n, _ in b[1])
    same, left, right = _unmatched(a[1], b[1])
    more, left, right = _unmatched([p for s in left for p in s[2]], [p for s in right for p in s[2]])
    last, _, _ = _unmatched([x for p in left for x in p[2]], [x for p in right for x in p[2]])
    return min(1.0, 2 * (same + more + last) / total) if total else 0.0


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """Spans (code points of the first text) of the leaves that the second fingerprint lacks, merged."""
    left, right = parse(a), parse(b)
    if left[0] == right[0]:
        return []
    sections = Counter(s[0] for s in right[1])
    paragraphs = Counter(p[0] for s in right[1] for p in s[2])
    leaves = Counter(x[0] for s in right[1] for p in s[2] for x in p[2])
    at, out = 0, []
    for digest, length, parts in left[1]:
        if sections[digest] > 0:
            sections[digest] -= 1
            at += length
            continue
        for own, n, pairs in parts:
            if paragraphs[own] > 0:
                paragraphs[own] -= 1
                at += n
                continue
            for leaf, m in pairs:
                if leaves[leaf] > 0:
                    leaves[leaf] -= 1
                elif out and out[-1][1] == at:
                    out[-1] = (out[-1][0], at + m)
                else:
                    out.append((at, at + m))
                at += m
    return out


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of every whole text (one pass, no shuffle)."""
    @F.udf("string", useArrow=True)
    def tree(t: str) -> str:
        return str(Tree(t or ""))

    return df.withColumn(out, tree(text_of(text)))


def with_next(df: DataFrame, rows, schema: str, key: str = "doc_id", text: str = "text",
              partitions: int | None = None) -> DataFrame:
    """Walk all rows in the order of ``key`` and give ``rows`` each text with the next one.

    ``rows(iterator of (key, text, next text))`` yields Arrow batches of ``schema``; after the last row comes the
    first. Rows are dealt out by ranges of the key (deterministic bounds) and sorted within them; the first row of a
    range is also sent to the range before, so one shuffle moves every text once and a task holds two rows and a
    batch. The driver sees one key a range.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(df, key, parts)
    base = df.select(col(key).alias("k"), text_of(text).alias("t"))
    first = {r.p: None if r.n > r.m else r.k for r in base.select("k", range_part("k", bounds).alias("p"))
             .groupBy("p").agg(F.min("k").alias("k"), F.count("*").alias("n"), F.count("k").alias("m")).collect()}
    order = sorted(first)
    before = {p: order[i - 1] for i, p in enumerate(order)}  # the first range's guest goes to the last
    guest = spark.createDataFrame([(first[p], before[p], p) for p in order], "gk long, gp int, own int") if order else None
    dealt = base.withColumn("p", range_part("k", bounds)).withColumn("guest", F.lit(False))
    if guest is not None:  # at most one row a range
        more = (base.join(F.broadcast(guest), F.col("k").eqNullSafe(F.col("gk")))
                .select("k", "t", F.col("gp").alias("p"), F.lit(True).alias("guest")))
        dealt = dealt.unionByName(more)
    dealt = (dealt.repartitionById(max(1, len(bounds) + 1), F.col("p"))
             .sortWithinPartitions("guest", F.col("k").asc_nulls_first(), F.xxhash64("t"))
             .select("k", "t", "guest"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            held, ended = None, False
            for batch in batches:
                for k, t, is_guest in zip(*(c.to_pylist() for c in batch.columns)):
                    if ended:
                        continue  # further rows with the guest's key
                    if held is not None:
                        yield (*held, t)
                    held, ended = (k, t), is_guest
        yield from rows(pairs())

    return dealt.mapInArrow(walk, schema)


def edited_pairs(df: DataFrame, key: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """Each text, its edited text (the last quarter replaced by as much of the next text) and the likeness of their
    fingerprints: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    kind = df.schema[key].dataType.simpleString()
    schema = (f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def rows(pairs) -> Iterator[pa.RecordBatch]:
        names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = [pa.int64() if kind == "bigint" else pa.int32(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        out, known = [], (None, None, None)

        def tree(t: str):
            nonlocal known
            if known[0] != t:
                said = str(Tree(t, memo := {}))
                known = (t, said, parse(said), memo)
            return known[1:]

        for k, t, after in pairs:
            said, own, memo = tree(t)
            n = len(t)
            edited = t[:n - n // 4] + after[:n // 4]
            edited_said = said if edited == t else str(Tree(edited, memo))
            _, following, _ = tree(after)
            out.append((k, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), said, edited_said,
                        likeness(own, parse(edited_said)), likeness(own, following)))
            if len(out) >= 512:
                yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(zip(*out), types)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(zip(*out), types)], names=names)

    return with_next(df, rows, schema, key, text, partitions)
