"""Near-duplicate texts: DartMinHash signatures, banded joining, exact verification, one document kept a class.

Method. A text is its word shingles (five words), each an element with a weight (1, or its count). Every element owns a
region, its weight by all ranks, into which darts are thrown by hash: the region is cut into cells whose number of darts
is a hashed Poisson draw, each dart has a hashed weight, rank and coordinate. A text sees the darts below its weights and
below a rank at which about k ln k + 2k darts are expected, however many elements it has; the earliest dart of each of
the k coordinates is the signature, and two texts agree in a coordinate with the probability of their weighted Jaccard
similarity. Rows of coordinates form bands; texts that share a band meet in a bucket.

Equal texts collapse to one node first. Buckets with the same members count once. Small buckets give a spanning forest of
their most alike signatures, buckets of more than a block a star: linear in their members, never all pairs. The families
that these edges span hold every pair that shares a band. Each family is then compared block against block: signatures
rule out the pairs that cannot reach the similarity (by four standard deviations), whole shingle sets decide the others,
and a task returns a spanning forest of its links. So links are lost only where the bands miss: with 26 bands of 5, one in
30,000 at a similarity of 0.8, and fewer in families, whose members meet all others.

Defined cases: null text counts as empty; texts below five words are one shingle; texts without words are alike only if
equal; rows with equal texts are one class; a class id is the smallest id in it (null only if it has none). ``near_texts``
marks all rows of that id as kept; ``keep_one`` keeps the rows of that id with one text of the class (ids may repeat with
other texts), or one row of a class without an id. Extra columns are not read by ``near_texts``, and pass through ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import col, components, cut, stored, text_of, tidy_name

BANDS, ROWS, SHINGLE, BLOCK = 26, 5, 5, 512
_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _real(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers from 0 to 1."""
    return (x >> np.uint64(11)) * 2.0**-53


def shingles(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word shingles and their counts."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for i in range(n):
        out = _mix(out * _M3 + h[i:len(h) - n + 1 + i])
    return np.unique(out, return_counts=True)


#: Lower ends and widths of the first rank cells; after them every cell has width 1.
_LOW = np.array([0.0, *[2.0**-i for i in range(6, 0, -1)]])
_WIDE = np.array([2.0**-6, *[2.0**-i for i in range(6, 0, -1)]])


def _darts(element: np.ndarray, weight: np.ndarray, limit: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, rank, coordinate) of all darts in the regions below the weights and the rank limit."""
    names, ranks = [], []
    start, width, level = 0.0, 1.0, 0
    while (inside := weight > start).any():
        e, w = element[inside], weight[inside]
        top = limit * width  # ranks of a wider level are scaled, so a cell holds one dart at most on average
        low = np.concatenate([_LOW[_LOW < top], np.arange(1.0, max(1.0, np.ceil(top)))])
        wide = np.concatenate([_WIDE[:len(_LOW[_LOW < top])], np.ones(len(low) - (_LOW < top).sum())])
        cell = _mix(np.arange(len(low), dtype=np.uint64) * _M3 + np.uint64(level + 1))
        h = _mix(e[:, None] ^ cell[None, :])
        u, p = _real(h), np.exp(-wide)
        at = np.flatnonzero(u >= p)
        if len(at):
            i, j = np.divmod(at, len(low))
            lam, u, h = wide[j], u.ravel()[at], h.ravel()[at]
            term, total, d = p[j], p[j].copy(), 1
            while len(u):
                dart = _mix(h + np.uint64(d * int(_M3) % 2**64))
                rank = (low[j] + wide[j] * _real(_mix(dart ^ _M1))) / width
                seen = (rank < limit) & (start + width * _real(_mix(dart ^ _M2)) < w[i])
                names.append(dart[seen])
                ranks.append(rank[seen])
                term = term * lam / d  # Poisson: is there another dart in the cell?
                total = total + term
                more = u >= total
                i, j, u, h, lam, term, total, d = i[more], j[more], u[more], h[more], lam[more], term[more], total[more], d + 1
        start, width, level = start + width, width if level == 0 else width * 2, level + 1
    name, rank = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((names, np.uint64), (ranks, float)))
    return name, rank, (_mix(name ^ _M3) % np.uint64(k)).astype(np.int64)


def signature(element: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Names of the earliest dart of each of ``k`` coordinates."""
    limit = (k * np.log(k) + 2 * k) / weight.sum()
    while True:
        name, rank, coordinate = _darts(element, weight, limit, k)
        order = np.lexsort((name, rank, coordinate))
        coordinate = coordinate[order]
        first = np.concatenate([[True], coordinate[1:] != coordinate[:-1]]) if len(order) else np.zeros(0, bool)
        if first.sum() == k:
            return name[order][first]
        limit *= 2


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band of a signature."""
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        out = _mix(out * _M3 + sig[r * bands:(r + 1) * bands])
    return out.view(np.int64)


def _hashes(text: str) -> tuple[Column, Column]:
    """The two hashes that name a text."""
    return F.xxhash64(text_of(text)), F.xxhash64(F.lit(1), text_of(text))


def sign(df: DataFrame, key: str, text: str, bands: int, rows: int, size: int, counted: bool) -> DataFrame:
    """(id, h0, h1, sig, bands): key, two hashes of the text, a byte of every coordinate and the band hashes; the last two
    are null in some rows of a text that has several."""
    h0, h1 = _hashes(text)
    src = df.select(col(key).cast("long").alias("id"), h0.alias("h0"), h1.alias("h1"), text_of(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, keys, known = [], [], set()
            for h, t in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                got = None, None  # a copy: the first row of the batch has its signature
                if h not in known:
                    known.add(h)
                    element, count = shingles(t, size)
                    got = b"", np.zeros(0, np.int64)
                    if len(element):
                        s = signature(element, (count if counted else np.ones(len(count))).astype(float), bands * rows)
                        got = (s & np.uint64(255)).astype(np.uint8).tobytes(), band_keys(s, bands, rows)
                sigs.append(got[0])
                keys.append(got[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "h0", "h1", "sig", "bands"])

    return src.mapInArrow(run, "id long, h0 long, h1 long, sig binary, bands array<long>")


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal coordinates of all rows of one block with all of another."""
    return np.concatenate([(a[i:i + 32, None, :] == b[None, :, :]).mean(axis=2, dtype=np.float32) for i in range(0, len(a), 32)])


def _forest_pairs(node: np.ndarray, sig: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Spanning forest of a block by likeness, the most alike first."""
    like = np.triu(_alike(sig, sig), 1)
    i, j = np.nonzero(like >= least)
    root, out = list(range(len(node))), []

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for e in np.argsort(-like[i, j], kind="stable"):
        a, b = find(int(i[e])), find(int(j[e]))
        if a != b:
            root[a] = b
            out.append((node[i[e]], node[j[e]]))
            if len(out) == len(node) - 1:
                break
    return out


def _grouped(frames: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """The runs of equal ``by`` in sorted frames; a run is bounded by the blocks' size."""
    held = None
    for pdf in frames:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        new = (pdf[by] != pdf[by].shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(new)
        for a, b in zip(starts[:-1], starts[1:]):
            yield pdf.iloc[a:b]
        held = pdf.iloc[starts[-1]:]
    if held is not None and len(held):
        yield held


def _sigs(pdf: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)


def near_texts(df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8, bands: int = BANDS,
               rows: int = ROWS, size: int = SHINGLE, counted: bool = False) -> DataFrame:
    """(key, class_id, kept) for every row. ``counted``: elements weigh their counts (multisets) instead of 1."""
    return (_classes(df, key, text, similarity, bands, rows, size, counted)
            .select(F.col("id").alias(key), "class_id", F.coalesce(F.col("id") == F.col("class_id"), F.col("class_id").isNull()).alias("kept")))


def _classes(df: DataFrame, key: str, text: str, similarity: float, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE,
             counted: bool = False) -> DataFrame:
    """(id, h0, h1, class_id, head) for every row; ``head``: the row has the id and text that represent its class."""
    least = similarity - 4 * (similarity * (1 - similarity) / (bands * rows)) ** 0.5
    signed = stored(sign(df, key, text, bands, rows, size, counted), "signatures")
    nodes = stored(signed.groupBy("h0", "h1").agg(F.min("id").alias("rep"), F.first("sig", True).alias("sig"), F.first("bands", True).alias("bands"))
                   .withColumn("node", F.xxhash64("h0", "h1")), "texts")
    spread = nodes.select("node", F.posexplode("bands").alias("b", "v")).select("node", F.xxhash64("b", "v").alias("bucket"))
    # nodes are hashes already: their number, ends and xor tell apart buckets with other members
    buckets = (spread.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("other"), F.count("*").cast("int").alias("n"),
                                            F.bit_xor("node").alias("x"))
               .where("n > 1").groupBy("n", "centre", "other", "x").agg(F.min("bucket").alias("bucket")))
    buckets = cut(buckets.select("bucket", "n", "centre", "other"))
    pairs = buckets.where("n = 2").select(F.col("centre").alias("a"), F.col("other").alias("b"))
    members = cut(spread.join(buckets.where("n > 2").select("bucket", "n", "centre"), "bucket"))

    def forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _grouped(frames, ["bucket"]):
            got = _forest_pairs(pdf["node"].to_numpy(), _sigs(pdf), least)
            if got:
                yield pd.DataFrame(got, columns=["a", "b"])

    small = members.where(F.col("n") <= BLOCK).join(nodes.select("node", "sig"), "node").repartition("bucket").sortWithinPartitions("bucket", "node")
    edges = (pairs.unionByName(small.select("bucket", "node", "sig").mapInPandas(forest, "a long, b long"))
             .unionByName(members.where((F.col("n") > BLOCK) & (F.col("node") != F.col("centre")))
                          .select(F.col("centre").alias("a"), F.col("node").alias("b"))))
    family = components(edges)
    links = link_families(df, family, nodes.select("node", "sig"), text, similarity, least, size, counted)
    label = components(links)
    classes = nodes.select("h0", "h1", "node", "rep").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = classes.groupBy("component").agg(
        F.min("rep").alias("class_id"), F.min(F.struct(F.col("rep").isNull().alias("bare"), "rep", "h0", "h1")).alias("top"))
    classes = classes.join(names, "component").select("h0", "h1", "class_id", (F.struct("h0", "h1") == F.struct("top.h0", "top.h1")).alias("own"))
    return (signed.select(F.col("id"), "h0", "h1").join(classes, ["h0", "h1"])
            .select("id", "h0", "h1", "class_id", (F.col("own") & F.col("id").eqNullSafe(F.col("class_id"))).alias("head")))


def _sets(df: DataFrame, wanted: DataFrame, text: str, size: int, counted: bool) -> DataFrame:
    """(node, items): the sorted shingle hashes of the wanted text nodes; ``counted``: one item for each copy."""
    t = text_of(text)
    src = df.select(F.xxhash64(F.xxhash64(t), F.xxhash64(F.lit(1), t)).alias("node"), t.alias("t")).join(wanted, "node", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, at, sets = set(), [], []
            for i, (node, t) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                if node not in done:  # copies need one set
                    done.add(node)
                    element, count = shingles(t, size)
                    if counted:
                        element = np.unique(_mix(np.repeat(element, count) + np.concatenate([np.arange(c, dtype=np.uint64) for c in count]) * _M3))
                    at.append(i)
                    sets.append(element.view(np.int64))
            ends = np.cumsum([0, *map(len, sets)])
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())),
                                              pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["node", "items"])

    return src.mapInArrow(run, "node long, items array<long>").groupBy("node").agg(F.first("items").alias("items"))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Items that two sets without repeats share."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _links(node: np.ndarray, sig: np.ndarray, items: list, i: np.ndarray, j: np.ndarray, similarity: float,
           least: float) -> list[tuple[int, int]]:
    """Spanning forest of the links between the rows ``i`` and ``j`` of a block pair (the same rows: within them)."""
    root, out, sizes = list(range(len(node))), [], np.array([len(x) for x in items])

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    like = _alike(sig[i], sig[j])
    if len(i) == len(j) and (i == j).all():
        like = np.triu(like, 1)
    p, q = np.nonzero(like >= least)
    order = np.argsort(-like[p, q], kind="stable")
    p, q = i[p[order]], j[q[order]]
    fits = np.minimum(sizes[p], sizes[q]) >= similarity * np.maximum(sizes[p], sizes[q])
    for a, b in zip(p[fits].tolist(), q[fits].tolist()):
        x, y = find(a), find(b)
        if x != y:
            k = _common(items[a], items[b])
            if k >= similarity * (sizes[a] + sizes[b] - k):
                root[x] = y
                out.append((node[a], node[b]))
    return out


def link_families(df: DataFrame, family: DataFrame, sigs: DataFrame, text: str, similarity: float, least: float, size: int,
                  counted: bool) -> DataFrame:
    """Forest edges (a, b) of the links within families (node, component), block against block."""
    family = stored(family, "families")
    sets = _sets(df, family.select("node"), text, size, counted)
    sizes = family.groupBy("component").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("chunks"))
    full = (family.join(stored(sizes.where("chunks > 1"), "large-families"), "component", "left")
            .withColumn("chunks", F.coalesce("chunks", F.lit(1))).join(sigs, "node").join(sets, "node"))
    dealt = (full.withColumn("chunk", F.pmod(F.hash("node"), F.col("chunks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other"))
             .select("component", "lo", "hi", "chunk", "node", "sig", "items"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _grouped(frames, ["component", "lo", "hi"]):
            node, side = pdf["node"].to_numpy(), pdf["chunk"].to_numpy()
            lo, hi = pdf["lo"].iloc[0], pdf["hi"].iloc[0]
            got = _links(node, _sigs(pdf), pdf["items"].tolist(), np.flatnonzero(side == lo), np.flatnonzero(side == hi), similarity, least)
            if got:
                yield pd.DataFrame(got, columns=["a", "b"])

    by = ("component", "lo", "hi")
    return cut(dealt.repartition(*[F.col(c) for c in by]).sortWithinPartitions(*by, "node").mapInPandas(compare, "a long, b long"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """The document of ``df`` that represents each class: all rows that have its id and text, or one row where the class
    has no id; columns as they are."""
    marks = [tidy_name(df, m) for m in ("id", "h0", "h1")]
    own, h0, h1 = marks
    wide = df.withColumns(dict(zip(marks, (col(key).cast("long"), *_hashes(text)))))
    found = _classes(df, key, text, similarity).where("NOT head OR id IS NULL").select("id", "h0", "h1", "head").distinct()
    found = stored(found.toDF(*marks, "head"), "near-copies")
    gone = found.where(col(own).isNotNull()).drop("head")
    bare = found.where(col(own).isNull() & F.col("head")).select(h0, h1)
    # texts meet the list in a shuffle at every size, as they must where it is too long to broadcast
    return (wide.where(col(own).isNotNull()).join(gone.hint("merge"), marks, "left_anti").select(*map(col, df.columns))
            .union(wide.where(col(own).isNull()).dropDuplicates([h0, h1]).join(bare, [h0, h1], "left_semi").select(*map(col, df.columns))))
