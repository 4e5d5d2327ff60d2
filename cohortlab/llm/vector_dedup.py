"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one vector kept a group.

Method. Equal vectors collapse to one with a count. Spherical k-means is fitted on a bounded sample (the vectors with
the smallest hashes); centroids that lie within the link angle of an earlier one are dropped, so a dense group stays
in one cell. Every vector goes to its ``probes`` nearest cells; two vectors are compared in the first cell that both
probe. Large cells are dealt out as pairs of blocks, and each task multiplies two blocks at a time. A task returns for
each vector the count of its links and edges of a spanning forest, never pairs. Components are the smallest reachable
id by repeated star contraction.

Only the cells are approximate: a link is missed if its ends share none of their probed cells. ``measure_recall``
holds the links against brute force for a set of query rows. The number of cells grows as the root of the rows, and so
do the fit's sample and the broadcast centroids (``SAMPLE`` rows a cell).

Defined cases: null, empty and zero vectors and those with null or non-finite components link with nothing; vectors of
different length never link; equal vectors link as copies; rows with a null id take part in counts but give no
component but their own (null); repeated ids are one vector each, their component the id. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import col, components, cut

SAMPLE, BLOCK = 16, 1024


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, apart: float = 0.9) -> np.ndarray:
    """Centroids of unit rows: seeded by the first rows that lie apart from one another, moved to their cells' means."""
    seeds = np.zeros((0, x.shape[1]))
    for a in range(0, len(x), 256):
        for v in x[a:a + 256]:
            if len(seeds) < k and (not len(seeds) or (seeds @ v).max() < apart):
                seeds = np.vstack([seeds, v])
        if len(seeds) == k:
            break
    c = seeds
    for _ in range(rounds):
        near = np.concatenate([(x[a:a + 4096] @ c.T).argmax(axis=1) for a in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.sqrt((total * total).sum(axis=1))
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1e-300)[:, None], c)
    kept: list[int] = []
    for i in range(len(c)):  # cells that met in one dense group become one
        if not kept or (c[kept] @ c[i]).max() < apart:
            kept.append(i)
    return c[kept]


def fit_cells(reps: DataFrame, n: int, cells: int | None = None) -> dict[int, np.ndarray]:
    """Centroids by vector length, fitted on a sample that grows as the root of the rows."""
    k = cells or max(1, math.ceil(2 * math.sqrt(n)))
    rows = reps.orderBy(F.xxhash64("h0", "h1"), "h0").limit(SAMPLE * k).select("v").toPandas()["v"]
    by_dim: dict[int, list] = {}
    for v in rows:
        by_dim.setdefault(len(v), []).append(v)
    total = sum(map(len, by_dim.values()))
    return {d: spherical_kmeans(_unit(np.array(v, float)), max(1, k * len(v) // total)) for d, v in by_dim.items()}


def _forest(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest member of each row's group under the links."""
    root = np.arange(n)
    changed = True
    while changed:
        old = root.copy()
        for i, j in links:
            low = np.minimum(root[i], root[j])
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
        root = np.minimum(root, root[root])
        changed = not np.array_equal(old, root)
    return root


def compare_cell(pdf: pd.DataFrame, cell: int, threshold: float, same_block: bool) -> pd.DataFrame:
    """Links counted (weighted by copies) and forest edges among the rows of one pair of blocks."""
    pdf = pdf.sort_values("rep", kind="stable").reset_index(drop=True)
    x = _unit(np.array(pdf["v"].tolist(), float))
    probes = np.array(pdf["probes"].tolist(), np.int64)
    copies, side = pdf["copies"].to_numpy(np.int64), pdf["block"].to_numpy()
    n, counts, links = len(pdf), np.zeros(len(pdf), np.int64), []
    left = np.arange(n) if same_block else np.flatnonzero(side == side.min())
    right = np.arange(n) if same_block else np.flatnonzero(side != side.min())
    for a in range(0, len(left), BLOCK):
        i = left[a:a + BLOCK]
        for b in range(a if same_block else 0, len(right), BLOCK):
            j = right[b:b + BLOCK]
            p, q = np.nonzero(x[i] @ x[j].T >= threshold)
            p, q = i[p], j[q]
            if same_block:
                p, q = p[p < q], q[p < q]
            if len(p):  # only in the first cell that both probe
                both = (probes[p][:, :, None] == probes[q][:, None, :]).any(axis=2)
                first = np.where(both, probes[p], np.iinfo(np.int64).max).min(axis=1) == cell
                p, q = p[first], q[first]
                counts += np.bincount(p, copies[q], n).astype(np.int64) + np.bincount(q, copies[p], n).astype(np.int64)
                links.append((p, q))
    root = _forest(n, links)
    hit = counts > 0
    rep = pdf["rep"].to_numpy()
    return pd.DataFrame({"rep": rep[hit], "links": counts[hit], "root": rep[root[hit]]})


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, probes: int = 4,
                 cells: int | None = None, block_rows: int = 4096) -> DataFrame:
    """(key, n_links, component_id, kept) for every row."""
    v = col(vector).cast("array<double>")
    good = (col(vector).isNotNull() & (F.size(v) > 0)
            & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    # -0.0 and 0.0 are one value; two hashes name a vector
    v = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = df.select(col(key).alias("id"), F.when(good, v).alias("v"))
    rows = rows.withColumn("h0", F.xxhash64("v")).withColumn("h1", F.xxhash64(F.lit(1), "v"))
    slim = rows.where("v IS NOT NULL")
    groups = cut(slim.groupBy("h0", "h1").agg(F.min("id").alias("rep_id"), F.count("*").alias("copies"), F.first("v").alias("v"))
                 .withColumn("rep", F.xxhash64("h0", "h1")))
    n = groups.count()
    if not n:
        return df.select(col(key).alias(key), F.lit(0).cast("long").alias("n_links"), col(key).alias("component_id"),
                         F.lit(True).alias("kept"))
    spark = df.sparkSession
    held = spark.sparkContext.broadcast(fit_cells(groups, n, cells))  # grows as the root of the rows

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            out = np.empty(len(pdf), object)
            size = pdf["v"].map(len).to_numpy()
            base = 0
            for d, c in sorted(held.value.items()):
                at = np.flatnonzero(size == d)
                if len(at):
                    dots = _unit(np.array(pdf["v"].iloc[at].tolist(), float)) @ c.T
                    m = min(probes, len(c))
                    top = np.argpartition(-dots, m - 1, axis=1)[:, :m] if m < len(c) else np.argsort(-dots, axis=1)
                    for i, row in zip(at, np.pad(np.sort(top, axis=1) + base, ((0, 0), (0, probes - m)), mode="edge")):
                        out[i] = row.tolist()
                base += len(c)
            for i in range(len(out)):
                if out[i] is None:  # a length that the sample lacks: a cell for each
                    out[i] = [-int(size[i])] * probes
            yield pdf.assign(probes=list(out))

    placed = cut(groups.select("rep", "copies", "v").mapInPandas(assign, "rep long, copies long, v array<double>, probes array<long>"))
    spread = placed.withColumn("cell", F.explode(F.array_distinct("probes")))
    blocks = (spread.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("blocks")))
    dealt = (spread.join(blocks, "cell").withColumn("block", F.pmod(F.hash("rep"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")))

    def compare(keys, pdf: pd.DataFrame) -> pd.DataFrame:
        return compare_cell(pdf, int(keys[0]), threshold, keys[1] == keys[2])

    found = cut(dealt.select("cell", "lo", "hi", "rep", "copies", "v", "probes", "block").groupBy("cell", "lo", "hi")
                .applyInPandas(compare, "rep long, links long, root long"))
    # names for components: the smallest id of the vector's copies
    ids = groups.select("rep", "rep_id")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    edges = (found.where("rep <> root").select("rep", "root").distinct().join(ids, "rep")
             .join(ids.select(F.col("rep").alias("root"), F.col("rep_id").alias("root_id")), "root"))
    linked = components(edges.select(F.col("rep_id").alias("a"), F.col("root_id").alias("b")))
    named = (groups.select("h0", "h1", "rep", "rep_id", "copies").join(links, "rep", "left")
             .join(linked, F.col("rep_id") == F.col("node"), "left")
             .select("h0", "h1", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                     F.coalesce("component", "rep_id").alias("component")))
    out = (rows.select("id", F.when(F.col("v").isNotNull(), F.col("h0")).alias("h0"), F.when(F.col("v").isNotNull(), F.col("h1")).alias("h1"))
           .join(named, ["h0", "h1"], "left")
           .withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))))
    return out.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def measure_recall(df: DataFrame, found: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9,
                   every: int = 100) -> float:
    """Links found over links by brute force, for the query rows whose key is divisible by ``every``, against all rows
    in blocks (the query vectors, a hundredth of the rows, travel in the closure: for tests and audits)."""
    queries = df.where(F.pmod(col(key), F.lit(every)) == 0).select(col(key).alias("k"), col(vector).alias("v")).toPandas()
    if not len(queries):
        return 1.0
    q = _unit(np.array(queries["v"].tolist(), float))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                hits = (_unit(np.array(pdf["v"].tolist(), float)) @ q.T >= threshold).sum(axis=0)
                yield pd.DataFrame({"k": queries["k"], "n": hits})

    want = (df.select(col(vector).alias("v")).mapInPandas(count, "k long, n long").groupBy("k").agg((F.sum("n") - 1).alias("n"))
            .agg(F.sum("n")).first()[0])
    got = found.where(F.pmod(col(key), F.lit(every)) == 0).agg(F.sum("n_links")).first()[0]
    return got / want if want else 1.0
