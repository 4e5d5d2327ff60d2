"""The butterfly's proofs against a tree built in plain Python, for groups of all awkward sizes, and odd rows."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortlab.llm import merkle_manifest as mm
from llm_samples import SF, needs_data


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(nodes, fanout):
    """(root, path of each node) of a list of nodes."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            base = p // fanout * fanout
            paths[i].append(("".join(nodes[base:p]), "".join(nodes[p + 1:base + fanout])))
            at[i] = p // fanout
        nodes = [h(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute(rows, fanout):
    """(group, key, leaf, subroot, root, path) of (group, key, leaf) rows."""
    groups = {}
    for g, k, leaf in rows:
        groups.setdefault(g, []).append((k is not None, k or 0, leaf, k))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    out, roots = [], []
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        roots.append(tree([x[2] for x in groups[g]], fanout))
    root, over = tree([r for r, _ in roots], fanout) if roots else (None, [])
    for g, (sub, paths), up in zip(names, roots, over):
        out += [(g, x[3], x[2], sub, root, p + up) for x, p in zip(groups[g], paths)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.lang, r.doc_id, r.leaf, r.subroot, r.root, [tuple(x) for x in r.path]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("fanout,height", [(8, 3), (3, 1), (2, 2)])
def test_proofs_against_plain_trees(spark, fanout, height):
    rows = [(g, i * 7 - 3, h(str(g), str(i))) for g, n in ((None, 5), ("", 1), ("de", 64), ("en", 131), ("fr", 33), ("Z", 8), ("é", 9), ("ä", 2), ("x", 65), ("y", 17))
            for i in range(n)]
    df = spark.createDataFrame(rows, "lang string, doc_id long, leaf string").withColumn("extra", F.lit("forged")).repartition(7)
    got = mm.manifest(df, carry=("extra",), fanout=fanout, height=height)
    assert rows_of(got) == brute(rows, fanout)
    checked = got.select((mm.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"),
                         (mm.fold(F.sha2("leaf", 256), F.col("path")) == F.col("root")).alias("bad"), "extra").distinct().collect()
    assert [tuple(r) for r in checked] == [(True, False, "forged")]


def test_repeated_and_null_keys(spark):
    rows = [("a", k, h(str(x))) for k, x in [(None, 1), (None, 2), (None, 2), (3, 5), (3, 4), (3, 4), (4, 9)] * 5]
    df = spark.createDataFrame(rows, "lang string, doc_id long, leaf string")
    assert rows_of(mm.manifest(df, fanout=2, height=1)) == brute(rows, 2)


def test_one_leaf_and_none(spark):
    one = spark.createDataFrame([("a", 1, h("x"))], "lang string, doc_id long, leaf string")
    assert rows_of(mm.manifest(one)) == [("a", 1, h("x"), h("x"), h("x"), [])]
    assert mm.manifest(one.where("doc_id = 2")).count() == 0


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def test_leaf_digest(spark, odd):
    got = odd.select("doc_id", "text", "source", mm.leaf_digest(F.col("doc_id"), F.col("source"), F.col("text")).alias("leaf"), mm.lower_ascii(F.col("text")).alias("low"))
    for r in got.collect():
        assert r.leaf == h(field(r.doc_id), field(r.source), field(r.text))
        assert r.low == (None if r.text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text))


@needs_data
def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    said = lambda r, t: h(field(r.doc_id), field(r.source), field(r.lang), field(r.n_chars), field(t))
    whole = {k: (leaf, sub, root, p) for _, k, leaf, sub, root, p in brute([(r.lang, r.doc_id, said(r, r.text)) for r in docs], 8)}
    got = {r.doc_id: r for r in entry.queries()["op13_merkle_manifest"](spark, SF).collect()}
    assert got.keys() == whole.keys()
    for r in docs:
        leaf, sub, root, path = whole[r.doc_id]
        node = leaf
        if zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
            node = said(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text))
        for left, right in path:
            node = h(left, node, right)
        x = got[r.doc_id]
        assert (x.leaf, x.subroot, x.root, x.proof_sha256) == (leaf, sub, root, h(*[a + b for a, b in path]))
        assert (x.folded_root, x.verified) == (node, node == root)
