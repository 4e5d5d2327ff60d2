"""Merkle manifest of a data set: a tree a group, a tree over the groups' roots, and the proof of every row.

Method. Rows become leaves (a digest of their fields); texts go no further. A range sort numbers the leaves of each group,
and every ``fanout ** height`` consecutive ones form a block, an aligned partition of the tree whose lower levels one task
hashes. Upwards the blocks work as a butterfly: in round r the blocks of a parent that have the same place within their own
subtrees meet, ``fanout`` at most, swap the subtree roots they hold, and each hashes the parent for itself. After every
round each block holds the root of a subtree ``fanout`` times as wide and the siblings on the way, so after the last one
it has the root and its whole upper proof, and nothing is sent down again. The last subtree of a level may have fewer blocks
than the others: its blocks also sit in the empty places. The same tree is then built over the groups' roots.

Cost. Leaves are shuffled twice (range sort, blocks) at some 150 bytes each and joined to their blocks' proofs; a round
shuffles one row a block. No group is gathered: a group of any size is many blocks, and a round's meeting has at most
``fanout`` rows. The driver sees the largest group's number of leaves, which sets the number of rounds.

Defined cases: leaves ascend by key (nulls first), then by digest; equal rows are leaves of their own, and their order does
not matter. A null group is a group, the first of all; a group of one leaf has that leaf as its root, and a data set of
one group that group's root. An empty table gives no rows. Null fields count as ``-``. Columns that are not named are
not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import col, stored


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: each field as ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _joined(nodes: Column, first, length) -> Column:
    return F.array_join(F.slice(nodes, first, length), "")


def _numbered(df: DataFrame) -> DataFrame:
    """(g, key, leaf, ...) with ``pos``, the place of a leaf in its group from 0, and ``n``, the leaves of the group.

    One range shuffle sorts the rows; places inside a range come from the row numbers of its task, those of the ranges
    before from one count a range and group. The number that parts equal rows lets ranges split them too.
    """
    order = [F.col("g").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf"), F.col("tie")]
    dealt = (df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
             .drop("tie").withColumn("seq", F.monotonically_increasing_id()))
    dealt = stored(dealt, "leaves").withColumn("range", F.shiftright("seq", 33))
    group = Window.partitionBy("g")
    runs = (dealt.groupBy("g", "range").agg(F.min("seq").alias("first"), F.count("*").alias("rows"))
            .withColumn("n", F.sum("rows").over(group))
            .withColumn("before", F.sum("rows").over(group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)))
            .select(F.col("g").alias("rg"), F.col("range").alias("rr"), "n", (F.coalesce("before", F.lit(0)) - F.col("first")).alias("shift")))
    runs = stored(runs, "ranges")
    return (dealt.join(runs, F.col("g").eqNullSafe(F.col("rg")) & (F.col("range") == F.col("rr")))
            .withColumn("pos", F.col("seq") + F.col("shift")).drop("rg", "rr", "seq", "range", "shift"))


def _depth(fanout: int) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    steps, width = F.lit(0), 1
    while width < 2**62:
        steps = steps + F.when(F.col("n") > F.lit(width), 1).otherwise(0)
        width *= fanout
    return steps


def _blocks(df: DataFrame, fanout: int, height: int) -> DataFrame:
    """One row a block: its leaves in order, its lower levels l0 ... and its node."""
    width = fanout**height
    fields = [c for c in df.columns if c not in ("g", "n", "pos")]
    out = (df.withColumn("block", F.floor(F.col("pos") / width).cast("long")).groupBy("g", "n", "block")
           .agg(F.sort_array(F.collect_list(F.struct("pos", *fields))).alias("leaves"))
           .withColumn("depth", _depth(fanout)).withColumn("l0", F.col("leaves.leaf")))
    for k in range(height):
        below = F.col(f"l{k}")
        parents = F.transform(F.sequence(F.lit(0), F.floor((F.size(below) - 1) / fanout).cast("int")),
                              lambda i: F.sha2(_joined(below, i * fanout + 1, F.lit(fanout)), 256))
        out = out.withColumn(f"l{k + 1}", F.when(F.col("depth") > k, parents).otherwise(below))
    out = out.withColumn("node", F.element_at(f"l{height}", 1)).drop("l0", f"l{height}")
    return stored(out, "blocks")


def _butterfly(blocks: DataFrame, fanout: int, height: int) -> DataFrame:
    """(g, block, up, subroot): the siblings above every block and the root of its group."""
    width = fanout**height
    state = blocks.select("g", "block", "depth", "node", F.ceil(F.col("n") / width).cast("long").alias("blocks"),
                          F.expr("CAST(array() AS array<struct<left:string,right:string>>)").alias("up"))
    deepest = blocks.agg(F.max("depth").alias("d")).first().d or 0
    for r in range(max(0, deepest - height)):
        size = fanout**r
        below = state.withColumn("sub", F.floor(F.col("block") / size).cast("long")).withColumn("place", F.col("block") % size)
        last = F.floor((F.col("blocks") - 1) / size).cast("long")
        there = F.col("blocks") - last * size  # blocks in the last subtree
        alone = (F.col("sub") < last) | (last % fanout == 0) | (there == size)
        seats = F.when(alone, F.array("place")).otherwise(F.sequence("place", F.lit(size - 1).cast("long"), there))
        met = Window.partitionBy("g", F.floor(F.col("sub") / fanout), "seat")
        swapped = (below.withColumn("seat", F.explode(seats))
                   .withColumn("own", (F.col("sub") % fanout).cast("int"))
                   .withColumn("nodes", F.sort_array(F.collect_list(F.struct("own", "node")).over(met))["node"])
                   .where("seat = place"))
        step = F.struct(_joined(F.col("nodes"), F.lit(1), F.col("own")).alias("left"),
                        _joined(F.col("nodes"), F.col("own") + 2, F.lit(fanout)).alias("right"))
        grows = F.col("depth") > height + r
        state = swapped.select("g", "block", "depth", "blocks",
                               F.when(grows, F.sha2(F.array_join("nodes", ""), 256)).otherwise(F.col("node")).alias("node"),
                               F.when(grows, F.concat("up", F.array(step))).otherwise(F.col("up")).alias("up"))
    return stored(state.select("g", "block", "up", F.col("node").alias("subroot")), "proofs")


def _leaves(blocks: DataFrame, proofs: DataFrame, fanout: int, height: int) -> DataFrame:
    """The rows of all blocks with their whole proofs: siblings inside the block, then those above it."""
    names = [f.name for f in blocks.schema["leaves"].dataType.elementType.fields]
    levels = [F.col("leaves.leaf"), *[F.col(f"l{k}") for k in range(1, height)]]

    def proved(leaf: Column, i: Column) -> Column:
        steps = []
        for k, nodes in enumerate(levels):
            at = F.floor(i / fanout**k).cast("int")
            own, base = at % fanout, F.floor(at / fanout).cast("int") * fanout
            step = F.struct(_joined(nodes, base + 1, own).alias("left"), _joined(nodes, base + own + 2, fanout - 1 - own).alias("right"))
            steps.append(F.when(F.col("depth") > k, step))
        return F.struct(*[leaf[f].alias(f) for f in names], F.array_compact(F.array(*steps)).alias("low"))

    renamed = proofs.withColumnsRenamed({"g": "pg", "block": "pb"})
    met = blocks.join(renamed, F.col("g").eqNullSafe(F.col("pg")) & (F.col("block") == F.col("pb")))
    kept = [c for c in renamed.columns if c not in ("pg", "pb")]
    return met.select("g", *kept, F.inline(F.transform("leaves", proved))).drop("pos")


def manifest(df: DataFrame, leaf: str = "leaf", key: str = "doc_id", group: str = "lang", carry: tuple[str, ...] = (),
             fanout: int = 8, height: int = 3) -> DataFrame:
    """Every row's place in the manifest: ``group``, ``key``, the columns ``carry``, then leaf, subroot, root and
    ``path``, the siblings left and right of the row's node from its own level up to the root's children.

    ``leaf`` names a column of leaf digests (see ``leaf_digest``). Folding a leaf over its path gives the root (``fold``).
    """
    if {*carry} & {key, group, "leaf", "subroot", "root", "path"}:
        raise ValueError("carried columns must differ from those of the manifest")
    clash = {c: f"carry{i}" for i, c in enumerate(carry)}
    rows = df.select(col(group).alias("g"), col(key).alias("key"), col(leaf).alias("leaf"), *[col(c).alias(n) for c, n in clash.items()])
    blocks = _blocks(_numbered(rows), fanout, height)
    proofs = _butterfly(blocks, fanout, height)
    groups = proofs.where("block = 0").select(F.lit(0).alias("g"), F.col("g").alias("key"), F.col("subroot").alias("leaf"))
    top = _blocks(_numbered(groups), fanout, height)
    over = (_leaves(top, _butterfly(top, fanout, height), fanout, height)
            .select(F.col("key").alias("tg"), F.concat("low", "up").alias("top"), F.col("subroot").alias("root")))
    proofs = proofs.join(stored(over, "groups"), F.col("g").eqNullSafe(F.col("tg"))).select("g", "block", F.concat("up", "top").alias("up"), "subroot", "root")
    out = _leaves(blocks, proofs, fanout, height)
    return out.select(F.col("g").alias(group), F.col("key").alias(key), *[F.col(n).alias(c) for c, n in clash.items()],
                      "leaf", "subroot", "root", F.concat("low", "up").alias("path"))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives over a path."""
    return F.aggregate(path, leaf, lambda node, x: digest(x["left"], node, x["right"]))


def lower_ascii(text: Column) -> Column:
    """The text with A-Z in lower case and all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())
