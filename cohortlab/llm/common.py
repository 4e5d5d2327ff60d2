"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.session import ensure_checkpoint_dir, ship_package


#: Rows of an Arrow batch: documents are long, and Python workers keep the memory of their largest batch.
BATCH_ROWS = 1_000


def ready(spark: SparkSession) -> None:
    """Give the workers the package, and Arrow batches that fit documents where the session has Spark's default."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (the path may be of any store that Spark knows)."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have yet (names are compared without case, as Spark does)."""
    taken, name = {c.lower() for c in df.columns}, f"__{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keep_clashes(df: DataFrame, *added: str) -> tuple[DataFrame, dict[str, str]]:
    """The frame with every column whose name is among ``added`` (without case) renamed by a trailing ``_in``, as often
    as needed to be free, so that new columns of those names can be added; and the new names by the old ones."""
    new, taken = {a.lower() for a in added}, {c.lower() for c in df.columns}
    names, changed = [], {}
    for c in df.columns:
        name = c
        if c.lower() in new:
            while name.lower() in new or name.lower() in taken:
                name += "_in"
            taken.add(name.lower())
            changed[c] = name
        names.append(name)
    return (df.toDF(*names) if changed else df), changed


def col(name: str) -> Column:
    """A top-level column whose name may hold dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def crc_mod(name: str, m: int) -> Column:
    """crc32 of a key as text, modulo m; a null key counts as the text 'null'."""
    return (F.crc32(F.encode(F.coalesce(col(name).cast("string"), F.lit("null")), "utf-8")) % F.lit(m)).cast("int")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that the cluster shares (spark.checkpoint.dir)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, stem: str) -> DataFrame:
    """The frame written as Parquet in the shared folder and read again: lineage ends, and Spark knows its size, so
    it broadcasts it in joins where that is small enough and shuffles it where not."""
    path = shared_folder(df.sparkSession, stem)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, component): the smallest node that is reachable from each node that has a link.

    Alternates large-star and small-star steps: every node links its larger neighbours, then its smaller
    ones, to the smallest node it sees, so paths shorten by half or more a round and no group is ever gathered.
    Each step is one aggregation with map-side combine and one join whose hot side Spark can split; lineage is
    cut every round. Nulls and self links are ignored; an empty frame gives an empty result.
    """
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
            .where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = cut(small.select(F.col("u"), F.col("m").alias("v"))
                .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                .distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(
                F.min("component").alias("component"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def range_bounds(df: DataFrame, key: str, parts: int, per_part: int = 32) -> list[int]:
    """Upper bounds (exclusive) that cut the integer ``key`` into about ``parts`` even ranges.

    The same rows always give the same bounds: the sample is chosen by a hash of the key, about ``per_part`` keys
    a range, which is all that the driver sees. Null keys belong to the first range.
    """
    ids = df.select(col(key).cast("long").alias("k")).where("k IS NOT NULL")
    n = ids.count()
    if n == 0 or parts <= 1:
        return []
    every = max(1, n // (parts * per_part))
    keys = [r.k for r in ids.where(F.pmod(F.xxhash64("k"), F.lit(every)) == 0).distinct().orderBy("k").collect()]
    return sorted({keys[i * len(keys) // parts] for i in range(1, parts)}) if keys else []


def range_part(key: str, bounds: list[int]) -> Column:
    """Number of the range of ``range_bounds`` in which a key lies."""
    cuts, low = np.array(bounds, np.int64), -(2**63)

    @F.pandas_udf("int")
    def part(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(np.int64), "right").astype(np.int32))

    return part(F.coalesce(col(key).cast("long"), F.lit(low)))


def shared_folder(spark: SparkSession, stem: str) -> str:
    """A new name in the folder that driver and executors share (under spark.checkpoint.dir)."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{stem}-{uuid.uuid4().hex}"


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file (the same on every worker)."""
    import public_tokenizers

    return public_tokenizers.path(name)
