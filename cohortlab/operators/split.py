"""Stratified hold-out, subject-level split and stratified k-fold (M3, M4, M8).

Ordering is a seeded hash, ``md5(key ':' seed)``, so a split is reproducible
anywhere (DuckDB computes the same md5). No step ranks the whole data set in
one partition:

* Hold-out (M3): per class the ``n_test`` smallest hashes are test rows. The
  cut is found from counts per (class, hash prefix) — a small table — plus
  one ranking inside the single boundary prefix of each class; every row is
  then classified by comparing its hash with its class threshold (a scalar
  map), with no shuffle of the data itself.
* k-fold (M8): the exact within-class rank is ``offset(class, prefix) +
  row_number() within (class, prefix)``; the window is partitioned by
  (class, prefix), so a hot class is spread over 16^digits tasks.

Quotas follow the stratified shuffle split rule: n_test = ceil(n * p); train
quotas per class by largest remainder (ties to the smaller class value), test
quota = class count − train quota.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.columns import q, stable_hash_hex
from cohortlab.operators.stats import first_per_group


def quota_table(counts: dict, test_size: float = 0.2) -> dict:
    """{class: (n_class, n_train, n_test)} by the largest-remainder rule (pure Python, one entry per class)."""
    n = sum(counts.values())
    n_train_total = n - math.ceil(n * float(test_size))
    cont = {c: k / n * n_train_total for c, k in counts.items()}
    base = {c: math.floor(v) for c, v in cont.items()}
    need = n_train_total - sum(base.values())
    order = sorted(counts, key=lambda c: (-(cont[c] - base[c]), c))
    extra = set(order[:need])
    return {c: (counts[c], base[c] + (c in extra), counts[c] - base[c] - (c in extra)) for c in counts}


def class_quotas(df: DataFrame, cls: str, test_size: float = 0.2) -> DataFrame:
    """(cls, n_class, n_train, n_test) per class value (nulls form no class).

    One grouped count; the per-class table (one row per class) is finished on the driver.
    """
    counts = {r["cls"]: r["n"] for r in df.where(F.col(q(cls)).isNotNull())
              .groupBy(F.col(q(cls)).alias("cls")).agg(F.count(F.lit(1)).alias("n")).collect()}
    field = df.schema[cls]
    rows = [(c, *v) for c, v in sorted(quota_table(counts, test_size).items())] if counts else []
    return df.sparkSession.createDataFrame(
        rows, f"`{cls}` {field.dataType.simpleString()}, n_class long, n_train long, n_test long")


def _prefix(h, digits: int):
    return F.substring(h, 1, digits)


def stratified_holdout(df: DataFrame, cls: str, key: str, test_size: float = 0.2, seed: int = 42,
                       digits: int = 4, out: str = "split") -> DataFrame:
    """M3: adds ``split`` = 'test' / 'train' (null class → 'train'). Keys must be unique."""
    quotas = class_quotas(df, cls, test_size).select(F.col(q(cls)).alias("cls"), "n_test")
    h = stable_hash_hex(F.col(q(key)), seed)
    base = df.select(F.col(q(cls)).alias("cls"), h.alias("h")).where(F.col("cls").isNotNull())
    base = base.withColumn("b", _prefix(F.col("h"), digits))
    per_b = base.groupBy("cls", "b").agg(F.count(F.lit(1)).alias("nb"))
    wcum = Window.partitionBy("cls").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = per_b.select("*", F.sum("nb").over(wcum).alias("cum"))
    cum = cum.join(quotas, "cls")
    # boundary prefix of each class: the first prefix whose cumulative count reaches n_test
    boundary = (cum.where((F.col("cum") >= F.col("n_test")) & (F.col("n_test") > 0))
                .groupBy("cls").agg(F.min_by(F.struct("b", (F.col("n_test") - F.col("cum") + F.col("nb")).alias("need")),
                                             F.col("b")).alias("x"))
                .select("cls", F.col("x.b").alias("b"), F.col("x.need").alias("need")))
    inb = base.join(boundary, ["cls", "b"])
    wr = Window.partitionBy("cls").orderBy("h")
    thr = (inb.select("cls", "h", "need", F.row_number().over(wr).alias("rn"))
           .where(F.col("rn") == F.col("need")).select("cls", "h"))
    # one small action: at most one threshold per class
    thresholds = {r["cls"]: r["h"] for r in thr.collect()}
    if thresholds:
        thr_map = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(v))])
        t = F.element_at(thr_map, F.col(q(cls)))
    else:
        t = F.lit(None).cast("string")
    is_test = F.coalesce(stable_hash_hex(F.col(q(key)), seed) <= t, F.lit(False))
    return df.withColumn(out, F.when(is_test, "test").otherwise("train"))


def stratified_rank(df: DataFrame, cls: str, key: str, seed: int = 42, digits: int = 3,
                    out: str = "rank") -> DataFrame:
    """1-based rank of every row inside its class in hash order (bucketed prefix sums)."""
    h = stable_hash_hex(F.col(q(key)), seed)
    base = df.select("*", h.alias("__h")).withColumn("__b", _prefix(F.col("__h"), digits))
    per_b = base.groupBy(F.col(q(cls)).alias("__c"), "__b").agg(F.count(F.lit(1)).alias("__nb"))
    wcum = Window.partitionBy("__c").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offs = per_b.select("__c", "__b", F.coalesce(F.sum("__nb").over(wcum), F.lit(0)).alias("__off"))
    j = base.join(offs, (base[q(cls)].eqNullSafe(offs["__c"])) & (base["__b"] == offs["__b"]))
    w = Window.partitionBy("__c", base["__b"]).orderBy("__h")
    return (j.select(*[base[q(c)] for c in df.columns],
                     (F.col("__off") + F.row_number().over(w)).alias(out)))


def stratified_kfold(df: DataFrame, cls: str, key: str, k: int = 5, seed: int = 42, digits: int = 3,
                     out: str = "fold") -> DataFrame:
    """M8: fold = (rank within class − 1) mod k; every fold gets each class in near-equal share."""
    r = stratified_rank(df, cls, key, seed, digits, out="__rank")
    return r.withColumn(out, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank")


def subject_split(df: DataFrame, subject: str, target: str, order: str, test_size: float = 0.2,
                  seed: int = 42, digits: int = 4, out: str = "split") -> DataFrame:
    """M4: split subjects (label = target of the subject's first row), rows follow their subject.

    Guarantees zero subject overlap between train and test.
    """
    subjects = first_per_group(df, subject, target, order)
    ss = stratified_holdout(subjects, target, subject, test_size, seed, digits, out="__s")
    s = ss.select(F.col(q(subject)).alias("__subj"), "__s")
    j = df.join(s, F.col(q(subject)).eqNullSafe(F.col("__subj")), "left")
    return j.withColumn(out, F.coalesce(F.col("__s"), F.lit("train"))).drop("__subj", "__s")
