"""Group and global statistics, correlations, distributions.

All measures of one operator are computed in ONE aggregation (partial
aggregation map-side, final after the shuffle), then unpivoted with
``inline`` when a long table is wanted. Standard deviations follow the
reference: sample (ddof=1) for pandas-style summaries, population for
numpy-style ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.columns import nan_to_null, q, safe_corr, truthy
from cohortlab.operators.merge import join_small_side
from cohortlab.operators.quantiles import exact_quantiles
from cohortlab.session import ship_package


def _v(c: str) -> Column:
    return nan_to_null(F.col(q(c)).cast("double"))


def group_stats(df: DataFrame, group: str, measures: list[str]) -> DataFrame:
    """Per non-null group value and measure: n, mean, sample std (nulls skipped)."""
    aggs = []
    for i, m in enumerate(measures):
        aggs += [F.count(_v(m)).alias(f"n{i}"), F.avg(_v(m)).alias(f"a{i}"), F.stddev_samp(_v(m)).alias(f"s{i}")]
    g = df.where(F.col(q(group)).isNotNull()).groupBy(F.col(q(group)).alias("grp")).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"n{i}").alias("n"),
                              F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("std"))
                     for i, m in enumerate(measures)])
    return g.select("grp", F.inline(rows)).where(F.col("n") > 0)


def global_stats(df: DataFrame, measures: list[str]) -> DataFrame:
    """Per measure n, mean, sample std, min, max, cv = std/mean (0 when mean <= 0)."""
    aggs = []
    for i, m in enumerate(measures):
        aggs += [F.count(_v(m)).alias(f"n{i}"), F.avg(_v(m)).alias(f"a{i}"), F.stddev_samp(_v(m)).alias(f"s{i}"),
                 F.min(_v(m)).alias(f"lo{i}"), F.max(_v(m)).alias(f"hi{i}")]
    g = df.agg(*aggs)
    rows = F.array(*[F.struct(
        F.lit(m).alias("measure"), F.col(f"n{i}").alias("n"), F.col(f"a{i}").alias("mean"),
        F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
        F.when(F.col(f"a{i}") > 0, F.col(f"s{i}") / F.col(f"a{i}")).otherwise(F.lit(0.0)).alias("cv"))
        for i, m in enumerate(measures)])
    return g.select(F.inline(rows))


def asymmetry_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per asymmetry column: n, mean, sample std, mean of absolute values."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count(_v(c)).alias(f"n{i}"), F.avg(_v(c)).alias(f"a{i}"),
                 F.stddev_samp(_v(c)).alias(f"s{i}"), F.avg(F.abs(_v(c))).alias(f"b{i}")]
    g = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(f"n{i}").alias("n"), F.col(f"a{i}").alias("mean"),
                              F.col(f"s{i}").alias("std"), F.col(f"b{i}").alias("abs_mean"))
                     for i, c in enumerate(columns)])
    return g.select(F.inline(rows))


def error_stats(df: DataFrame, column: str, accuracy: int | None = None) -> DataFrame:
    """N, mean, median, max, count < 0.01, count < 0.05, all < 0.01 over non-null errors."""
    v = _v(column)
    if accuracy is None:
        med = exact_quantiles(df, v, [0.5]).select("q0").scalar()
    else:
        med = F.percentile_approx(v, 0.5, accuracy).cast("double")
    return df.where(v.isNotNull()).agg(
        F.count(F.lit(1)).alias("n_validated"), F.avg(v).alias("mean_abs_error"), med.alias("median_abs_error"),
        F.max(v).alias("max_abs_error"), F.count_if(v < 0.01).alias("error_lt_0_01"),
        F.count_if(v < 0.05).alias("error_lt_0_05"), F.bool_and(v < 0.01).alias("all_lt_0_01"))


def fraction_sum_check(df: DataFrame, columns: list[str], lo: float = 0.99, hi: float = 1.01) -> DataFrame:
    """Row sum skipping nulls (all null → 0); its mean, sample std, count in (lo, hi)."""
    s = sum((F.coalesce(_v(c), F.lit(0.0)) for c in columns), F.lit(0.0))
    return df.select(s.alias("s")).agg(
        F.avg("s").alias("fraction_sum_mean"), F.stddev_samp("s").alias("fraction_sum_std"),
        F.count_if((F.col("s") > lo) & (F.col("s") < hi)).alias("fraction_sum_ok"))


def outcome_counts(df: DataFrame, status: str, kind: str = "regional") -> DataFrame:
    """Total, success, partial, failed. Tissue style counts every non-success as failed."""
    s = F.col(q(status))
    failed = truthy(s != "success") | s.isNull() if kind == "tissue" else truthy(s == "failed")
    return df.agg(F.count(F.lit(1)).alias("total_sessions"),
                  F.count_if(truthy(s == "success")).alias("successful_extractions"),
                  F.count_if(truthy(s == "partial")).alias("partial_extractions"),
                  F.count_if(failed).alias("failed_extractions"))


def listwise_correlations(df: DataFrame, anchor: str, others: list[str], min_n: int = 5) -> DataFrame:
    """Pearson r of anchor vs each other column over rows complete in ALL of them; needs n > min_n."""
    cols = [anchor] + list(others)
    clean = df.select([_v(c).alias(c) for c in cols]).na.drop(subset=cols)
    g = clean.agg(F.count(F.lit(1)).alias("n"), *[safe_corr(F.col(q(anchor)), F.col(q(c))).alias(f"r{i}") for i, c in enumerate(others)])
    rows = F.array(*[F.struct(F.lit(anchor).alias("x"), F.lit(c).alias("y"), F.col(f"r{i}").alias("r"))
                     for i, c in enumerate(others)])
    return g.where(F.col("n") > min_n).select("n", F.inline(rows))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise-complete Pearson r, lower triangle incl. diagonal, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[: i + 1]]
    g = df.agg(*[safe_corr(_v(a), _v(b)).alias(f"r{k}") for k, (a, b) in enumerate(pairs)],
               *[F.count(F.when(_v(a).isNotNull() & _v(b).isNotNull(), 1)).alias(f"n{k}")
                 for k, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"n{k}").alias("n"),
                              F.col(f"r{k}").alias("r")) for k, (a, b) in enumerate(pairs)])
    return g.select(F.inline(rows))


def first_per_group(df: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """The value of the earliest row (by ``order``) of every group; no bare ``first``."""
    return df.groupBy(F.col(q(group)).alias(group)).agg(F.min_by(F.col(q(value)), F.col(q(order))).alias(value))


def grouped_mean_ranked(df: DataFrame, group: str, value: str, ascending: bool = True) -> DataFrame:
    """Mean per group, sorted by the mean (ties by group)."""
    g = df.groupBy(F.col(q(group)).alias(group)).agg(F.avg(_v(value)).alias(f"mean_{value}"))
    m = F.col(f"mean_{value}")
    return g.orderBy(m.asc() if ascending else m.desc(), F.col(group))


def group_median(df: DataFrame, group: str, value: str, accuracy: int | None = None) -> DataFrame:
    """Median per group (exact by default, without holding a group in one task)."""
    if accuracy is None:
        g = df.select(F.col(q(group)).alias(group), _v(value).alias("__x"))
        return exact_quantiles(g, "__x", [0.5], [group], names=[f"median_{value}"]).drop("n")
    med = F.percentile_approx(_v(value), 0.5, accuracy).cast("double")
    return df.groupBy(F.col(q(group)).alias(group)).agg(med.alias(f"median_{value}"))


def class_histogram(df: DataFrame, cls: str, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over each class's own [min, max]; the last bin is closed.

    Per-class ranges come from a small per-class aggregate joined back on the
    class key (the planner broadcasts it at run time when it is small).
    """
    v = _v(value)
    base = df.select(F.col(q(cls)).alias("cls"), v.alias("v")).where(F.col("v").isNotNull())
    rng = base.groupBy("cls").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    j = join_small_side(base, rng, ["cls"])
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") > F.col("lo"),
               F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    g = j.groupBy("cls", b.cast("int").alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    return g.select(F.col("cls").alias(cls), "bin",
                    (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("bin_hi"),
                    "count")


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group q1, median, q3, iqr, whiskers (extreme values inside 1.5 IQR fences), outliers."""
    v = _v(value)
    base = df.select(F.col(q(group)).alias("g"), v.alias("v")).where(F.col("v").isNotNull())
    qs = exact_quantiles(base, "v", [0.25, 0.5, 0.75], ["g"], names=["q1", "median", "q3"]).drop("n")
    j = join_small_side(base, qs, ["g"])
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    out = j.groupBy("g", "q1", "median", "q3").agg(
        F.min(F.when(F.col("v") >= lo_f, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(F.col("v") <= hi_f, F.col("v"))).alias("whisker_hi"),
        F.count_if((F.col("v") < lo_f) | (F.col("v") > hi_f)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return out.select(F.col("g").alias(group), "n", "q1", "median", "q3",
                      (F.col("q3") - F.col("q1")).alias("iqr"), "whisker_lo", "whisker_hi", "n_outliers")


MOMENTS = "feature string, n double, mx double, my double, sx double, sy double, sxy double"


def _merged_moments(parts: list[np.ndarray]) -> np.ndarray:
    """Moments (count, means, sums of squares and products around them; 6 x columns) of rows that were summed apart."""
    out = parts[0]
    for p in parts[1:]:
        n = out[0] + p[0]
        share = np.divide(p[0], n, out=np.zeros_like(n), where=n > 0)
        dx, dy, w = p[1] - out[1], p[2] - out[2], out[0] * share
        first = out[0] == 0
        mx, my = out[1] + dx * share, out[2] + dy * share
        merged = np.stack([n, mx, my, out[3] + p[3] + w * dx * dx, out[4] + p[4] + w * dy * dy, out[5] + p[5] + w * dx * dy])
        out = np.where(first, p, np.where(p[0] == 0, out, merged))
    return out


def correlations_with(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(feature, r): pairwise-complete Pearson r of many columns with one, null where a side is constant.

    A task sums the moments of all columns over its Arrow batches, so a cell is never a row of its own; a row a column and
    task is shuffled. Values are taken around a batch's first one, so that constant columns have no variance at all.
    """
    def moments(x, y):
        n = len(x)
        if not n:
            return np.zeros(6)
        u, v = x - x[0], y - y[0]
        mu, mv = u.mean(), v.mean()
        u, v = u - mu, v - mv
        return np.array([n, x[0] + mu, y[0] + mv, u @ u, v @ v, u @ v])

    def rows(m, names):
        return pa.RecordBatch.from_arrays([pa.array(names), *[pa.array(k) for k in m]], names=["feature", "n", "mx", "my", "sx", "sy", "sxy"])

    def of_task(batches):
        out = None
        for b in batches:
            y = b.column(len(columns))
            known, y = y.is_valid().to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False)
            part = []
            for i in range(len(columns)):
                x = b.column(i)
                both = known & x.is_valid().to_numpy(zero_copy_only=False)
                part.append(moments(x.to_numpy(zero_copy_only=False)[both], y[both]))
            part = np.stack(part, axis=1)
            out = part if out is None else _merged_moments([out, part])
        if out is not None:
            yield rows(out, columns)

    def of_column(t):
        m = np.stack([t.column(k).to_numpy() for k in ("n", "mx", "my", "sx", "sy", "sxy")])
        return pa.Table.from_batches([rows(_merged_moments([m[:, i:i + 1] for i in range(m.shape[1])]), t.column("feature").to_pylist()[:1])])

    ship_package(df.sparkSession)
    wide = df.select(*[F.col(q(c)).cast("double").alias(f"x{i}") for i, c in enumerate(columns)], F.col(q(target)).cast("double").alias("y"))
    m = wide.mapInArrow(of_task, MOMENTS).groupBy("feature").applyInArrow(of_column, MOMENTS)
    return m.select("feature", F.when((F.col("sx") > 0) & (F.col("sy") > 0), F.col("sxy") / (F.sqrt("sx") * F.sqrt("sy"))).alias("r"))
