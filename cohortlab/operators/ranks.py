"""Places of rows in an order, without a window over all of them.

A range shuffle sorts the rows; a row's place inside its range comes from the row numbers of its task, and the places that
the ranges before it take come from one count a range and group. No task sees more than a range, and the windows run over
the ranges of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.columns import q
from cohortlab.session import stored


def numbered(df: DataFrame, group: list[str], order: list[str], out: str = "place") -> DataFrame:
    """Add ``out``, the place (from 0) of every row in its group by ``order`` (nulls first). Rows that tie in all of
    ``order`` take their places in any way; the frame is written in the shared folder once, sorted."""
    by = [F.col(q(c)).asc_nulls_first() for c in [*group, *order]] + [F.col("__tie")]
    dealt = (df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
             .drop("__tie").withColumn("__seq", F.monotonically_increasing_id()))
    dealt = stored(dealt, "sorted").withColumn("__range", F.shiftright("__seq", 33))
    names = [f"__g{i}" for i in range(len(group))]
    before = Window.partitionBy(*names).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    runs = (dealt.groupBy(*[F.col(q(c)).alias(n) for c, n in zip(group, names)], F.col("__range").alias("__r"))
            .agg(F.min("__seq").alias("__first"), F.count("*").alias("__n"))
            .withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")))
    runs = stored(runs.drop("__first", "__n"), "ranges")
    same = F.col("__range") == F.col("__r")
    for c, n in zip(group, names):
        same = same & F.col(q(c)).eqNullSafe(F.col(n))
    return dealt.join(runs, same).withColumn(out, F.col("__seq") + F.col("__shift")).drop("__seq", "__range", "__r", "__shift", *names)


def running(df: DataFrame, group: list[str], order: str, weight: str, out: str = "before",
            ranges: int | None = None) -> DataFrame:
    """Add ``out``, the sum of ``weight`` over the rows of the group that come before by ``order``: a scan of two levels.

    Rows should be aggregated to one an ``order`` value. A range sort deals them out and the result is written once;
    the sums over the ranges before (one row a range and group) are joined as a table, those inside a range are a window.
    """
    by = [*group, order]
    dealt = stored(df.repartitionByRange(*([ranges] if ranges else []), *[F.col(q(c)) for c in by]).sortWithinPartitions(*[F.col(q(c)) for c in by])
                   .withColumn("__range", F.spark_partition_id()), "ranges-of-rows")
    names = [f"__g{i}" for i in range(len(group))]

    def earlier(window, total: str) -> Column:
        return F.coalesce(F.sum(total).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    sums = (dealt.groupBy(*[F.col(q(c)).alias(n) for c, n in zip(group, names)], F.col("__range").alias("__r")).agg(F.sum(q(weight)).alias("__t"))
              .withColumn("__below", earlier(Window.partitionBy(*names).orderBy("__r"), "__t")).drop("__t"))
    same = F.col("__range") == F.col("__r")
    for c, n in zip(group, names):
        same = same & F.col(q(c)).eqNullSafe(F.col(n))
    inside = Window.partitionBy(*[F.col(q(c)) for c in group], "__range").orderBy(F.col(q(order)))
    return (dealt.join(sums, same).withColumn(out, F.col("__below") + earlier(inside, q(weight)))
            .drop("__range", "__r", "__below", *names))
