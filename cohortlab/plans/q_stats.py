"""Registered statistics queries over the ``visits`` clinical fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.operators import clean, stats
from cohortlab.plans.registry import register, rounded
from cohortlab.sources import tables as T

V = T.with_ctes(T.VISITS_CTE)
MEASURES = ["price", "qty", "disc"]


def _union(parts):
    return "\nUNION ALL\n".join(parts)


@register("g6_group_stats", V + _union([
    f"""SELECT cdr AS grp, '{m}' AS measure, count({m}) AS n, round(avg({m}), 4) AS mean,
        round(stddev_samp({m}), 4) AS std
        FROM visits WHERE cdr IS NOT NULL GROUP BY cdr HAVING count({m}) > 0""" for m in MEASURES]))
def g6_group_stats(spark, sf):
    """Per rating value: n, mean, sample std of each measure (null ratings skipped)."""
    return rounded(stats.group_stats(T.visits(spark, sf), "cdr", MEASURES), 4)


@register("g7_global_stats", V + _union([
    f"""SELECT '{m}' AS measure, count({m}) AS n, round(avg({m}), 4) AS mean, round(stddev_samp({m}), 4) AS std,
        round(min({m}), 4) AS min, round(max({m}), 4) AS max,
        round(CASE WHEN avg({m}) > 0 THEN stddev_samp({m}) / avg({m}) ELSE 0.0 END, 6) AS cv
        FROM visits""" for m in MEASURES]))
def g7_global_stats(spark, sf):
    out = stats.global_stats(T.visits(spark, sf), MEASURES)
    return out.select("measure", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "max")],
                      F.round("cv", 6).alias("cv"))


CORR_OTHERS = ["price", "qty", "disc", "tax"]


@register("g12_listwise_corr", V + """
, valid AS (SELECT * FROM visits WHERE cdr IS NOT NULL AND price IS NOT NULL AND qty IS NOT NULL
            AND disc IS NOT NULL AND tax IS NOT NULL)
""".replace("\n, valid", ", valid") + _union([
    f"SELECT count(*) AS n, 'cdr' AS x, '{c}' AS y, round(corr(cdr, {c}), 6) AS r FROM valid "
    f"HAVING count(*) > 5" for c in CORR_OTHERS]))
def g12_listwise_corr(spark, sf):
    out = stats.listwise_correlations(T.visits(spark, sf), "cdr", CORR_OTHERS)
    return rounded(out, 6)


CORR_COLS = ["price", "qty", "disc", "tax", "n_items", "cdr"]


def _corr_sql():
    parts = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[: i + 1]:
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
                         f"round(corr({a}, {b}), 6) AS r FROM visits")
    return V + _union(parts)


@register("g13_corr_matrix", _corr_sql())
def g13_corr_matrix(spark, sf):
    return rounded(stats.correlation_matrix(T.visits(spark, sf), CORR_COLS), 6)


@register("g19_first_per_group", V + """
SELECT subject, cdr FROM (
  SELECT subject, cdr, row_number() OVER (PARTITION BY subject ORDER BY session_id) AS rn FROM visits
) WHERE rn = 1""")
def g19_first_per_group(spark, sf):
    return stats.first_per_group(T.visits(spark, sf), "subject", "cdr", "session_id")


@register("g23_class_histogram", V + """
, h AS (SELECT CAST(cdr > 0 AS INTEGER) AS target, price AS v FROM visits WHERE cdr IS NOT NULL),
rg AS (SELECT target, min(v) AS lo, max(v) AS hi FROM h GROUP BY target),
b AS (SELECT h.target, lo, hi, CAST(CASE WHEN hi > lo THEN least(floor((v - lo) / ((hi - lo) / 20)), 19) ELSE 0 END AS INTEGER) AS bin
      FROM h JOIN rg ON h.target = rg.target)
SELECT target, bin, round(lo + bin * (hi - lo) / 20, 4) AS bin_lo, round(lo + (bin + 1) * (hi - lo) / 20, 4) AS bin_hi,
       count(*) AS count
FROM b GROUP BY target, bin, lo, hi""".replace("\n, h AS", ", h AS"))
def g23_class_histogram(spark, sf):
    v = T.visits(spark, sf).where(F.col("cdr").isNotNull())
    v = clean.binary_target(v, "cdr")
    return rounded(stats.class_histogram(v, "target", "price", bins=20), 4)


@register("g24_box_stats", V + """
, qs AS (SELECT priority, quantile_cont(price, [0.25, 0.5, 0.75]) AS q FROM visits GROUP BY priority),
j AS (SELECT v.priority, price, q[1] AS q1, q[2] AS med, q[3] AS q3 FROM visits v JOIN qs ON v.priority = qs.priority)
SELECT priority, count(*) AS n, round(q1, 4) AS q1, round(med, 4) AS median, round(q3, 4) AS q3,
       round(q3 - q1, 4) AS iqr,
       round(min(price) FILTER (WHERE price >= q1 - 1.5 * (q3 - q1)), 4) AS whisker_lo,
       round(max(price) FILTER (WHERE price <= q3 + 1.5 * (q3 - q1)), 4) AS whisker_hi,
       count(*) FILTER (WHERE price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM j GROUP BY priority, q1, med, q3""".replace("\n, qs AS", ", qs AS"))
def g24_box_stats(spark, sf):
    return rounded(stats.box_stats(T.visits(spark, sf), "priority", "price"), 4)


@register("g25_group_median", V + """
SELECT status, round(median(price), 4) AS median_price FROM visits GROUP BY status""")
def g25_group_median(spark, sf):
    return rounded(stats.group_median(T.visits(spark, sf), "status", "price"), 4)
