"""Exact linear-interpolated quantiles without holding a group in one task.

``percentile`` keeps every distinct value of a group in one final task; for a
hot group that is unbounded. Here equal values are counted before anything
else, so ties never meet as rows, and per group and probability p:

1. a bracket [lo, hi] from the quantile sketch at p ∓ 3/accuracy. The
   sketch's rank error is at most n/accuracy, so the order statistics at
   floor/ceil((n-1)p) lie inside it or are its neighbours;
2. the counted values fall into three classes: below the bracket (one row,
   with the largest value), inside (a row per distinct value) and above (one
   row, with the smallest). This is an aggregation with map-side combine;
3. while a bracket may hold more than ``LIMIT`` distinct values, they are cut
   into ``CUTS`` parts of about as many values (a sketch of the values
   inside), the parts are counted, and only those in which the wanted ranks
   lie stay inside: every pass leaves about a sixtieth, whatever the
   distribution;
4. running counts over the classes and values give ranks: a sorted window of
   ``LIMIT`` + 2 rows at most, however many rows the group has;
5. the values at ranks floor((n-1)p) and ceil((n-1)p) are interpolated:
   v_lo + (v_hi - v_lo)·frac (the formula of the SQL ``quantile_cont``).

Nothing is collected into arrays, and no step is exact for some sizes only. The
per-group brackets are a stored table that Spark broadcasts or shuffles by its
size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.columns import nan_to_null, q
from cohortlab.session import stored

ACCURACY = 10_000   # bracket ±3/10000: ranks about 0.06% of a group; exactness does not depend on it
LIMIT, CUTS = 10_000, 64
_BELOW, _INSIDE, _ABOVE = 0, 1, 2


def _position(probs: list[float]) -> Column:
    """Rank that is wanted, as a fraction between two rows."""
    return F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("__i") + 1) * (F.col("__n") - 1)


def narrowed(classes: DataFrame, g: list[str], probs: list[float], limit: int, largest: int, accuracy: int) -> DataFrame:
    """The classes with at most ``limit`` distinct values inside any bracket (see the module's step 3).

    ``largest``: rows of the largest group. A bracket spans 6/accuracy of the ranks and the sketch errs by 1/accuracy at
    either end, so that bounds the values inside before any is counted.
    """
    limit, inside = max(limit, 16), 8 * largest // accuracy + 2
    run = Window.partitionBy(*g, "__i").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    while inside > limit:
        classes = stored(classes, "quantile-classes")
        inner = F.col("__k") == _INSIDE
        cuts = (classes.where(inner).groupBy(*g, "__i")
                .agg(F.percentile_approx("__in", [i / CUTS for i in range(1, CUTS)], 16 * CUTS).alias("__cuts")))
        part = (F.when(F.col("__k") == _BELOW, -1).when(F.col("__k") == _ABOVE, CUTS)
                .otherwise(F.size(F.filter(F.coalesce("__cuts", F.array().cast("array<double>")), lambda x: x < F.col("__in")))))
        parted = classes.join(stored(cuts, "quantile-cuts"), [*g, "__i"], "left").withColumn("__part", part).drop("__cuts")
        counts = (parted.groupBy(*g, "__i", "__n", "__part").agg(F.sum("__c").alias("__c"))
                  .withColumn("__start", F.coalesce(F.sum("__c").over(run), F.lit(0))).withColumn("__pos", _position(probs)))
        holds = (F.col("__start") <= F.ceil("__pos")) & (F.floor("__pos") < F.col("__start") + F.col("__c"))
        spans = counts.where(holds).groupBy(*g, "__i").agg(F.min("__part").alias("__from"), F.max("__part").alias("__to"))
        kind = F.when(F.col("__part") < F.col("__from"), _BELOW).when(F.col("__part") > F.col("__to"), _ABOVE).otherwise(F.col("__k"))
        classes = stored(parted.join(stored(spans, "quantile-spans"), [*g, "__i"]).withColumn("__k", kind)
                         .groupBy(*g, "__i", "__n", "__k", F.when(F.col("__k") == _INSIDE, F.col("__in")).alias("__in"))
                         .agg(F.sum("__c").alias("__c"), F.max("__max").alias("__max"), F.min("__min").alias("__min")), "quantile-classes")
        inside = classes.where(inner).groupBy(*g, "__i").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    return classes


def exact_quantiles(df: DataFrame, value: str | Column, probs: list[float], group: list[str] | None = None,
                    accuracy: int = ACCURACY, names: list[str] | None = None,
                    small_groups: bool = False, limit: int = LIMIT) -> DataFrame:
    """(group..., n, <names>) — exact interpolated quantiles of the non-null, non-NaN values.

    ``small_groups=True`` declares a structural bound on the groups (e.g. one
    per column name): their brackets are then kept as a local relation.
    """
    user_group = list(group or [])
    local = small_groups or not user_group
    g = user_group or ["__g"]
    names = names or [f"q{i}" for i in range(len(probs))]
    m = len(probs)
    val = F.col(q(value)) if isinstance(value, str) else value
    keys = [F.col(q(c)).alias(c) for c in user_group] or [F.lit(0).alias("__g")]
    base = df.select(*keys, nan_to_null(val.cast("double")).alias("__v")).where(F.col("__v").isNotNull())

    # one sketch per group answers both bracket ends
    d = 3.0 / accuracy
    ends = [max(p - d, 0.0) for p in probs] + [min(p + d, 1.0) for p in probs]
    brackets = (base.groupBy(*g).agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx("__v", ends, accuracy).alias("__e"))
                .select(*g, "__n", F.posexplode(F.arrays_zip(F.slice("__e", 1, m).alias("lo"), F.slice("__e", m + 1, m).alias("hi")))
                        .alias("__i", "__b"))
                .select(*g, "__n", "__i", F.col("__b.lo").alias("__lo"), F.col("__b.hi").alias("__hi")))
    brackets = (df.sparkSession.createDataFrame(brackets.collect(), brackets.schema) if local else stored(brackets, "quantile-brackets"))

    v = F.col("__v")
    counted = base.groupBy(*g, "__v").agg(F.count(F.lit(1)).alias("__c"))
    kind = F.when(v < F.col("__lo"), _BELOW).when(v > F.col("__hi"), _ABOVE).otherwise(_INSIDE)
    classes = (counted.join(brackets, g).withColumn("__k", kind)
               .groupBy(*g, "__i", "__n", "__k", F.when(F.col("__k") == _INSIDE, v).alias("__in"))
               .agg(F.sum("__c").alias("__c"), F.max(v).alias("__max"), F.min(v).alias("__min")))
    classes = narrowed(classes, g, probs, limit, brackets.agg(F.max("__n")).first()[0] or 0, accuracy)
    running = Window.partitionBy(*g, "__i").orderBy("__k", "__in")
    ranked = (classes.withColumn("__end", F.sum("__c").over(running)).withColumn("__start", F.col("__end") - F.col("__c"))
              .withColumn("__pos", _position(probs)))

    def at_rank(k: Column) -> Column:
        """The value of rank k, from the row that covers it: below, only the last rank is known, above, only the first."""
        here = (F.col("__start") <= k) & (k < F.col("__end"))
        known = F.when(F.col("__k") == _BELOW, F.when(k == F.col("__end") - 1, F.col("__max"))).when(
            F.col("__k") == _ABOVE, F.when(k == F.col("__start"), F.col("__min"))).otherwise(F.col("__in"))
        return F.max(F.when(here, known))

    frac = F.col("__pos") - F.floor("__pos")
    found = (ranked.groupBy(*g, "__i", "__n", "__pos")
             .agg(at_rank(F.floor("__pos")).alias("__lo"), at_rank(F.ceil("__pos")).alias("__hi"))
             .withColumn("__q", F.when(frac == 0, F.col("__lo")).otherwise(
                 F.col("__lo") + (F.col("__hi") - F.col("__lo")) * frac)))
    return found.groupBy(*g).agg(F.max("__n").alias("n"), *[
        F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(name) for i, name in enumerate(names)]).select(*user_group, "n", *names)
