"""Mixing sources to target weights by temperature, with DataFrame and SQL functions only.

Method. Source weights are their token shares raised to an exponent and normalised. The exponent (1: in
proportion, 0: all alike) is bisected: the largest one whose entropy reaches a target, or the smallest one that
keeps the most repeated source within a repetition limit; the limit wins over the entropy. A weight times the token
budget over the source's tokens is its number of epochs. Whole epochs take every document; the last, partial one
takes a prefix of the source's permutation, which orders hash buckets by a hash and documents within a bucket by
another. Prefix sums of the tokens, over the buckets of a source and over the documents of a bucket, tell every copy how
many tokens of its source's run stand before it. That share of the run is its place in the mixture, whose blocks are even
parts of it: every block gets of each source its budgeted tokens, give or take a document, however many blocks there are.
Copies are permuted within a block by a hash.

Sources are never gathered: shares come from one aggregation, every bisection job is one aggregation of the table of
sources, a window sees the buckets of one source (``buckets`` at most) or the counted documents of one bucket. Tokens are
counted once; the texts are shuffled once, to meet their places.

Defined cases: a null source is a source of its own; null text counts as empty; documents without tokens follow
their place in the permutation; a source without tokens has weight 0 and each of its documents once, spread by hash;
equal rows stand at one place and are taken together; an empty table gives an empty result. Extra columns pass through;
those whose names clash with ``mix_epoch``, ``mix_block`` or ``mix_order`` get a trailing ``_in``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import col, cut, keep_clashes, stored, text_of

#: Levels of the bisection in one job, and jobs.
LEVELS, JOBS = 4, 10


def hash60(*parts: Column | str) -> Column:
    """A hash of 60 bits that any SQL engine can compute: the first 15 digits of an md5."""
    joined = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(F.encode(joined, "utf-8")), 1, 15), 16, 10).cast("long")


def word_tokens(text: str = "text") -> Column:
    """Words between white space: the default measure of a document."""
    t = F.trim(F.regexp_replace(text_of(text), r"\s+", " "))
    return F.when(t == "", F.lit(0)).otherwise(F.length(t) - F.length(F.translate(t, " ", "")) + 1).cast("long")


def bisect_exponent(shares: DataFrame, total: int, budget: float, target_entropy: float | None,
                    max_repeat: float | None) -> float:
    """Exponent for the shares ``p`` (one row a source): see the module's method."""
    def search(good) -> float:
        """Largest exponent with good(aggregates) if 0 is good; the exponent is halved ``LEVELS * JOBS`` times."""
        low, high = 0.0, 1.0
        ends = aggregates([0.0, 1.0])
        if good(1.0, ends[1.0]) or not good(0.0, ends[0.0]):
            return 1.0 if good(1.0, ends[1.0]) else 0.0
        for _ in range(JOBS):
            mids, spans = {}, [(low, high)]
            for _ in range(LEVELS):
                nxt = []
                for a, b in spans:
                    m = (a + b) / 2
                    mids[m] = None
                    nxt += [(a, m), (m, b)]
                spans = nxt
            found = aggregates(list(mids))
            for _ in range(LEVELS):
                m = (low + high) / 2
                low, high = (m, high) if good(m, found[m]) else (low, m)
        return low

    def aggregates(alphas: list[float]) -> dict[float, tuple[float, float, float]]:
        logs = F.log("p")
        row = shares.where("p > 0").agg(*[x for k, a in enumerate(alphas) for x in (
            F.sum(F.exp(F.lit(a) * logs)).alias(f"s{k}"), F.sum(F.exp(F.lit(a) * logs) * logs).alias(f"l{k}"),
            F.max(F.exp(F.lit(a - 1) * logs)).alias(f"m{k}"))]).first()
        return {a: (row[f"s{k}"], row[f"l{k}"], row[f"m{k}"]) for k, a in enumerate(alphas)}

    alpha = 1.0
    if target_entropy is not None:
        alpha = search(lambda a, x: math.log(x[0]) - a * x[1] / x[0] >= target_entropy)
    if max_repeat is not None:
        fits = lambda a, x: budget / total * x[2] / x[0] <= max_repeat + 1e-12
        if not fits(alpha, aggregates([alpha])[alpha]):
            # too flat: 1 - exponent is the largest flattening that fits (none fits if even 1 does not)
            low, high = alpha, 1.0
            for _ in range(LEVELS * JOBS):
                m = (low + high) / 2
                low, high = (low, m) if fits(m, aggregates([m])[m]) else (m, high)
            alpha = high
    return alpha


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        target_entropy: float | None = 0.95, max_repeat: float | None = 4.0, budget: float | None = None,
        buckets: int = 1024, block_tokens: int = 1_000_000, seed: str = "mix") -> DataFrame:
    """The mixture: a row for every copy, with ``mix_epoch`` (from 0), ``mix_block`` and ``mix_order`` in it.

    ``target_entropy``: share of the largest possible entropy, 0 to 1. ``max_repeat``: epochs of a source at most.
    ``budget``: tokens of the mixture (null: as many as there are).
    """
    df, taken = keep_clashes(df, "mix_epoch", "mix_block", "mix_order")
    key, source, text = (taken.get(c, c) for c in (key, source, text))
    src = F.coalesce(F.concat(F.lit("="), col(source).cast("string")), F.lit("~"))  # null apart from any text
    bucket = F.pmod(hash60(f"{seed}b", col(key)), F.lit(buckets))
    place = hash60(f"{seed}d", col(key), src)
    work = df.select(F.struct(*[col(c) for c in df.columns]).alias("row"), src.alias("src"), place.alias("place"))
    in_bucket = Window.partitionBy("src", "bucket").orderBy("place")
    places = (df.select(src.alias("src"), bucket.alias("bucket"), place.alias("place"), word_tokens(text).alias("tokens"))
              .repartition("src", "bucket").groupBy("src", "bucket", "place").agg(F.sum("tokens").alias("tokens"))
              .withColumn("inside", F.sum("tokens").over(in_bucket) - F.col("tokens")))
    places = stored(places, "mix-places")
    held = cut(places.groupBy("src", "bucket").agg(F.sum("tokens").alias("tokens")))
    sources = held.groupBy("src").agg(F.sum("tokens").alias("tokens"))
    total, k = sources.agg(F.sum("tokens"), F.count(F.when(F.col("tokens") > 0, 1))).first()
    total, k = int(total or 0), int(k or 0)
    budget = float(total if budget is None else budget)
    shares = cut(sources.withColumn("p", F.col("tokens") / F.lit(max(total, 1)).cast("double")))
    alpha = bisect_exponent(shares, total, budget, target_entropy * math.log(k) if target_entropy is not None else None,
                            max_repeat) if k > 1 else 1.0
    norm = shares.where("p > 0").agg(F.sum(F.pow("p", F.lit(alpha)))).first()[0] or 1.0
    repeat = F.when(F.col("p") > 0, F.lit(budget) * F.pow("p", F.lit(alpha)) / F.lit(norm) / F.col("tokens")).otherwise(1.0)
    weighed = (shares.withColumn("repeat", F.round(repeat, 9))  # what arithmetic leaves over 1 is no epoch
               .withColumn("whole", F.floor("repeat").cast("long"))
               .withColumn("rest", (F.col("repeat") - F.col("whole")) * F.col("tokens")))
    # tokens before each copy in its source's run: the buckets before its own, then the documents before it
    by_bucket = Window.partitionBy("src").orderBy("turn", "bucket")
    starts = (held.withColumn("turn", hash60(f"{seed}t", F.col("src"), F.col("bucket")))
              .withColumn("start", F.sum("tokens").over(by_bucket) - F.col("tokens")).select("src", "bucket", "start"))
    plan = stored(weighed.select("src", "repeat", "whole", "rest", F.col("tokens").alias("all")), "mix-plan")
    before = F.col("start") + F.col("inside")
    spots = (places.select("src", "bucket", "place", "inside").join(stored(starts, "mix-starts"), ["src", "bucket"]).join(plan, "src")
             .withColumn("before", before).withColumn("copies", F.col("whole") + F.when(F.col("before") < F.col("rest"), 1).otherwise(0))
             .where("copies > 0").select("src", "place", "before", "copies", "repeat", "all"))
    blocks = max(1, math.ceil(budget / block_tokens))
    run = F.col("repeat") * F.col("all")
    part = F.when(run > 0, (F.col("mix_epoch") * F.col("all") + F.col("before")) / run).otherwise(F.col("place") / F.lit(float(2**60)))
    return (work.join(spots.hint("shuffle_hash"), ["src", "place"])
            .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .withColumn("mix_block", F.floor(F.least(part, F.lit(1 - 1e-9)) * F.lit(blocks)).cast("long"))
            .withColumn("mix_order", hash60(f"{seed}o", F.col("mix_epoch"), F.col("place")))
            .select("row.*", "mix_epoch", "mix_block", "mix_order"))
