"""Scalar column helpers shared by every operator.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen.  The rules they encode:

* NaN is missing (pandas semantics), so float columns go through
  :func:`nan_to_null` at ingest.
* Guarded divisions give null instead of raising under ANSI mode.
* A null predicate counts as False (``coalesce(pred, False)``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every float/double column, keeping names and order."""
    fl = (T.FloatType, T.DoubleType)
    return df.select([
        nan_to_null(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, fl) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def truthy(pred: Column) -> Column:
    """Null predicate → False."""
    return F.coalesce(pred, F.lit(False))


def ratio_if_positive(num: str | Column, den: str | Column) -> Column:
    """num / den when den > 0, else null (the guard used for fractions and ratios)."""
    num, den = col(num), col(den)
    return F.when(den > 0, num / den)


def bilateral(left: str | Column, right: str | Column) -> Column:
    """left + right, null unless both sides are present."""
    return col(left) + col(right)


def asymmetry_index(left: str | Column, right: str | Column) -> Column:
    """(L - R) / (L + R); 0.0 when the sum is not positive; null if a side is missing."""
    left, right = col(left), col(right)
    s = left + right
    return F.when(s.isNull(), F.lit(None).cast("double")).when(s > 0, (left - right) / s).otherwise(F.lit(0.0))


def laterality_ratio(left: str | Column, right: str | Column) -> Column:
    """L / R; null when R is not positive."""
    left, right = col(left), col(right)
    return F.when(left.isNotNull() & (right > 0), left / right)


def safe_corr(a: str | Column, b: str | Column) -> Column:
    """Pearson r over rows where both are present; null (not an error) when a side is constant.

    Aggregate expression: covar_pop / (stddev_pop * stddev_pop) on the
    pairwise-complete values.
    """
    a, b = col(a), col(b)
    a2, b2 = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    sa, sb = F.stddev_pop(a2), F.stddev_pop(b2)
    return F.when((sa > 0) & (sb > 0), F.covar_pop(a2, b2) / (sa * sb))


def product(arr: str | Column) -> Column:
    """Product of a numeric array (voxel volume from zooms)."""
    return F.aggregate(col(arr), F.lit(1.0), lambda acc, x: acc * x.cast("double"))


def argmax_index(arr: str | Column) -> Column:
    """0-based index of the largest element (first on ties)."""
    arr = col(arr)
    return F.array_position(arr, F.array_max(arr)) - 1


def display_round(c: str | Column, digits: int = 4) -> Column:
    """Half-even rounding of the exact binary value, as Python's ``round`` does for display values.

    ``bround`` would round the shortest decimal string of the double instead (0.02125 → 0.0212, where Python gives
    0.0213), and a scaled product may land on a half that the exact value misses (0.04125 · 10⁴). So the product's
    rounding error is computed without error (the halves of both factors multiply exactly) and decides such ties.
    """
    x, s = col(c).cast("double"), float(10 ** digits)

    def halves(v):
        big = v * 134217729.0  # 2**27 + 1: the high half has 26 bits
        high = big - (big - v)
        return high, v - high

    p = x * F.lit(s)
    (xh, xl), (sh, sl) = halves(x), halves(s)
    err = ((xh * sh - p) + xh * sl + xl * sh) + xl * sl
    low = F.floor(p).cast("double")
    tie = (p - low) == 0.5
    whole = F.when(tie & (err > 0), low + 1).when(tie & (err < 0), low).otherwise(F.rint(p))
    return F.when(F.abs(x) < 2.0 ** 52 / s, whole / F.lit(s)).otherwise(x)


def stable_hash_hex(key: str | Column, seed: int) -> Column:
    """md5(key ':' seed) as 32 lowercase hex digits (same value in DuckDB)."""
    return F.md5(F.concat(col(key).cast("string"), F.lit(f":{seed}")))


def numeric_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def q(name: str) -> str:
    """Backtick-quote a column name (names may hold '/', ' ' or '.')."""
    return "`" + name.replace("`", "``") + "`"


def title_text(c: str | Column) -> Column:
    """a name with underscores as words, each with a capital first letter (``random_forest`` → ``Random Forest``)."""
    return F.initcap(F.translate(col(c), "_", " "))


def fixed_text(c: str | Column, digits: int = 4) -> Column:
    """a number with a fixed number of digits, rounded as Python's format does; null stays null."""
    x = display_round(c, digits)
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f", x))


def percent_text(c: str | Column, digits: int = 1) -> Column:
    """a share as a percentage text (0.0625 → ``6.2%``)."""
    return F.concat(fixed_text(col(c) * 100, digits), F.lit("%"))
