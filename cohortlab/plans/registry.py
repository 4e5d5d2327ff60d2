"""Query registry: each entry is a Spark callable (spark, sf_dir) -> DataFrame,
optionally paired with the DuckDB SQL that must give the same rows.

Keys are ``<inventory id>_<name>`` in lower case so that coverage against the
SURVEY inventory can be counted by key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r(c: str | Column, digits: int = 6) -> Column:
    """Round a double for value comparison with the oracle (half away from zero on both sides)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


def rounded(df: DataFrame, digits: int = 6, skip=()) -> DataFrame:
    """Round every double column of a result for comparison."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("double", "float") and f.name not in skip:
            c = F.round(c.cast("double"), digits).alias(f.name)
        out.append(c)
    return df.select(out)
