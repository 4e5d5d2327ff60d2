"""End-to-end preparation (M7): impute → filter → encode → target → drop → split → detect → scale.

Medians, modes, binary flags and scaler moments are read once each, as one row, and become literals; the dictionary of the
categories is a stored table that is joined, and the quotas and thresholds of the split are read a class. Medians take the
jobs of ``quantiles``; everything else that is read is one small row or one a class.

``fit_on='all'`` (default, parity with the reference's order) computes imputation statistics and the dictionary over all
rows before the split; ``fit_on='train'`` splits first and fits them on the training rows only, so that nothing of the
test rows leaks: a missing target counts as no rating (P5) instead of the median, and test values that the dictionary
lacks get the code ``UNSEEN``. The scaler is always fitted on the training rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.columns import q
from cohortlab.operators import clean, encode, scale, split
from cohortlab.session import cut_lineage


@dataclass
class Prepared:
    data: DataFrame
    target_source: str
    features: list[str]
    binary: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    dictionary: DataFrame | None = None            # (column, value, code) of the categorical columns
    moments: dict = field(default_factory=dict)    # column → (mean, scale) of the training rows
    fill: dict = field(default_factory=dict)       # column → imputation value

    def params(self, spark):
        """Fitted state as one long parameter table (column, stat, value); codes stay a table."""
        rows = [(c, "fill", None if v is None else str(v)) for c, v in self.fill.items()]
        rows += [(c, s, str(v)) for c, (m, sd) in self.moments.items() for s, v in (("mean", m), ("scale", sd))]
        rows += [(c, "feature_order", str(i)) for i, c in enumerate(self.features)]
        out = spark.createDataFrame(rows, "column string, stat string, value string")
        if self.dictionary is None:
            return out
        return out.unionByName(self.dictionary.select("column", F.concat(F.lit("code_"), "code").alias("stat"), "value"))


UNSEEN = -1


def prepare(df: DataFrame, target: str | None = None, key: str = "ID", subject: str | None = "Subject_ID",
            order: str | None = None, suffix: str | None = "MR2", test_size: float = 0.2, seed: int = 42,
            subject_level: bool = True, strategy: str = "median", exclude=clean.ID_COLUMNS,
            keep: tuple[str, ...] = (), checkpoint: bool = True, fit_on: str = "all") -> Prepared:
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on is 'all' or 'train', not {fit_on!r}")
    target = target or clean.detect_target(df)
    feats = clean.feature_columns(df, target, tuple(exclude) + tuple(keep))
    num, strs = set(clean.numeric_columns(df)), set(clean.string_columns(df))
    cats = [c for c in feats if c in strs]
    if checkpoint:
        # every fit below (imputation, dictionaries, split, scaler) is a small action over this
        # input: write it once to the shared checkpoint folder instead of recomputing its lineage
        df = cut_lineage(df)

    def imputed(rows: DataFrame, fitted: DataFrame, columns: list[str]) -> tuple[DataFrame, dict]:
        values = clean.imputer_values(clean.fit_imputer(fitted, strategy, numeric=[c for c in columns if c in num], categorical=cats))
        return clean.apply_imputer(rows, values), values

    def encoded(rows: DataFrame, fitted: DataFrame, unseen: int | None) -> tuple[DataFrame, DataFrame | None]:
        if not cats:
            return rows, None
        table = encode.fit_label_encoder(fitted, cats)
        return encode.apply_label_encoder(rows, table, cats, unseen), table

    def with_split(rows: DataFrame) -> DataFrame:
        rows = clean.drop_missing_target(clean.binary_target(rows, target))
        if subject_level and subject and subject in rows.columns:
            return split.subject_split(rows, subject, "target", order or key, test_size, seed)
        return split.stratified_holdout(rows, "target", key, test_size, seed)

    train_rows = F.col("split") == "train"
    if fit_on == "all":
        d, fill = imputed(df, df, feats + [target])
        d = clean.drop_suffix(d, key, suffix) if suffix else d
        d, dictionary = encoded(d, d, None)
        d = with_split(d)
    else:
        d = with_split(clean.drop_suffix(df, key, suffix) if suffix else df)
        d = cut_lineage(d) if checkpoint else d
        d, fill = imputed(d, d.where(train_rows), feats)
        d, dictionary = encoded(d, d.where(train_rows), UNSEEN)
    numeric_now = set(clean.numeric_columns(d))
    X = [c for c in feats if c in numeric_now]
    empty = set(clean.all_null_columns(d, X))
    X = [c for c in X if c not in empty]
    binary, moments = scale.fit_columns(d.where(train_rows), X)
    d = scale.apply_scaler(d, moments, list(moments))
    ids = [c for c in dict.fromkeys([key] + ([subject] if subject else []) + list(keep)) if c in d.columns]
    out = d.select(*[F.col(q(c)) for c in ids], "split", "target", *[F.col(q(c)) for c in X])
    return Prepared(out, target, X, binary, cats, dictionary=dictionary, moments=moments, fill=fill)
