"""Sinks and persisted state.

Everything is written with the DataFrame writer into a folder the caller
names; scratch output goes under the session's shared checkpoint folder
(never a machine-local temporary folder).
"""

from __future__ import annotations

import json
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.functions.columns import q
from cohortlab.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohortlab-io/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """Features, splits, comparisons, manifests as Parquet (or CSV with a header)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(path)
    return path


def json_ready(df: DataFrame) -> DataFrame:
    """JSON-safe columns: map keys as strings, binary as base64, everything else as is."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.MapType) and not isinstance(f.dataType.keyType, T.StringType):
            c = F.map_from_arrays(F.transform(F.map_keys(c), lambda k: k.cast("string")), F.map_values(c))
        elif isinstance(f.dataType, T.BinaryType):
            c = F.base64(c)
        out.append(c.alias(f.name))
    return df.select(out)


def write_json(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """One JSON object per row (partitioned, e.g. one folder per model)."""
    return write_table(json_ready(df), path, "json", partition_by)


def to_json_column(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as a JSON string."""
    return json_ready(df).select(F.to_json(F.struct("*")).alias(name))


def save_params(params: DataFrame, path: str) -> str:
    """Fitted state (column, stat, value) as Parquet."""
    return write_table(params, path)


def load_params(spark: SparkSession, path: str) -> dict:
    """Back to {'fill': {...}, 'dictionary': (column, value, code), 'moments': {...}, 'features': [...]}; all but the
    dictionary, which stays a table, are a few values a column."""
    table = spark.read.parquet(path)
    code = F.col("stat").startswith("code_")
    out = {"fill": {}, "moments": {}, "features": [],
           "dictionary": table.where(code).select("column", "value", F.substring_index("stat", "_", -1).cast("int").alias("code"))}
    order = {}
    for r in table.where(~code).collect():
        if r.stat == "fill":
            out["fill"][r.column] = None if r.value is None else float(r.value) if _is_num(r.value) else r.value
        elif r.stat in ("mean", "scale"):
            m = out["moments"].setdefault(r.column, [None, None])
            m[0 if r.stat == "mean" else 1] = float(r.value)
        elif r.stat == "feature_order":
            order[int(r.value)] = r.column
    out["moments"] = {c: tuple(v) for c, v in out["moments"].items()}
    out["features"] = [order[i] for i in sorted(order)]
    return out


def _is_num(s: str) -> bool:
    try:
        float(s)
        return True
    except ValueError:
        return False


MODEL_SCHEMA = "model_type string, features array<string>, importances string, coefficients string, params string"


def save_model(fitted, path: str, spark: SparkSession) -> str:
    """Any of the eight models as a folder: ``about`` (type, features, parameters), and where the model has one its
    Spark ML model, its parameter table or its training rows."""
    extra = dict(fitted.extra)
    if "params" in extra:
        spark.createDataFrame(extra.pop("params")).write.mode("overwrite").parquet(f"{path}/params")
    if "train" in extra:
        keep = [*fitted.features, extra["label"], extra["train_key"]]
        extra.pop("train").select(*[F.col(q(c)) for c in dict.fromkeys(keep)]).write.mode("overwrite").parquet(f"{path}/train")
    if fitted.spark_model is not None:
        fitted.spark_model.write().overwrite().save(f"{path}/model")
    row = (fitted.model_type, list(fitted.features), json.dumps(fitted.importances), json.dumps(fitted.coefficients), json.dumps(extra))
    spark.createDataFrame([row], MODEL_SCHEMA).write.mode("overwrite").parquet(f"{path}/about")
    return path


def load_model(spark: SparkSession, path: str):
    """A saved model of any type, ready to score."""
    from pyspark.ml import classification as ml

    from cohortlab.models import classifiers as C
    from cohortlab.models.knn import fit_knn

    row = spark.read.parquet(f"{path}/about").first()
    kind, features, extra = row["model_type"], list(row["features"]), json.loads(row["params"])
    if kind == "naive_bayes":
        return load_naive_bayes(spark, path, features)
    if kind == "knn":
        return fit_knn(spark.read.parquet(f"{path}/train"), features, extra["label"], extra["train_key"], extra["k"], extra["block_rows"])
    if kind == "adaboost":
        return C.adaboost_fitted(features, extra["stumps"], extra["alphas"])
    if kind == "svm":
        return C.svm_fitted(features, ml.LinearSVCModel.load(f"{path}/model"), np.array(extra["w"]), np.array(extra["b"]),
                            extra["a"], extra["c0"], extra["gamma"])
    model = {"random_forest": ml.RandomForestClassificationModel, "logistic_regression": ml.LogisticRegressionModel}.get(kind, ml.GBTClassificationModel)
    return C.spark_ml_fitted(kind, model.load(f"{path}/model"), features)


def load_naive_bayes(spark: SparkSession, path: str, features: list[str]):
    """A saved naive Bayes parameter table back to a fitted model."""
    from cohortlab.models.classifiers import Fitted, naive_bayes_scores
    rows = spark.read.parquet(f"{path}/params").collect()
    return Fitted("naive_bayes", features, lambda df: naive_bayes_scores(df, rows, features), extra={"params": rows})


def run_metadata(prepared: DataFrame, features: list[str], dataset: str, target: str) -> DataFrame:
    """One row: dataset, target, features, split sizes and class counts per split."""
    g = prepared.agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"),
        F.count_if((F.col("split") == "train") & (F.col("target") == 1)).alias("train_pos"),
        F.count_if((F.col("split") == "train") & (F.col("target") == 0)).alias("train_neg"),
        F.count_if((F.col("split") == "test") & (F.col("target") == 1)).alias("test_pos"),
        F.count_if((F.col("split") == "test") & (F.col("target") == 0)).alias("test_neg"))
    return g.select(F.lit(dataset).alias("dataset"), F.lit(target).alias("target"),
                    F.array(*[F.lit(c) for c in features]).alias("features"),
                    F.lit(len(features)).alias("n_features"), "*")
