"""Spark session and lineage helpers.

Cluster jobs read ``spark.checkpoint.dir`` from the session; only local runs
(tests, bench) fall back to a fresh scratch folder.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cohortlab", driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks (the cluster brings its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Where none is set, a local master gets a scratch folder of its own; any
    other master is an error, as its executors would write to folders that the others cannot read."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder under the master {sc.master}")
        configured = tempfile.mkdtemp(prefix="cohortlab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package (once in each application), wherever they start."""
    sc = spark.sparkContext
    with _SHIPPING:  # fits side by side ship it once
        if sc.applicationId in _SHIPPED:
            return
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="cohortlab-pkg-")
        copy = os.path.join(folder, "src")
        shutil.copytree(os.path.join(root, "cohortlab"), os.path.join(copy, "cohortlab"),
                        ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(os.path.join(folder, "cohortlab"), "zip", copy))
        _SHIPPED.add(sc.applicationId)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, stem: str) -> DataFrame:
    """The frame written as Parquet in the shared folder and read again.

    Lineage ends, and Spark knows the table's size: joins broadcast it where it is below the session's threshold and
    shuffle it (AQE splits skew) where it is not.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{stem}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
