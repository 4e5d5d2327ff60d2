"""Incremental scoring of arriving sessions with Structured Streaming.

The reference answers one scoring request per session; on Spark the same
maths (X1 align → X2 scale → model) runs as a stateless streaming query:
new session rows arrive as files, are joined with a static table
(stream-static left join), scored with the fitted state as literals and
appended to a Parquet sink. Progress lives in a checkpoint under the
session's shared checkpoint folder, so a restarted or failed job resumes
exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlab.sources import sinks


def read_stream_files(spark: SparkSession, directory: str, schema, glob: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over ``directory`` (optionally only files matching ``glob``)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def run_to_parquet(stream: DataFrame, name: str, output: str | None = None,
                   checkpoint: str | None = None) -> str:
    """Drain everything available (``availableNow``) into a Parquet folder; returns the folder."""
    spark = stream.sparkSession
    output = output or sinks.scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or sinks.scratch_path(spark, f"{name}-ckpt")
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", output).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).queryName(name).start())
    q.awaitTermination()
    return output
