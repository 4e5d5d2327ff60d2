"""A corpus pipeline: quality, near duplicates, personal data, source mixture, tokens.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept and returns a DataFrame; all but
the last return the columns of ``documents``. ``run`` writes each stage's result as Parquet in the shared folder and
reads it again for the next, so a lost executor repeats one stage at most.

Rows with null text go through as empty texts (the classifier decides on them); an empty table stays empty; columns
beyond those of ``documents`` pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm import mixing, pii, quality, text_dedup
from cohortlab.llm.common import col, crc_mod, ready, shared_folder, table, text_of, tidy_name, tokenizer
from cohortlab.llm.sentencepiece_codec import encode_decode


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of good quality is 0.7 or more; trained on all of them but the held-out quarter."""
    ready(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    mark = tidy_name(docs, "quality")
    return quality.score(docs, model, out=mark).where(col(mark) >= 0.7).drop(mark)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id."""
    ready(spark)
    return text_dedup.keep_one(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, and n_chars counted anew."""
    ready(spark)
    mark = tidy_name(docs, "spans")
    clean = pii.redact(pii.find_personal(docs, out=mark), mark).drop(mark)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources with as many tokens as there are: documents repeat or rest by their source's weight,
    and stand in the mixture's order, so that a stretch of rows holds the sources in proportion."""
    ready(spark)
    names = [tidy_name(docs, f"mix{i}") for i in range(len(docs.columns))]  # the mixture's own names are free then
    mixed = mixing.mix(docs.toDF(*names), *(names[docs.columns.index(c)] for c in ("doc_id", "source", "text")))
    place = ("mix_block", "mix_order")
    dealt = mixed.repartitionByRange(*place).sortWithinPartitions(*place)
    return dealt.drop("mix_epoch", *place).toDF(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of the text decoded from them."""
    ready(spark)
    src = docs.select("doc_id", "source", text_of("text").alias("text"))
    return (encode_decode(src, tokenizer("piece_bpe_32k.model"))
            .select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                    F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256")))


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("personal_data", hide_personal_data),
          ("mixing", mix_sources), ("sentencepiece", encode_tokens)]

#: The classifier cannot be said in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
