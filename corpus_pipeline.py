"""The corpus pipeline: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotline.llm import decontamination, mixing, near_duplicates, sharding, toxicity
from depotline.session import work_folder

# No SQL can express the classifier of the first stage.
ORACLE_SQL = None


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, with the documents' columns."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_duplicates.deduplicated(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it: not at all, or up to three times."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns with shard and slot; copies of a document are rows of their own."""
    by = [F.col("doc_id"), F.xxhash64("text"), F.xxhash64("source", "lang")]
    return sharding.sharded(docs, by)


STAGES = [("toxicity", toxic), ("near_duplicates", near), ("decontamination", benchmark),
          ("mixing", mix), ("sharding", shards)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the table of documents; each stage's rows are a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
