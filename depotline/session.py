"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are designed for. They are runtime settings, so `tune` can
# apply them to a session somebody else made.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Row-level joins on a hot key are split by the size of the shuffled blocks,
    # also where the split costs one more shuffle above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Shuffled bytes of one task. Sorted keys are packed to a few bytes a row, so Spark's default of
# 64 MB unfolds to gigabytes in the sorts and hash tables of a task. A session's own value stays.
PART, PART_BYTES, DEFAULT_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m", ("64MB", "67108864b")


def tune(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME_CONF to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if spark.conf.get(PART) in DEFAULT_BYTES:
        spark.conf.set(PART, PART_BYTES)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may leave the setting out; it gets a new temporary
    folder, which is then also set as the session's checkpoint folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="depotline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(rows: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder, for what is costly and read many times.

    It is compressed as the session says, unless a codec is named.
    """
    spark = rows.sparkSession
    path = work_folder(spark, purpose)
    rows.write.parquet(path, compression=codec)
    return spark.read.schema(rows.schema).parquet(path)
