"""Truncate-and-reload as a version switch.

A reload writes a new version folder. Only when that is complete a row in the
versions table names it as the current one, so a reader sees the old rows or the
new rows, and a failed reload leaves the old ones.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotline.schemas import VERSIONS
from depotline.sources.tables import empty, literal_rows, read_or_empty


def _log(root: str) -> str:
    return f"{root}/state/versions"


def current_version(spark: SparkSession, root: str, table: str) -> str | None:
    """Name of the newest complete version, None before the first."""
    log = read_or_empty(spark, _log(root), VERSIONS).where(F.col("table_name") == table)
    return log.agg(F.max_by("version", F.struct("recorded_at", "version"))).first()[0]


def current_versions(spark: SparkSession, root: str) -> dict[str, str]:
    """The newest complete version of every table; one row per table reaches the driver."""
    log = read_or_empty(spark, _log(root), VERSIONS)
    newest = log.groupBy("table_name").agg(
        F.max_by("version", F.struct("recorded_at", "version")).alias("version"))
    return {r.table_name: r.version for r in newest.collect()}


def switch_all(spark: SparkSession, root: str, counts: Mapping[str, int], version: str,
               recorded_at: datetime) -> None:
    """Make a version the current one of several tables at once: one file, so all or none."""
    rows = [(table, version, recorded_at, n) for table, n in counts.items()]
    literal_rows(spark, rows, VERSIONS).write.mode("append").parquet(_log(root))


def switch_to(spark: SparkSession, root: str, table: str, version: str, recorded_at: datetime,
              row_count: int) -> None:
    row = literal_rows(spark, [(table, version, recorded_at, row_count)], VERSIONS)
    row.write.mode("append").parquet(_log(root))


def version_path(root: str, table: str, version: str) -> str:
    return f"{root}/versions/{table}/v={version}"


def write_version(rows: DataFrame, root: str, table: str, version: str) -> None:
    """Write the rows of a version; a repeated attempt replaces its own files only."""
    rows.write.mode("overwrite").parquet(version_path(root, table, version))


def read_current(spark: SparkSession, root: str, table: str,
                 schema: T.StructType | None = None) -> DataFrame:
    """The current rows. Before the first load there are none, or an error without a layout."""
    version = current_version(spark, root, table)
    if version is None and schema is None:
        raise LookupError(f"{table} has not been loaded")
    if version is None:
        return empty(spark, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(version_path(root, table, version))


def reload(rows: DataFrame, root: str, table: str, version: str,
           recorded_at: datetime) -> DataFrame:
    """Replace a table by the rows and return it as stored."""
    spark = rows.sparkSession
    seen = Observation()
    write_version(rows.observe(seen, F.count(F.lit(1)).alias("n")), root, table, version)
    switch_to(spark, root, table, version, recorded_at, seen.get["n"])
    return spark.read.schema(rows.schema).parquet(version_path(root, table, version))
