"""Take in CSV files that are only ever added to a folder.

A snapshot reads everything again each day. Where the writer only adds files, a
file stream reads each file once: its checkpoint remembers which ones are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotline.functions.times import run_time
from depotline.schemas import TABLES
from depotline.sources import split
from depotline.sources.csv_files import CORRUPT, CORRUPT_FIELD, whole
from depotline.sources.tables import read_or_empty, staged_schema, stamped

BATCH = "_batch"


def _target(root: str, table: str) -> str:
    return f"{root}/arrivals/{table}"


def take_in(spark: SparkSession, folder: str, root: str, table: str,
            files_per_batch: int = 1000) -> None:
    """Load every file that is new since the last call, then stop.

    A batch writes lines that fit and lines that do not in one pass, each kind into a folder of
    the batch's number. A batch that is repeated after a failure replaces both, so each
    file counts once.
    """
    layout = TABLES[table].source
    with_text = T.StructType([*layout.fields, CORRUPT_FIELD])
    lines = (
        spark.readStream.schema(with_text)
        .options(header="true", escape='"', enforceSchema="false")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )

    def load(rows: DataFrame, number: int) -> None:
        split.write(stamped(rows, run_time()), whole(rows), f"{_target(root, table)}/{BATCH}={number}",
                    "overwrite")

    query = (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{root}/state/arrivals/{table}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _read(spark: SparkSession, root: str, table: str, layout: T.StructType, fits: bool) -> DataFrame:
    schema = T.StructType([*staged_schema(layout).fields, T.StructField(BATCH, T.LongType(), True),
                           T.StructField(split.FITS, T.BooleanType(), True)])
    rows = read_or_empty(spark, _target(root, table), schema)
    return rows.where(F.col(split.FITS) == fits).drop(split.FITS)


def read_arrivals(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows taken in, with the number of the batch that brought them."""
    return _read(spark, root, table, TABLES[table].source, True)


def read_rejected_arrivals(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Lines that do not fit, as they stand in their files."""
    return _read(spark, root, table, T.StructType([*TABLES[table].source.fields, CORRUPT_FIELD]), False)
