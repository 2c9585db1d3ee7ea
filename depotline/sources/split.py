"""One write for the rows that fit and those that do not.

The flag is the first folder level, so both kinds leave in the same pass over the source and are
read apart; a reader of one kind opens no file of the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotline.sources.tables import read_or_empty

FITS = "_fits"


def write(rows: DataFrame, fits: Column, path: str, mode: str, by: Sequence[str] = ()) -> None:
    """Write all rows; those that fit below ``_fits=true``, the others below ``_fits=false``."""
    flagged = rows.withColumn(FITS, F.coalesce(fits, F.lit(False)))
    flagged.write.mode(mode).partitionBy(FITS, *by).parquet(path)


def side(path: str, fits: bool = True) -> str:
    return f"{path}/{FITS}={str(fits).lower()}"


def read(spark: SparkSession, path: str, schema: T.StructType, fits: bool = True) -> DataFrame:
    """The rows of one kind; none if there are none."""
    return read_or_empty(spark, side(path, fits), schema)
