"""CSV snapshots and CSV sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotline.sources.tables import empty, read_or_empty

CORRUPT = "_corrupt_record"
CORRUPT_FIELD = T.StructField(CORRUPT, T.StringType(), True)

# Quotes inside a quoted field are doubled; column names in the header must agree
# with the layout.
_OPTIONS = {"header": "true", "escape": '"', "enforceSchema": "false"}


class EmptySourceError(ValueError):
    """Raised before a target is touched when its source holds no rows."""


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             multi_line: bool = False) -> DataFrame:
    """Read CSV files with a fixed layout.

    A line that does not fit keeps its text in ``_corrupt_record``. Line breaks
    inside fields need ``multi_line``, which makes a file one task.
    """
    with_text = T.StructType([*schema.fields, CORRUPT_FIELD])
    return (
        spark.read.schema(with_text).options(**_OPTIONS)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", str(multi_line).lower())
        .csv(path)
    )


def require_rows(rows: DataFrame, name: str) -> DataFrame:
    """Raise if there are no rows; at most one row is fetched to find out."""
    if rows.isEmpty():
        raise EmptySourceError(f"{name} is empty")
    return rows


def _whole(rows: DataFrame) -> Column:
    """Always true, and needs every column: a line is judged whole, whatever is selected later."""
    return F.xxhash64(*[c for c in rows.columns if c != CORRUPT]) >= F.lit(-2**63)


def whole(rows: DataFrame) -> Column:
    """Does a line fit in all its columns?"""
    return F.col(CORRUPT).isNull() & _whole(rows)


def good_lines(rows: DataFrame) -> DataFrame:
    return rows.where(whole(rows)).drop(CORRUPT)


def bad_lines(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(CORRUPT).isNotNull() & _whole(rows))


def write_csv(rows: DataFrame, path: str, append: bool = False) -> None:
    """Write a folder of CSV files, each with its header.

    Appending adds files, so it never rewrites or interrupts what is there.
    """
    mode = "append" if append else "overwrite"
    rows.write.mode(mode).options(
        header="true", escape='"', timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


RUN = "_run"
_PUBLISHED = T.StructType([T.StructField(RUN, T.StringType(), True)])


def append_csv(rows: DataFrame, path: str, run: str) -> None:
    """Append a folder of CSV files that may be repeated under the same run.

    The files of a run stand in a folder of its own, which a repetition replaces. Readers see
    them once the run is published, by one marker behind the write; a run that dies before
    that leaves nothing to be read.
    """
    write_csv(rows, f"{path}/{RUN}={run}")
    marker = rows.sparkSession.range(0, 1, 1, 1).select(F.lit(run).alias(RUN))
    marker.write.mode("append").parquet(f"{path}/_published")


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All published runs, with the text of lines that do not fit and the run of each line.

    Folders of runs that are not published are not opened: the runs are a partition filter.
    """
    published = read_or_empty(spark, f"{path}/_published", _PUBLISHED).distinct()
    # One name per append.
    runs = [r[0] for r in published.collect()]
    if not runs:
        return empty(spark, T.StructType([*schema.fields, CORRUPT_FIELD, *_PUBLISHED.fields]))
    base = T.StructType([*schema.fields, *_PUBLISHED.fields])
    return read_csv(spark, path, base).where(F.col(RUN).isin(runs))
