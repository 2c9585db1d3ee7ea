"""Shape, types and missing values of a table, in one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(rows: DataFrame, table_name: str) -> DataFrame:
    """One row per column: position, type, rows, non-null and missing values."""
    kinds = rows.dtypes
    present = [F.count(F.col(c)).alias(f"_n{i}") for i, (c, _) in enumerate(kinds)]
    counted = rows.agg(F.count(F.lit(1)).alias("row_count"), *present)
    listed = [
        part
        for i, (c, kind) in enumerate(kinds)
        for part in (F.lit(i + 1), F.lit(c), F.lit(kind), F.col(f"_n{i}"))
    ]
    return counted.select(
        F.lit(table_name).alias("table_name"), "row_count",
        F.stack(F.lit(len(kinds)), *listed).alias(
            "position", "column_name", "data_type", "non_null"),
    ).select(
        "table_name", "position", "column_name", "data_type", "row_count", "non_null",
        (F.col("row_count") - F.col("non_null")).alias("missing"),
    )


def shape(rows: DataFrame, table_name: str) -> DataFrame:
    """Number of rows and columns."""
    return rows.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table_name).alias("table_name"), "row_count",
        F.lit(len(rows.columns)).alias("column_count"))
