"""Counts, sums and distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name``, ``row_count``."""
    return union_all(
        [
            frame.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, frame in tables.items()
        ]
    )


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``duplicate_count``."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.where(F.col("duplicate_count") > 1)


def value_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of each column occurs, most frequent first, in one pass."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns
    ]
    listed = rows.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.*")
    counted = listed.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy("column_name", F.desc("n"), "value")


def group_size_stats(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, quartiles and extremes of the group sizes.

    The exact quartiles keep one counter per distinct size. Sizes that differ add
    up to at most the row count, so there are at most sqrt(2 * rows) of them.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    quartiles = F.percentile("size", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    stats = sizes.agg(
        F.count(F.lit(1)).alias("groups"),
        F.avg("size").alias("mean"),
        F.stddev_samp("size").alias("std"),
        F.min("size").alias("min"),
        quartiles.alias("_q"),
        F.max("size").alias("max"),
    )
    return stats.select(
        "groups", "mean", "std", "min",
        F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"),
        "max",
    )


def distinct_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the exact number of distinct values per column."""
    return rows.agg(*[F.count_distinct(F.col(c)).alias(c) for c in columns])


def flagged_per_group(rows: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Number of rows per group that carry the flag."""
    return rows.groupBy(*keys).agg(F.sum(F.col(flag).cast("int")).alias("flagged"))


def extent(rows: DataFrame, first: str, last: str) -> DataFrame:
    """Earliest ``first`` and latest ``last`` of a table."""
    return rows.agg(F.min(first).alias("earliest_record"), F.max(last).alias("latest_update"))


def total_mismatch(parent: DataFrame, key: str, total: str, child: DataFrame, foreign_key: str,
                   amount: str) -> DataFrame:
    """Parents whose stored total differs from the sum of their children.

    Children are summed before the join: it then meets one row per key on either
    side, and the sums already lie where the join needs them.
    """
    sums = child.groupBy(F.col(foreign_key).alias(key)).agg(F.sum(amount).alias("calculated_total"))
    joined = parent.select(key, total).join(sums, key)
    return joined.where(F.col(total) != F.col("calculated_total"))
