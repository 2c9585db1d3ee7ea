"""Global row numbers that depend on the rows' content only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotline.llm.common import BUCKETS, bucket_of, fresh
from depotline.session import written


def numbered(rows: DataFrame, by: list[Column], name: str) -> tuple[DataFrame, int]:
    """The rows with gapless numbers from 0 in column `name`, and how many rows there are.

    The order is by hash bucket of `by`, then by `by` itself, so it is the same on any
    cluster and in any repeated task; rows equal in `by` take their numbers in any order.
    At most BUCKETS counts are summed in one place. The rows are read twice.
    """
    bucket, first = fresh(rows.withColumn(name, F.lit(0)), "_bucket", "_first")
    keyed = rows.withColumn(bucket, bucket_of(*by))
    counts = keyed.groupBy(bucket).agg(F.count("*").alias("_n"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(bucket), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(first))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    within = Window.partitionBy(bucket).orderBy(*by)
    placed = keyed.withColumn(name, F.row_number().over(within).cast("long") - 1)
    # The right side has one short row per bucket.
    joined = placed.join(F.broadcast(starts), bucket)
    return joined.withColumn(name, F.col(name) + F.col(first)).drop(bucket, first), total


def in_order(rows: DataFrame, by: list[str], purpose: str) -> DataFrame:
    """Rows (tree, *by, n copies) with `first`, the place of the first copy in the tree, and `size`.

    Rows are cut into ranges of (tree, *by), whichever tree owns them, and each range counts its
    own: a tree with a third of all rows spans many ranges. Places add up over the ranges' counts.
    """
    ranged = rows.repartitionByRange("tree", *by).withColumn("part", F.spark_partition_id())
    # A written table, so that a repeated task finds the same ranges.
    ranged = written(ranged, purpose)
    counts = ranged.groupBy("tree", "part").agg(F.sum("n").alias("_n"))
    over = Window.partitionBy("tree")
    before = over.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("tree", "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                           F.sum("_n").over(over).alias("size"))
    inside = (Window.partitionBy("tree", "part").orderBy(*by)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (ranged.join(starts, ["tree", "part"])
            .withColumn("first", F.col("_start") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .drop("part", "_start"))


__all__ = ["BUCKETS", "in_order", "numbered"]
