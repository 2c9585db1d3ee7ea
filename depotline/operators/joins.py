"""Joins.

Plain equi-joins are left to Spark: it broadcasts a side by its measured size and
adaptive execution splits a hot key of a shuffled join. No side is hinted. Where
only totals are needed the many-side is grouped before it is joined, so a hot key
arrives as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVERYONE = "*"


def enrich(facts: DataFrame, dimension: DataFrame, on: Sequence[str],
           columns: Sequence[str]) -> DataFrame:
    """Add columns of the one matching dimension row; NULL where there is none."""
    return facts.join(dimension.select(*on, *columns), list(on), "left")


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows that point at no parent. A NULL reference points at nothing and is no orphan.

    The looked-up side is made distinct before its shuffle, so copies cost nothing.
    """
    keys = parent.select(F.col(key).alias(foreign_key)).distinct()
    return child.where(F.col(foreign_key).isNotNull()).join(keys, foreign_key, "left_anti")


def without_children(parent: DataFrame, key: str, child: DataFrame, foreign_key: str) -> DataFrame:
    """Parent rows nothing points at."""
    used = child.select(F.col(foreign_key).alias(key)).distinct()
    return parent.join(used, key, "left_anti")


def with_total(parent: DataFrame, key: str, child: DataFrame, foreign_key: str,
               amount: str, total: str) -> DataFrame:
    """Sum the children per parent and look the sum up on the parent."""
    sums = child.groupBy(F.col(foreign_key).alias(key)).agg(F.sum(amount).alias(total))
    return parent.join(sums, key, "left")


def spread(key: Column) -> Column:
    """A number from 0 to 2^60 that depends on the key alone."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("bigint")


def numbered(rows: DataFrame, group: str, key: str, position: str, digits: int = 4) -> DataFrame:
    """Number the rows of each group 0, 1, 2 ... without gathering a group.

    A group is cut into 16^digits slices by a hash of the unique key. Rows are
    numbered inside a slice; a slice starts where the counts of the earlier
    slices end. Only those counts, at most 16^digits per group, meet in one task.
    """
    sliced = rows.withColumn("_slice", F.substring(F.md5(F.col(key).cast("string")), 1, digits))
    inside = Window.partitionBy(group, "_slice").orderBy(key)
    earlier = (Window.partitionBy(group).orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        sliced.groupBy(group, "_slice").count()
        .select(group, "_slice", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    )
    return (
        sliced.withColumn("_inside", F.row_number().over(inside))
        .join(starts, [group, "_slice"])
        .withColumn(position, F.col("_start") + F.col("_inside") - 1)
        .drop("_slice", "_inside", "_start")
    )


def match_in_group(left: DataFrame, candidates: DataFrame, left_key: str, candidate_key: str,
                   group: str, digits: int = 4) -> DataFrame:
    """Give every left row one candidate of its own group, or of all if the group has none.

    The choice is spread evenly and depends on the left key alone. Result: the
    left columns and ``candidate_key``; with no candidate at all it is NULL.
    """
    pooled = candidates.select(
        F.col(candidate_key),
        F.explode(F.array(F.col(group).cast("string"), F.lit(EVERYONE))).alias("_pool"),
    )
    pooled = pooled.where(F.col("_pool").isNotNull())
    seats = numbered(pooled, "_pool", candidate_key, "_seat", digits)
    sizes = pooled.groupBy("_pool").agg(F.count(F.lit(1)).alias("_size"))
    everyone = sizes.where(F.col("_pool") == EVERYONE).select("_size").scalar()

    wanted = left.join(sizes, left[group].cast("string") == sizes["_pool"], "left").withColumns({
        "_pool": F.coalesce("_pool", F.lit(EVERYONE)),
        "_seat": F.pmod(spread(F.col(left_key)), F.coalesce(F.col("_size"), everyone)),
    })
    return wanted.join(seats, ["_pool", "_seat"], "left").drop("_pool", "_seat", "_size")
