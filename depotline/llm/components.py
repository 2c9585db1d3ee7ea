"""Connected components of links, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotline.session import written


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in the links (a, b); the component is its least node.

    Large-star and small-star steps in turn: each hangs a node's neighbours under the least
    of them, so that links become stars under the components' least nodes in a logarithmic
    number of rounds. Each round is a written table in the shared folder; what reaches the
    driver is a count and a checksum.
    """
    now = written(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    seen = _signature(now)
    while seen[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), "m").distinct()
        large = written(large.filter("a <> m").toDF("a", "b"), "components")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lowest, "a").filter("b <> m").select(F.col("b").alias("a"), "m")
                 .union(lowest).distinct())
        now = written(small.toDF("a", "b"), "components")
        after = _signature(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
