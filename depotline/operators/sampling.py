"""First rows and repeatable random rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_rows(rows: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The first n rows by key: each task keeps n, nothing is sorted as a whole."""
    return rows.orderBy(*keys).limit(n)


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows that look random but are the same for the same seed."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return rows.orderBy(draw, key).limit(n)
