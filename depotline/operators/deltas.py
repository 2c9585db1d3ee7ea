"""Sums that are kept up to date by what changed.

A sum over a fact is changed by the rows that left it, with their sign turned, and the rows that
came in. Both are grouped before they meet the stored sums, so a change costs what it
touches and not the fact.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Sums:
    """Figures that are sums over the rows of a fact: groups and values in SQL over a row.

    The column ``rows`` counts the rows of a group, so that one whose rows are all gone can be
    told from one whose sums are zero.
    """

    fact: str
    by: Mapping[str, str]
    values: Mapping[str, str]
    where: str = "true"
    rows: str = "_rows"


def _named(columns: Mapping[str, str]) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in columns.items()]


def _grouped(rows: DataFrame, sums: Sums) -> DataFrame:
    added = [F.sum(c).alias(c) for c in (*sums.values, sums.rows)]
    return rows.groupBy(*sums.by).agg(*added)


def totals(fact: DataFrame, sums: Sums, sign: int = 1) -> DataFrame:
    """Group columns, sums and row counts of a fact's rows; with sign -1 as they leave. NULL adds 0."""
    valued = [(F.coalesce(F.expr(sql), F.lit(0)) * sign).alias(name) for name, sql in sums.values.items()]
    rows = fact.where(sums.where).select(*_named(sums.by), *valued, F.lit(sign).cast("bigint").alias(sums.rows))
    return _grouped(rows, sums)


def change(old: DataFrame, new: DataFrame, sums: Sums) -> DataFrame:
    """What a fact's sums change by when the rows ``old`` become the rows ``new``."""
    return _grouped(totals(old, sums, -1).unionByName(totals(new, sums)), sums)


def merged(stored: DataFrame, changed: DataFrame, sums: Sums) -> DataFrame:
    """The stored sums with a change taken in; groups without rows are gone."""
    both = _grouped(stored.unionByName(changed), sums)
    kept = both.where(F.col(sums.rows) != 0)
    kinds = dict(stored.dtypes)
    return kept.select(*sums.by, *[F.col(c).cast(kinds[c]).alias(c) for c in (*sums.values, sums.rows)])
