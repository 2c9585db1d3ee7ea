"""Keyed changes to a table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotline.functions.times import at as moment
from depotline.operators.history import latest_version


def _newest_change(changes: DataFrame, key: Sequence[str], columns: Sequence[str],
                   stamp: str) -> DataFrame:
    newest = latest_version(changes.select(*key, *columns, stamp), key, [stamp])
    renamed = [F.col(c).alias(f"_new_{c}") for c in (*columns, stamp)]
    return newest.select(*key, F.lit(True).alias("_hit"), *renamed)


def apply_changes(target: DataFrame, changes: DataFrame, key: Sequence[str],
                  columns: Sequence[str], stamp: str = "updated_at") -> DataFrame:
    """The whole target with the named columns and the stamp replaced where a change exists.

    Of several changes to a key the newest counts; a change without a target row
    does nothing.
    """
    joined = target.join(_newest_change(changes, key, columns, stamp), list(key), "left")
    replaced = {*columns, stamp}
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in replaced else F.col(c)
            for c in target.columns
        ]
    )


def changed_versions(target: DataFrame, changes: DataFrame, key: Sequence[str],
                     columns: Sequence[str], stamp: str = "updated_at") -> DataFrame:
    """Only the rows a change touches, in their new version.

    Appended to a table that keeps versions this does the same as rewriting it.
    """
    joined = target.join(_newest_change(changes, key, columns, stamp), list(key), "inner")
    replaced = {*columns, stamp}
    return joined.select(
        *[F.col(f"_new_{c}").alias(c) if c in replaced else F.col(c) for c in target.columns]
    )


def change_summary(old: DataFrame, new: DataFrame, key: Sequence[str],
                   compared: Sequence[str]) -> DataFrame:
    """One row per kind of change, ``change`` and ``row_count``; keys are unique on both sides."""
    def side(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(*key, F.struct(*[F.col(c) for c in compared]).alias(name))

    both = side(old, "_old").join(side(new, "_new"), list(key), "full")
    change = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "deleted")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("updated")
    )
    return both.groupBy(change.alias("change")).agg(F.count(F.lit(1)).alias("row_count"))


def soft_delete(target: DataFrame, keys: DataFrame, key: Sequence[str], when: datetime,
                flag: str = "is_active", stamp: str = "updated_at") -> DataFrame:
    """Clear the active flag of the given keys; their rows stay."""
    gone = keys.select(*key).distinct().withColumn("_gone", F.lit(True))
    joined = target.join(gone, list(key), "left")
    values = {flag: F.lit(False), stamp: moment(when)}
    return joined.select(
        *[
            F.when(F.col("_gone"), values[c]).otherwise(F.col(c)).alias(c)
            if c in values else F.col(c)
            for c in target.columns
        ]
    )


def active_only(rows: DataFrame, flag: str = "is_active") -> DataFrame:
    """The rows a current view shows."""
    return rows.where(F.col(flag))


def late_rows(source: DataFrame, staged: DataFrame, key: Sequence[str], mark: datetime,
              since: datetime | None = None, stamp: str = "updated_at") -> DataFrame:
    """Source rows at or below the mark that staging has not seen in this version.

    ``since`` bounds the look-back; both scans then skip what is older. Rows without a stamp,
    which no extract past a mark ever meets, are among them until they are staged. Only keys and
    stamps of the staged side are read.
    """
    window = F.col(stamp) <= moment(mark)
    if since is not None:
        window = window & (F.col(stamp) >= moment(since))
    window = window | F.col(stamp).isNull()
    seen = staged.where(window).select(*[F.col(c).alias(f"_seen_{c}") for c in (*key, stamp)]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_seen_{c}")) for c in (*key, stamp)])
    return source.where(window).join(seen, same, "left_anti")
