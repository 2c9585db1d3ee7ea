"""Versions of a row over time.

Versions are ordered per key. A key may own a large part of all of them, so the rows
are cut into ranges of key and time, whoever owns them: work runs per part, and one row
per part is carried to the next. The parts are written when a history is built, so that is a
job of its own, before any action on the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotline.functions.times import at as moment
from depotline.session import written

_PART = "_part"


def latest_version(rows: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The newest row per key.

    ``newest`` names the columns that decide, most important first; what they
    leave open the other columns decide, so a replayed load changes nothing. An
    aggregate is used, not a ranking: copies are folded before the shuffle.
    """
    rest = [c for c in rows.columns if c not in key and c not in newest]
    packed = F.max(F.struct(*newest, *rest)).alias("_row")
    return rows.groupBy(*key).agg(packed).select(*key, "_row.*").select(*rows.columns)


def _parted(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows in parts of like size that follow each other in ``order``, numbered in it.

    A key with many versions, NULL included, spans as many parts as it needs. The parts are
    a written table, so that a repeated task finds the same ones.
    """
    ranged = rows.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id())
    return written(ranged, "history")


def _same_key(held: str, key: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"{held}.{k}").eqNullSafe(F.col(k)) for k in key])


def _carried(parted: DataFrame, key: Sequence[str], row: Column, forward: bool,
             giving: Column | None = None) -> DataFrame:
    """Per part the row of its outermost key that lies next to it in the parts before or after.

    A part asks for one row and gives one, so a key meets two small rows per part. ``giving``
    names the rows that may be given; a part without any gives none and is passed over.
    """
    offered = row if giving is None else F.when(giving, row)
    given, wanted = (F.max(offered), F.min(row)) if forward else (F.min(offered), F.max(row))
    ends = parted.groupBy(_PART).agg(given.alias("_given"), wanted.alias("_wanted"))
    sides = ends.select(_PART, F.explode(F.array(
        F.struct(F.lit(False).alias("gives"), F.col("_wanted").alias("row")),
        F.struct(F.lit(True).alias("gives"), F.col("_given").alias("row")))).alias("_side"))
    turn = F.col(_PART) if forward else -F.col(_PART)
    before = (Window.partitionBy(*[F.col(f"_side.row.{k}") for k in key])
              .orderBy(turn, "_side.gives").rowsBetween(Window.unboundedPreceding, -1))
    nearest = F.last(F.when(F.col("_side.gives"), F.col("_side.row")), ignorenulls=True)
    return (sides.withColumn("_carried", nearest.over(before))
            .where(~F.col("_side.gives")).select(_PART, "_carried"))


def _with_previous(parted: DataFrame, key: Sequence[str], at: str,
                   values: Sequence[str]) -> DataFrame:
    row = F.struct(*key, at, *values)
    inside = Window.partitionBy(_PART).orderBy(*key, at, *values)
    before = parted.withColumn("_before", F.lag(row).over(inside)).join(
        _carried(parted, key, row, forward=True), _PART).withColumn(
        "_before", F.coalesce("_before", "_carried"))
    previous = F.struct(*[F.col(f"_before.{v}").alias(v) for v in values])
    found = F.col("_before").isNotNull() & _same_key("_before", key)
    return before.withColumn("previous", F.when(found, previous)).drop("_before", "_carried")


def with_previous(rows: DataFrame, key: Sequence[str], at: str,
                  values: Sequence[str]) -> DataFrame:
    """Add ``previous``: a struct of ``values`` of the version before, NULL for the first."""
    found = _with_previous(_parted(rows, [*key, at, *values]), key, at, values)
    return found.select(*rows.columns, "previous")


def scd2(rows: DataFrame, key: Sequence[str], at: str, tracked: Sequence[str]) -> DataFrame:
    """History of the tracked columns: ``valid_from``, ``valid_to`` (open end), ``is_current``.

    Versions at the same instant count as one, the greatest by the tracked
    columns. A version equal to the one before starts no new row.
    """
    greatest = F.max(F.struct(*tracked)).alias("_state")
    folded = rows.groupBy(*key, at).agg(greatest).select(*key, at, "_state.*")
    starts = _with_previous(_parted(folded, [*key, at]), key, at, tracked)
    same = F.col("previous").eqNullSafe(F.struct(*tracked))
    starts = starts.where(F.col("previous").isNull() | ~same).drop("previous")

    row = F.struct(*key, at)
    inside = Window.partitionBy(_PART).orderBy(*key, at)
    after = starts.withColumn("_after", F.lead(row).over(inside)).join(
        _carried(starts, key, row, forward=False), _PART).withColumn(
        "_after", F.coalesce("_after", "_carried"))
    end = F.when(F.col("_after").isNotNull() & _same_key("_after", key), F.col(f"_after.{at}"))
    return after.withColumn("valid_to", end).select(
        *key, *tracked, F.col(at).alias("valid_from"), "valid_to",
        F.col("valid_to").isNull().alias("is_current"))


def refresh_scd2(history: DataFrame, versions: DataFrame, touched: DataFrame,
                 key: Sequence[str], at: str, tracked: Sequence[str]) -> DataFrame:
    """Rebuild the history of the touched keys from all their versions, keep the rest.

    Versions may arrive late, in the middle of a history, hence the rebuild.
    """
    keys = touched.select(*key).distinct()
    kept = history.join(keys, list(key), "left_anti")
    rebuilt = scd2(versions.join(keys, list(key), "left_semi"), key, at, tracked)
    return kept.unionByName(rebuilt)


def as_of(history: DataFrame, when: datetime) -> DataFrame:
    """The rows of a history that were valid at a moment."""
    then = moment(when)
    open_or_later = F.col("valid_to").isNull() | (F.col("valid_to") > then)
    return history.where((F.col("valid_from") <= then) & open_or_later)


def as_of_join(facts: DataFrame, versions: DataFrame, key: Sequence[str], fact_at: str, at: str,
               columns: Sequence[str]) -> DataFrame:
    """The facts with ``columns`` of the version of their key that held at their own time.

    That is the newest one that began at or before the fact; before the first version, for a key
    without versions and for a NULL key or time the columns are NULL. Versions are one per key and
    ``at``. Facts and versions are put in one order of key and time and cut into parts, so a
    key with a third of all facts spans many parts; the last version is carried from part to
    part. No fact meets more than one version and no side is broadcast.
    """
    asked = facts.select(*key, F.col(fact_at).alias("_at"), F.lit(True).alias("_asks"),
                         F.struct(*[F.col(c) for c in facts.columns]).alias("_fact"))
    told = versions.select(*key, F.col(at).alias("_at"), F.lit(False).alias("_asks"),
                           F.struct(*[F.col(c) for c in columns]).alias("_version"))
    both = asked.unionByName(told, allowMissingColumns=True).withColumn(
        "_spread", F.when(F.col("_asks"), F.xxhash64("_fact")))
    # At one instant the version comes first; facts of one instant may lie in several parts.
    order = [*key, "_at", "_asks", "_spread"]
    parted = _parted(both, order)

    row = F.struct(*key, "_at", "_version")
    before = (Window.partitionBy(_PART).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    held = F.last(F.when(~F.col("_asks"), row), ignorenulls=True).over(before)
    carried = _carried(parted.withColumn("_row", row), key, F.col("_row"), forward=True,
                       giving=~F.col("_asks"))
    found = (parted.withColumn("_held", held).where("_asks").join(carried, _PART)
             .withColumn("_held", F.when(_same_key("_held", key), F.col("_held"))
                         .otherwise(F.when(_same_key("_carried", key), F.col("_carried")))))
    known = reduce(and_, [F.col(k).isNotNull() for k in key]) & F.col("_at").isNotNull()
    return found.select("_fact.*", *[
        F.when(known, F.col(f"_held._version.{c}")).alias(c) for c in columns])


def steps(rows: DataFrame, key: Sequence[str], at: str, status: str) -> DataFrame:
    """Every change from one version to the next: key, at, ``from_status``, ``to_status``."""
    before = with_previous(rows.select(*key, at, status), key, at, [status])
    return before.where(F.col("previous").isNotNull()).select(
        *key, at,
        F.col(f"previous.{status}").alias("from_status"),
        F.col(status).alias("to_status"),
    )


def legal_step(allowed: Mapping[str, Sequence[str]]) -> Column:
    """Is a step from ``from_status`` to ``to_status`` a repeat or allowed?"""
    pairs = [
        part
        for source, targets in allowed.items()
        for part in (F.lit(source), F.array(*[F.lit(t) for t in targets]).cast("array<string>"))
    ]
    targets = F.try_element_at(F.create_map(*pairs), F.col("from_status"))
    return (F.col("from_status") == F.col("to_status")) | F.coalesce(
        F.array_contains(targets, F.col("to_status")), F.lit(False)
    )


def illegal_steps(rows: DataFrame, key: Sequence[str], at: str, status: str,
                  allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Steps that are neither a repeat nor allowed."""
    return steps(rows, key, at, status).where(~legal_step(allowed))
