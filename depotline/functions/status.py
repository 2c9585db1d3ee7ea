"""Order statuses and funnel stages."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotline.schemas import FUNNEL_STAGES, NEXT_STATUS


def expected_payment(order_status: Column) -> Column:
    """The payment status an order status asks for."""
    return F.when(order_status.isin("Shipped", "Delivered"), F.lit("paid")).otherwise(
        F.lit("pending")
    )


def next_status(order_status: Column, cancel: Column | None = None) -> Column:
    """One step on; statuses without a step stay.

    ``cancel`` decides the one status that has two ways on. Without it every
    order takes the first.
    """
    result = order_status
    for status, targets in NEXT_STATUS.items():
        target = F.lit(targets[0])
        if len(targets) > 1 and cancel is not None:
            target = F.when(cancel, F.lit(targets[1])).otherwise(target)
        result = F.when(order_status == status, target).otherwise(result)
    return result


def stages_after(stage: Column, stages: Sequence[str] = FUNNEL_STAGES) -> Column:
    """The later stages, in order; empty for the last one, NULL for an unknown one."""
    listed = F.array(*[F.lit(s) for s in stages])
    position = F.array_position(listed, stage).cast("int")
    return F.when(position > 0, F.slice(listed, position + 1, F.lit(len(stages))))


def stage_rank(stage: Column, stages: Sequence[str] = FUNNEL_STAGES) -> Column:
    """1 for the first stage, 0 for an unknown one."""
    return F.array_position(F.array(*[F.lit(s) for s in stages]), stage).cast("int")


def others(values: Sequence[str], taken: Column) -> Column:
    """The list without one value."""
    return F.array_remove(F.array(*[F.lit(v) for v in values]), taken)


def _side(key: Column, ranges: Mapping[str, tuple[int, int]], side: int) -> Column:
    pairs = [F.lit(part) for name, bounds in ranges.items() for part in (name, bounds[side])]
    return F.try_element_at(F.create_map(*pairs), key)


def range_low(key: Column, ranges: Mapping[str, tuple[int, int]]) -> Column:
    """Lower bound for a key, NULL for an unknown one."""
    return _side(key, ranges, 0)


def range_high(key: Column, ranges: Mapping[str, tuple[int, int]]) -> Column:
    return _side(key, ranges, 1)


def in_range_of(value: Column, key: Column, ranges: Mapping[str, tuple[int, int]]) -> Column:
    """Does the value lie in the range its key allows, both ends included?"""
    return value.between(range_low(key, ranges), range_high(key, ranges))


def advance(leads: DataFrame, stage: str, score: str, target: Column,
            score_of: Callable[[Column], Column]) -> DataFrame:
    """Add ``new_stage`` and ``new_score``.

    A lead moves to its target stage if that comes later, and is rescored for it;
    a lead whose target is NULL or not later keeps both.
    """
    moves = F.coalesce(F.array_contains(stages_after(F.col(stage)), target), F.lit(False))
    return leads.withColumns({
        "new_stage": F.when(moves, target).otherwise(F.col(stage)),
        "new_score": F.when(moves, score_of(target)).otherwise(F.col(score)),
    })
