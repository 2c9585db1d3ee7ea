"""Timestamps without a zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_time() -> datetime:
    """The one time stamp a run uses for everything it writes."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def at(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def parse_timestamp(text: Column) -> Column:
    """NULL where the text is no timestamp."""
    return text.try_cast("timestamp_ntz")


def later_of(first: Column, second: Column) -> Column:
    return F.greatest(first, second)


def month_of(moment: Column) -> Column:
    """``yyyy-MM``, taken from the date so no session time zone plays in."""
    return F.substring(moment.cast("date").cast("string"), 1, 7)


def day_of(moment: Column) -> Column:
    return moment.cast("date").cast("string")
