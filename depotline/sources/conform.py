"""Fit rows to a target layout."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECTED, GIVEN = "_rejected", "_given"


def _misfit(field: T.StructField, held: Mapping[str, str], lengths: Mapping[str, int]) -> Column | None:
    """Does a value not fit its target type or length? None where it always does."""
    value = F.col(field.name)
    found = None
    if held[field.name] != field.dataType.simpleString():
        found = value.isNotNull() & value.try_cast(field.dataType).isNull()
    if field.name in lengths:
        long = F.coalesce(F.char_length(value.try_cast("string")) > lengths[field.name], F.lit(False))
        found = long if found is None else found | long
    return found


def conform(rows: DataFrame, schema: T.StructType, lengths: Mapping[str, int] | None = None) -> DataFrame:
    """Cast, order and complete the columns; ``_rejected`` lists what did not fit, ``_given`` as it was.

    A value of another type, out of a number's range or longer than ``lengths`` allows becomes NULL
    and its row is marked, not dropped; ``_given`` maps such columns to the text of their values.
    A column the rows lack is NULL, one the layout lacks is left out.
    """
    held = dict(rows.dtypes)
    wrong = {f.name: found for f in schema if f.name in held
             and (found := _misfit(f, held, lengths or {})) is not None}

    def fitted(field: T.StructField) -> Column:
        if field.name not in held:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name).try_cast(field.dataType)
        if field.name in wrong:
            value = F.when(~wrong[field.name], value)
        return value.alias(field.name)

    names = F.array_compact(F.array(*[F.when(w, F.lit(n)) for n, w in wrong.items()])) if wrong else (
        F.array().cast("array<string>"))
    pairs = F.array_compact(F.array(*[
        F.when(w, F.struct(F.lit(n).alias("key"), F.col(n).cast("string").alias("value")))
        for n, w in wrong.items()])) if wrong else None
    given = F.lit(None).cast("map<string,string>") if pairs is None else F.map_from_entries(pairs)
    return rows.select(*map(fitted, schema), names.alias(REJECTED), given.alias(GIVEN))


def fits() -> Column:
    """Is a conformed row whole?"""
    return F.size(REJECTED) == 0


def accepted(conformed: DataFrame) -> DataFrame:
    return conformed.where(fits()).drop(REJECTED, GIVEN)


def rejected(conformed: DataFrame) -> DataFrame:
    return conformed.where(~fits())
