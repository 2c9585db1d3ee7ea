"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PHONE_DIGITS = 12


def without_dashes(value: Column) -> Column:
    """A uuid as 32 hex digits."""
    return F.replace(value, F.lit("-"), F.lit(""))


def user_name(first: Column, last: Column, suffix: str = "") -> Column:
    """``first.last`` in lower case, blanks and dashes taken out."""
    joined = F.concat(first, F.lit("."), last, F.lit(suffix))
    return F.translate(F.lower(joined), " -", "")


def email_address(user: Column, number: Column, domain: Column) -> Column:
    """``user`` + ``number`` + ``@`` + ``domain``."""
    return F.concat(user, number.cast("string"), F.lit("@"), domain)


def phone_digits(value: Column, keep: int | None = PHONE_DIGITS) -> Column:
    """The digits of a phone number, the first ``keep`` of them unless None."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return digits if keep is None else F.substring(digits, 1, keep)


def is_short_phone(value: Column) -> Column:
    """True where fewer digits than a full number are left."""
    return F.length(phone_digits(value)) < PHONE_DIGITS


def slug(value: Column) -> Column:
    """Lower case with underscores for blanks."""
    return F.translate(F.lower(value), " ", "_")


def first_word(value: Column) -> Column:
    """The first word in lower case, dashes taken out."""
    words = F.split(F.trim(value), r"\s+")
    return F.translate(F.lower(F.element_at(words, 1)), "-", "")


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def with_suffix(name: Column, suffix: str) -> Column:
    """The name followed by a blank and the suffix."""
    return F.concat(name, F.lit(" " + suffix))


def upper_code(value: Column) -> Column:
    return F.upper(value)
