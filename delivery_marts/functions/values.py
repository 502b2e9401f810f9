"""Cleaning and derivation of single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a cleaned phone may not hold, the trunk digit of a number of eleven
# digits and the country digit that takes its place, the stand-in for "not replaced".
NON_DIGIT = "[^0-9]"
TRUNK_DIGIT = "^8(?=[0-9]{10}$)"
COUNTRY_DIGIT = "7"
NO_REPLACEMENT = -1


def normalize_phone(phone: Column) -> Column:
    """ASCII digits of a phone, the trunk digit of a full number made the country digit.

    A phone without digits is NULL. Only ASCII digits count, as in the quality check
    on phones: other scripts' digits are stripped.
    """
    digits = F.regexp_replace(phone, NON_DIGIT, "")
    return F.nullif(F.regexp_replace(digits, TRUNK_DIGIT, COUNTRY_DIGIT), F.lit(""))


def has_non_digit(phone: Column) -> Column:
    return phone.rlike(NON_DIGIT)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def unfill_replaced_id(replaced_id: Column) -> Column:
    """A raw -1 means the same as NULL: the line was not replaced."""
    return F.nullif(replaced_id, F.lit(NO_REPLACEMENT))


def address_city(address: Column) -> Column:
    """Text before the first comma, untrimmed; the whole text where there is none."""
    return F.substring_index(address, ",", 1)


def date_parts(moment: Column) -> dict[str, Column]:
    return {"year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)}
