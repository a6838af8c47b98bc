"""Lenient typing: what does not parse becomes null, nothing raises."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# The words read as booleans and the marker of impossible amounts.
TRUE_WORDS = ("true", "1", "oui")
FALSE_WORDS = ("false", "0", "non")
IMPOSSIBLE_AMOUNT = "12311111111"
AMOUNT_DIGITS = 11

WHOLE = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def whole_number(c: Column, kind: str = "smallint") -> Column:
    return F.when(c.rlike(WHOLE), c.try_cast(kind))


def decimal_number(c: Column, kind: str = "double") -> Column:
    return F.when(c.rlike(DECIMAL), c.try_cast(kind))


def flag_word(c: Column) -> Column:
    word = F.lower(c)
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def iso_date(c: Column) -> Column:
    return F.try_to_date(c, "yyyy-MM-dd")


def not_after(c: Column, as_of: date) -> Column:
    """A date later than ``as_of`` is an error and becomes null."""
    return F.when(c <= F.lit(as_of), c)


def plausible_amount(c: Column) -> Column:
    """Amounts of more than eleven digits get a marker that is easy to find again.

    The value counts as well as the text, so that ``1.0E17`` is caught.
    """
    long_text = F.length(F.substring_index(c, ".", 1)) > AMOUNT_DIGITS
    too_big = decimal_number(c) >= F.lit(10.0**AMOUNT_DIGITS)
    return F.when(long_text | F.coalesce(too_big, F.lit(False)), F.lit(IMPOSSIBLE_AMOUNT)).otherwise(c)


def remaining_months(start: Column, months: Column, as_of: date) -> Column:
    """Months left on ``as_of`` with a month of 30.5 days: never negative, never above the duration."""
    end = F.date_add(start, (months * F.lit(30.5)).cast("int"))
    left = F.round(F.datediff(end, F.lit(as_of)) / F.lit(30), 1)
    floored = F.when(left < 0, F.lit(0.0)).otherwise(left)
    return F.when(floored > months, months.cast("double")).otherwise(floored)
