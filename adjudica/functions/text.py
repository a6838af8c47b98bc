"""Text repairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Patterns and words that decide the published results.
ID_CHARACTERS = " ,\\./"
APOSTROPHE_IN_WORD = r"(?U)(\w)'(\w)"
WHITE_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
CONTROL_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
NOT_COMMUNICATED = "NC"
NATURE_SPELLING = {"Marche": "Marché", "subsequent": "subséquent"}
PRODUCT_CODE_LENGTH = 8


def tidy_id(c: Column) -> Column:
    """Spaces, commas, dots and slashes of an identifier become underscores."""
    return F.translate(c, ID_CHARACTERS, "_" * len(ID_CHARACTERS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def replace_words(c: Column, words: dict[str, str]) -> Column:
    """Replace several substrings, the longest first so that a contained one cannot cut it."""
    longest_first = sorted(words, key=len, reverse=True)
    return reduce(lambda acc, w: F.replace(acc, F.lit(w), F.lit(words[w])), longest_first, c)


def before(c: Column, mark: str) -> Column:
    """Text up to the first occurrence of a literal mark; all of it if there is none."""
    return F.substring_index(c, mark, 1)


def product_code(c: Column) -> Column:
    """Product code without its check digit, padded or cut to eight characters."""
    return F.rpad(before(c, "-"), PRODUCT_CODE_LENGTH, "0")


def pad_left(c: Column, width: int, fill: str = "0") -> Column:
    """Pad on the left and never cut, which ``lpad`` alone would do."""
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def one_line(c: Column) -> Column:
    """Runs of white space become one space, the ends none."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def typographic_apostrophes(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("'")), F.regexp_replace(c, APOSTROPHE_IN_WORD, "$1’$2")).otherwise(c)


def without_control_characters(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL_CHARACTERS, "")


def not_communicated_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(NOT_COMMUNICATED))


def address_line(*parts: Column) -> Column:
    """Address parts on one line, missing ones left out."""
    return one_line(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


def composite(*parts: Column, mark: str = "__") -> Column:
    """Parts joined by a mark; null as soon as one part is null."""
    spaced = [x for p in parts for x in (F.lit(mark), p)][1:]
    return F.concat(*spaced)


def composite_part(c: Column, position: int, mark: str = "__") -> Column:
    return F.get(F.split(c, mark), F.lit(position))
