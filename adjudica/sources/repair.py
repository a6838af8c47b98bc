"""Repairs of raw payload text before it is parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adjudica.functions.text import without_control_characters

# What the senders are known to get wrong.
BYTE_ORDER_MARK = "\ufeff"
NOT_A_NUMBER = r"NaN([,\n])"
QUOTED_TITLE = r'"objet":"(.*?)","'


def json_text(c: Column) -> Column:
    """Drop byte order marks and write null for NaN."""
    return F.regexp_replace(F.replace(c, F.lit(BYTE_ORDER_MARK), F.lit("")), NOT_A_NUMBER, "null$1")


def stray_backslashes(c: Column) -> Column:
    """Three or two backslashes become one, and one before a space goes."""
    halved = F.replace(F.replace(c, F.lit("\\" * 3), F.lit("\\")), F.lit("\\" * 2), F.lit("\\"))
    return F.replace(halved, F.lit("\\ "), F.lit(" "))


def title_quotes(c: Column) -> Column:
    """Escape the quotation marks inside titles that do not parse.

    Titles alternate with the text around them once the payload is cut at their borders.
    """
    marked = F.regexp_replace(c, QUOTED_TITLE, '"objet":"\u0001$1\u0001","')
    pieces = F.split(marked, "\u0001")
    escaped = F.transform(
        pieces, lambda p, i: F.when(i % 2 == 1, F.regexp_replace(p, r'(?<!\\)"', r'\\"')).otherwise(p)
    )
    return F.array_join(escaped, "")


def parses(c: Column) -> Column:
    """Whether a text is a JSON object or list. Fields are skipped over, so the size doesn't matter."""
    read = F.from_json(c, "_none string, _corrupt_record string")
    fine = read.isNotNull() & read["_corrupt_record"].isNull() & (F.trim(c) != "")
    return F.when(F.ltrim(c).startswith("["), F.from_json(c, "array<string>").isNotNull()).otherwise(fine)


def checked(df: DataFrame, column: str = "payload", replacements: dict[str, str] | None = None) -> DataFrame:
    """Payloads after repair, and in ``readable`` whether they parse now.

    One that parses is only checked, once. One that does not gets its titles escaped and the given
    replacements made, and is checked again. One that can't be mended is left as it came.
    """
    mended = title_quotes(F.col(column))
    for wrong, right in (replacements or {}).items():
        mended = F.replace(mended, F.lit(wrong), F.lit(right))
    first = df.withColumn("_came", F.col(column)).withColumn(column, json_text(F.col(column)))
    tried = (
        first.withColumn("_fine", F.coalesce(parses(F.col(column)), F.lit(False)))
        .withColumn(column, F.when(F.col("_fine"), F.col(column)).otherwise(mended))
        .withColumn("readable", F.col("_fine") | F.coalesce(parses(F.col(column)), F.lit(False)))
    )
    return tried.withColumn(column, F.when(F.col("readable"), F.col(column)).otherwise(F.col("_came"))).drop("_fine", "_came")


def split_rejects(
    df: DataFrame, column: str = "payload", replacements: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Payloads that parse after repair, and those that do not."""
    both = checked(df, column, replacements)
    return both.where("readable").drop("readable"), both.where("not readable").drop("readable")


def xml_text(c: Column) -> Column:
    return without_control_characters(c)
