"""Typing of hand-made CSV text without failing on bad fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_PATTERN = "dd.MM.yyyy"
NULL_WORD = "null"


def decimal_comma(text: Column) -> Column:
    """'12,5' to 12.5; text that is no number becomes NULL."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def spaced_int(text: Column) -> Column:
    """'1 200' to 1200; text that is no number becomes NULL."""
    return F.replace(text, F.lit(" "), F.lit("")).try_cast("int")


def day_month_year(text: Column) -> Column:
    return F.try_to_date(text, DATE_PATTERN)


def clear_null_words(df: DataFrame, *names: str) -> DataFrame:
    """The word 'null' stands for a missing value in the hand-made files."""
    return df.replace({NULL_WORD: None}, subset=list(names))
