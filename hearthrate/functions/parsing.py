"""Parsers for the text fields of a raw listings export."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hearthrate.functions.nulls import flag, ratio

# Text forms accepted as a number. Java would also take '1d' or 'NaN'.
NUMBER_FORM = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def text_to_double(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(NUMBER_FORM), trimmed.try_cast("double"))


def currency(text: Column) -> Column:
    """``$1,234.00`` to 1234.0; anything unreadable to NULL."""
    return text_to_double(F.regexp_replace(text, r"[$,]", ""))


def percent(text: Column) -> Column:
    """``95%`` to 95.0; anything unreadable to NULL."""
    return text_to_double(F.replace(text, F.lit("%"), F.lit("")))


def yes(text: Column) -> Column:
    """The export writes booleans as 't' and 'f'; missing counts as no."""
    return flag(text == "t")


def day(text: Column) -> Column:
    return F.try_to_date(text)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def years_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier) / F.lit(365.25)


def json_item_count(text: Column) -> Column:
    """Items of a JSON array (or keys of an object); comma tokens for other text; 0 if blank."""
    blank = text.isNull() | (F.trim(text) == "")
    return F.when(blank, 0).otherwise(
        F.coalesce(
            F.json_array_length(text),
            F.size(F.json_object_keys(text)),
            F.size(F.split(text, ",")),
        )
    )


def row_mean(columns: list[Column]) -> Column:
    """Mean over the values present in a row; NULL if there is none."""
    total, seen = F.lit(0.0), F.lit(0)
    for column in columns:
        total = total + F.coalesce(column.cast("double"), F.lit(0.0))
        seen = seen + column.isNotNull().cast("int")
    return ratio(total, seen)
