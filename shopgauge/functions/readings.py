"""Measurement text: one number or a `;` list of numbers, possibly with junk between them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a plain number, and the digits that make a text worth reading.
NUMBER = r"^[-+]?[0-9]*\.?[0-9]+$"
NONZERO_DIGIT = "[1-9]"


def readings(text: Column) -> Column:
    """Array of the plain numbers in a measurement text; junk tokens are left out.

    Most texts are one token, which needs no array functions.
    """
    tokens = F.filter(F.split(text, ";"), lambda token: token.rlike(NUMBER))
    listed = F.transform(tokens, lambda token: token.cast("double"))
    return F.when(text.contains(";"), listed).when(text.rlike(NUMBER), F.array(text.cast("double")))


def reading_sum(values: Column) -> Column:
    """Sum of an array of readings, NULL when there is none."""
    total = F.aggregate(values, F.lit(0.0), lambda total, value: total + value)
    return F.when(F.size(values) == 1, values[0]).when(F.size(values) > 1, total)


def has_nonzero_digit(text: Column) -> Column:
    return text.rlike(NONZERO_DIGIT)


def null_text(text: Column) -> Column:
    """SQL NULL for the spellings of "no value" in raw tables: blank and the word null."""
    trimmed = F.trim(text)
    return F.when(~trimmed.isin("", "null"), trimmed)
