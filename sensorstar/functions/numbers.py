"""Number coercion, one function per rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: texts that count as a number (no suffix letters, no hex).
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def whole_number(text: Column) -> Column:
    """Whole numbers only; anything else is NULL."""
    return text.try_cast("int")


def truthy_number(text: Column) -> Column:
    """Zero and blank count as missing; a fraction is cut off."""
    number = F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    return F.nullif(number.try_cast("int"), F.lit(0))


def number_or_null(text: Column) -> Column:
    """Any decimal number text; ``3f`` or words are NULL."""
    return F.when(text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value.cast("string").try_cast("double"), F.lit(0.0))
