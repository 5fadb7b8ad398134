"""Numeric expressions on raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def safe_number(col: Column) -> Column:
    """Text or number as double; junk, NaN and infinities become null.

    The pattern is evaluated once, before the cast, which would accept "5d" and
    "nan": what it does not match is an empty text, and that casts to null.
    """
    text = F.trim(F.translate(col.cast("string"), "\t\r\n", "   "))
    value = F.regexp_extract(text, NUMBER, 0).try_cast("double")
    return F.nullif(F.nullif(value, F.lit(float("inf"))), F.lit(float("-inf")))


def finite(col: Column) -> Column:
    """A floating column without NaN and infinities."""
    return F.when(F.abs(col) < float("inf"), col)


def strict_integer(col: Column) -> Column:
    """Integer cast that fails the job on junk (ANSI cast)."""
    return col.cast("bigint")


def safe_integer(col: Column) -> Column:
    """Integer cast, null on junk."""
    return col.try_cast("bigint")


def integer_text(col: Column) -> Column:
    """Numeric text cut to its integer part ("7.9" to "7"), other text trimmed."""
    whole = safe_number(col).try_cast("bigint").cast("string")
    return F.coalesce(whole, F.trim(col))


def bounded_label(col: Column, low: int, high: int, other: str) -> Column:
    """Integer part as text if it lies inside a closed domain, else the label."""
    value = safe_number(col).try_cast("bigint")
    return F.when(value.between(low, high), value.cast("string")).otherwise(other)


def additive_index(*points: Column) -> Column:
    """Sum of points, null unless all are present."""
    total = points[0]
    for p in points[1:]:
        total = total + p
    return total
