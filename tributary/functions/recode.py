"""Recoding, code lookup, bands and points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.numbers import safe_number


def literal(value: str | int | None) -> str:
    """A text or whole number as an SQL literal."""
    if value is None or isinstance(value, int):
        return "NULL" if value is None else str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lookup(col: Column, mapping: Mapping) -> Column:
    """Value of a small dictionary, null where the key is not listed.

    The dictionary is one map literal in the plan. Large ones belong in a table
    that is joined.
    """
    entries = ", ".join(literal(x) for pair in mapping.items() for x in pair)
    return F.try_element_at(F.expr(f"map({entries})"), col)


def recode(col: Column, mapping: Mapping[str, str]) -> Column:
    """Whole values replaced by a small dictionary, others kept."""
    return F.coalesce(lookup(col, mapping), col)


def code_label(col: Column, mapping: Mapping[int, str]) -> Column:
    """Label of a numeric code given as text or number; unlisted codes are null."""
    code = safe_number(col)
    return lookup(F.when(code == F.floor(code), code.try_cast("int")), mapping)


def only_listed(col: Column, values: Sequence[str], other: str) -> Column:
    """Listed values kept; anything else, null included, becomes the label."""
    return F.when(col.isin(list(values)), col).otherwise(other)


def band(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands (e0, e1], (e1, e2], ...; outside them null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per pair of neighbouring edges is needed")
    cases = F
    for low, high, name in zip(edges, edges[1:], labels):
        cases = cases.when((col > low) & (col <= high), F.lit(name))
    return cases


def points(col: Column, groups: Sequence[tuple[Sequence[str], int]], default: int = 0) -> Column:
    """Points of the first group that lists the value, else the default."""
    cases = F
    for values, score in groups:
        cases = cases.when(col.isin(list(values)), F.lit(score))
    return cases.otherwise(default)


def presence_flag(present: Column, reported: str, unknown: str) -> Column:
    return F.when(present, F.lit(reported)).otherwise(F.lit(unknown))
