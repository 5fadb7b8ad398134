"""Label and one-hot encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.keys import attach_number, number_distinct


def label_mapping(df: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct values with their 0-based code in sorted order, nulls left out."""
    known = df.filter(F.col(column).isNotNull())
    return number_distinct(known, [column], code, start=0).table


def label_encode(df: DataFrame, column: str, code: str) -> DataFrame:
    """The code of each value as a further column; null has no code."""
    known = df.filter(F.col(column).isNotNull())
    codes = number_distinct(known, [column], code, start=0)
    return attach_number(df, codes.for_join(), [column], code)


def one_hot(
    df: DataFrame,
    column: str,
    prefix: str,
    values: Sequence[str] | None = None,
    max_columns: int | None = None,
) -> DataFrame:
    """A 0/1 column per value; a null row is 0 everywhere.

    Values not given are looked up by one job, which needs ``max_columns``: each
    value becomes a column, and more of them than the caller allows is an error.
    """
    if values is None:
        if max_columns is None:
            raise ValueError(f"give the values of '{column}' or the most columns to make of them")
        found = (
            df.select(column).filter(F.col(column).isNotNull()).distinct().limit(max_columns + 1)
        ).collect()
        if len(found) > max_columns:
            raise ValueError(f"'{column}' has more than {max_columns} values")
        values = sorted(row[0] for row in found)
    return df.withColumns(
        {
            f"{prefix}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0))
            for v in values
        }
    )
