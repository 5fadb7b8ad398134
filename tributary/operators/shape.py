"""Columns: names, constants, conforming to a schema, union."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tributary.functions.text import fold_literal
from tributary.sources.files import tag


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    twice = [n for n, k in Counter(names).items() if k > 1]
    if twice:
        raise ValueError(f"column names collide after normalising: {sorted(twice)}")
    return df.toDF(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; absent names are ignored."""
    return df.withColumnsRenamed(dict(names))


def lower_names(df: DataFrame) -> DataFrame:
    return _renamed(df, [c.lower() for c in df.columns])


def fold_names(df: DataFrame) -> DataFrame:
    """Column names without accents, in lower case, blanks as underscores."""
    return _renamed(df, [fold_literal(c).replace(" ", "_") for c in df.columns])


def drop(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*names)


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The listed columns the table has, in list order."""
    return [c for c in columns if c in df.columns]


def map_columns(
    df: DataFrame, columns: Sequence[str] | None, fn: Callable[[Column], Column]
) -> DataFrame:
    """Replace columns by an expression of themselves in one projection.

    ``None`` stands for all text columns; columns the table lacks are skipped.
    """
    chosen = text_columns(df) if columns is None else present(df, columns)
    return df.withColumns({c: fn(F.col(c)) for c in chosen}) if chosen else df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the schema's columns, types and order; absent ones are typed nulls."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def union_conformed(tables: Sequence[DataFrame], schema: StructType) -> DataFrame:
    """All rows of all tables after conforming."""
    return reduce(DataFrame.unionByName, [conform(t, schema) for t in tables])


def union_tagged(tables: Mapping[str, DataFrame], schema: StructType) -> DataFrame:
    """Union of tables tagged with their names in the schema's ``source`` column."""
    return union_conformed([tag(t, name) for name, t in tables.items()], schema)


def with_total_rows(df: DataFrame, column: str, total: Column | None = None) -> DataFrame:
    """Number of all rows as a column, from a scalar subquery.

    ``total`` gives the number where a cheaper table than ``df`` has it.
    """
    return df.withColumn(column, df.agg(F.count("*")).scalar() if total is None else total)
