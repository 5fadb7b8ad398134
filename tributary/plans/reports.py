"""Reports on a star of a fact and its dimensions.

Facts are counted per foreign key before they meet a dimension. The join then
sees one row per key however often the key occurs, and only counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.aggregate import MOST_COLUMNS, argmax_per_group, pivot_first
from tributary.operators.star import star_join


def count_by(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, str, str]],
    columns: Sequence[str],
    out: str = "total",
    how: str = "inner",
) -> DataFrame:
    """Fact rows per combination of dimension columns."""
    keys = [fact_key for _, fact_key, _ in dims]
    counted = fact.groupBy(*keys).agg(F.count("*").alias("__n"))
    joined = star_join(counted, dims, how)
    return joined.groupBy(*columns).agg(F.sum("__n").alias(out))


def sql_report(spark: SparkSession, tables: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """An SQL text over tables, each visible under its name."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return spark.sql(sql)


def counts_over_time(
    counts: DataFrame, period: str, group: str, values, total: str, max_columns: int = MOST_COLUMNS
) -> DataFrame:
    """Counts with one row per period and one column per group value."""
    return pivot_first(counts, period, group, values, total, max_columns)


def most_common(
    fact: DataFrame,
    group: tuple[DataFrame, str, str],
    value: tuple[DataFrame, str, str],
    group_column: str,
    value_column: str,
) -> DataFrame:
    """Most frequent value of one dimension per value of another, by left joins."""
    counts = count_by(fact, [group, value], [group_column, value_column], "n", "left")
    known = counts.filter(F.col(group_column).isNotNull() & F.col(value_column).isNotNull())
    return argmax_per_group(known, [group_column], "n", [value_column], {"n": "total"})
