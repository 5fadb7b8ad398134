"""Grouping, shares, modes, histograms and pivots.

Hot keys are harmless here: every group is reduced inside the map tasks before
its shuffle, and no operator gathers the rows of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.numbers import finite
from tributary.functions.recode import presence_flag
from tributary.operators.shape import present

MOST_COLUMNS = 1000  # of a pivot whose values are looked up


def collapse(df: DataFrame, columns: Sequence[str], weight: str) -> DataFrame:
    """Distinct rows over some columns, with the number of rows each stands for.

    Cleaning a table of few distinct rows is cheaper after this than before.
    """
    return group_count(df, columns, weight)


def group_count(
    df: DataFrame, keys: Sequence[str], out: str = "n", weight: str | None = None
) -> DataFrame:
    """Rows per group of the keys the table has; null keys form groups.

    ``weight`` names the column that says how many rows a row stands for.
    """
    rows = F.sum(weight) if weight else F.count("*")
    return df.groupBy(*present(df, keys)).agg(rows.alias(out))


def group_sum(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    out: str | None = None,
    flag: str | None = None,
    labels: tuple[str, str] = ("reported", "unknown"),
    flag_mode: str = "reference",
    weight: str | None = None,
) -> DataFrame:
    """Sum per group of the keys the table has; null keys form groups.

    A group without any value sums to 0. ``flag`` adds a column that tells such
    groups apart (``flag_mode="observed"``) or repeats the constant one gets by
    testing the zero-filled sum (``flag_mode="reference"``).
    """
    out = out or measure
    value = F.col(measure) * F.col(weight) if weight else F.col(measure)
    result = df.groupBy(*present(df, keys)).agg(
        F.coalesce(F.sum(value), F.lit(0)).alias(out),
        F.count(measure).alias("__present"),
    )
    if flag:
        has_value = F.col("__present") > 0 if flag_mode == "observed" else F.col(out).isNotNull()
        result = result.withColumn(flag, presence_flag(has_value, *labels))
    return result.drop("__present")


def consolidate(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Sums of partial sums: one row per distinct key combination."""
    return group_sum(df, keys, measure)


def mean_per_group(df: DataFrame, key: str, measure: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(measure).alias(out))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of a total order."""
    return df.orderBy(*order).limit(k)


def value_shares(df: DataFrame, column: str, k: int | None = None, digits: int = 4) -> DataFrame:
    """Frequency and share in % of each value, nulls left out; optionally the top k.

    The grand total comes from the same scan and shuffle as the counts (a rollup
    row), so a top-k request sorts k + 1 rows per task and nothing more.
    """
    known = df.filter(F.col(column).isNotNull())
    counts = known.rollup(column).agg(F.count("*").alias("n"), F.grouping(column).alias("is_total"))
    if k is None:
        grouped = known.groupBy(column).agg(F.count("*").alias("n"))
        rows = grouped.withColumn("total", grouped.agg(F.sum("n")).scalar())
    else:
        head = counts.orderBy(F.desc("is_total"), F.desc("n"), column).limit(k + 1)
        rows = head.withColumn(
            "total", F.max(F.when(F.col("is_total") == 1, F.col("n"))).over(Window.partitionBy())
        ).filter("is_total = 0")
    share = F.round(F.col("n") * 100.0 / F.col("total"), digits)
    return rows.select(column, "n", share.alias("pct"))


def mode_per_group(
    df: DataFrame, keys: Sequence[str], value: str, out_value: str = "mode", out_count: str = "n"
) -> DataFrame:
    """Most frequent value per group with its count; ties go to the smallest value.

    Two aggregates: rows per (group, value), then the best pair per group.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count("*").alias("__n")
    )
    return argmax_per_group(counted, keys, "__n", [value], {"__n": out_count, value: out_value})


def argmax_per_group(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    columns: Sequence[str],
    names: dict[str, str] | None = None,
) -> DataFrame:
    """The row with the largest ``by`` per group; ties go to the smallest other columns."""
    names = names or {}
    best = F.min(F.struct((-F.col(by)).alias("__neg"), *columns)).alias("__best")
    return df.groupBy(*keys).agg(best).select(
        *keys,
        *[F.col(f"__best.{c}").alias(names.get(c, c)) for c in columns],
        (-F.col("__best.__neg")).alias(names.get(by, by)),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the extremes, last one closed, empty ones kept.

    NaN and infinities count as missing.
    """
    x = finite(F.col(column).cast("double"))
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("ends")).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    bucket = F.when(lo == hi, F.lit(1)).otherwise(F.least(F.width_bucket(x, lo, hi, bins), F.lit(bins)))
    counts = (
        df.filter(x.isNotNull()).groupBy(bucket.cast("long").alias("bin")).agg(F.count("*").alias("n"))
    )
    width = (hi - lo) / bins
    return (
        df.sparkSession.range(1, bins + 1)
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .select(
            "bin",
            (lo + (F.col("bin") - 1) * width).alias("low"),
            (lo + F.col("bin") * width).alias("high"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        )
    )


def ordered_category_count(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """Count per listed category with its position, categories without rows as 0."""
    frame = df.sparkSession.createDataFrame(
        list(enumerate(categories, 1)), f"position long, {column} string"
    )
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return frame.join(counts, column, "left").select(
        "position", column, F.coalesce("n", F.lit(0)).alias("n")
    )


def pivot_first(
    df: DataFrame,
    index: str,
    columns: str,
    values: Sequence | None,
    measure: str,
    max_columns: int = MOST_COLUMNS,
) -> DataFrame:
    """One row per index, one column per value, holding the measure.

    Without ``values`` they are looked up by one job; more than ``max_columns`` of
    them is an error. A value that is not listed, or a second row for one cell, fails
    the job: neither would have a place.
    """
    if values is None:
        found = (
            df.select(columns).filter(F.col(columns).isNotNull()).distinct().limit(max_columns + 1)
        ).collect()
        if len(found) > max_columns:
            raise ValueError(f"'{columns}' has more than {max_columns} values")
        values = sorted(row[0] for row in found)
    cells = df.filter(F.col(columns).isNotNull())
    listed = F.col(columns).isin(list(values)) if values else F.lit(False)
    checked = F.when(listed, F.col(columns)).otherwise(
        F.raise_error(F.concat(F.lit("no column for "), F.col(columns).cast("string")))
    )
    kind = df.schema[columns].dataType
    counted = cells.withColumn(columns, checked.cast(kind)).groupBy(index, columns).agg(
        F.when(F.count("*") == 1, F.first(measure))
        .otherwise(F.raise_error(F.lit("two rows for one cell")))
        .alias(measure)
    )
    return counted.groupBy(index).pivot(columns, list(values)).agg(F.first(measure))
