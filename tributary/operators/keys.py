"""Consecutive numbers over distinct rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.session import shared_dir

# Up to these measured sizes a join may broadcast a table.
SMALL_ROWS = 100_000
SMALL_BYTES = 16 * 2**20
PARTITION_BITS = 33  # of a monotonically increasing id: the row's place in its partition


@dataclass(frozen=True)
class Numbered:
    """A table with a number column, its counted rows and whether it is small."""

    table: DataFrame
    rows: int
    is_small: bool

    def for_join(self) -> DataFrame:
        """The table, broadcast if its measured size allows; else Spark decides."""
        return F.broadcast(self.table) if self.is_small else self.table


def number_distinct(
    df: DataFrame,
    columns: Sequence[str],
    number: str,
    start: int | Column = 1,
) -> Numbered:
    """Distinct rows of some columns, numbered without gaps in sorted order, nulls first.

    The distinct rows are range-partitioned and sorted inside their partitions; a
    row's number is its place there plus the rows of the partitions before. They
    are checkpointed once with their places, so the input is read once and a lost
    executor cannot change the numbers. ``start`` may be a scalar subquery.
    """
    shared_dir(df.sparkSession)
    placed = (
        df.select(*columns)
        .distinct()
        .repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("__place", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("__place", PARTITION_BITS)
    text = F.concat_ws("", *[F.col(c).cast("string") for c in columns])
    # One row per partition: bounded by the partition count, not by the data.
    parts = placed.groupBy(part.alias("part")).agg(
        F.count("*").alias("rows"), F.sum(F.octet_length(text)).alias("bytes")
    )
    found = {r["part"]: (r["rows"], r["bytes"] or 0) for r in parts.collect()}
    offsets, rows = [], 0
    for one in range(max(found, default=0) + 1):
        offsets.append(rows)
        rows += found.get(one, (0, 0))[0]
    size = sum(b for _, b in found.values())
    offset = F.element_at(F.lit(offsets), (part + 1).cast("int"))
    inside = F.col("__place") - F.shiftleft(part, PARTITION_BITS)
    table = placed.withColumn(number, offset.cast("long") + inside + start)
    is_small = rows <= SMALL_ROWS and size <= SMALL_BYTES
    return Numbered(table.select(number, *columns), rows, is_small)


def null_safe_match(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of several columns in which null equals null."""
    match = left[columns[0]].eqNullSafe(right[columns[0]])
    for c in columns[1:]:
        match = match & left[c].eqNullSafe(right[c])
    return match


def attach_number(
    df: DataFrame, numbered: DataFrame, columns: Sequence[str], number: str
) -> DataFrame:
    """Left join of a number on a natural key; null keys match null keys."""
    names = {c: f"__key_{c}" for c in columns}
    side = numbered.select(number, *columns).withColumnsRenamed(names)
    condition = F.lit(True)
    for c, renamed in names.items():
        condition = condition & F.col(c).eqNullSafe(F.col(renamed))
    return df.join(side, condition, "left").drop(*names.values())
