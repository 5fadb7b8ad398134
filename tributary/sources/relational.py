"""Tables of a relational source over JDBC, and catalog tables.

Credentials come from the caller's options; none is kept here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def scan_options(
    table: str,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    fetch_size: int = 10_000,
    small: bool = False,
) -> dict[str, str]:
    """Options of one table scan, split on a numeric key between bounds.

    Without a split the whole table runs through one connection and one task;
    that has to be asked for, by ``small``.
    """
    if not (key and bounds) and not small:
        raise ValueError(f"'{table}' needs a key and bounds to split on, or small=True")
    options = {"dbtable": table, "fetchsize": str(fetch_size)}
    if key and bounds:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def key_bounds(
    spark: SparkSession, connection: Mapping[str, str], table: str, key: str
) -> tuple[int, int]:
    """Least and greatest key of a table, found by the source; (0, 0) if it is empty."""
    query = f"SELECT min({key}) AS low, max({key}) AS high FROM {table}"
    row = spark.read.format("jdbc").options(**connection).option("query", query).load().first()
    return (row["low"] or 0, row["high"] or 0)


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    columns: Sequence[str] | None = None,
    **split,
) -> DataFrame:
    """One table, or some of its columns; the projection is pushed to the source."""
    scan = spark.read.format("jdbc").options(**connection).options(**scan_options(table, **split))
    rows = scan.load()
    return rows.select(*columns) if columns else rows


def read_star(
    spark: SparkSession,
    connection: Mapping[str, str],
    tables: Mapping[str, Mapping],
) -> dict[str, DataFrame]:
    """Several tables by name, each with its own split options."""
    return {name: read_table(spark, connection, name, **split) for name, split in tables.items()}


def append_table(
    df: DataFrame, connection: Mapping[str, str], table: str, batch: int = 10_000
) -> None:
    """Distributed append in batches, one connection per partition."""
    df.write.format("jdbc").options(**connection).options(
        dbtable=table, batchsize=str(batch)
    ).mode("append").save()


def replace_table(df: DataFrame, connection: Mapping[str, str], table: str) -> None:
    """Table emptied (its definition kept) and written anew."""
    df.write.format("jdbc").options(**connection).options(
        dbtable=table, truncate="true"
    ).mode("overwrite").save()
