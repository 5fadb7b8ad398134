"""Registration and the inputs queries share.

The test tables hold no nulls, junk or spelling variants. ``plant`` gives every
row one of a list of texts, chosen by the row's key, and ``planted`` is the same
choice in SQL; no row is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.recode import literal

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plant(key: str, values: Sequence[str | None]) -> Column:
    cells = ", ".join(map(literal, values))
    return F.expr(f"element_at(array({cells}), int({key} % {len(values)} + 1))")


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def planted(key: str, values: Sequence[str | None]) -> str:
    return f"([{', '.join(map(text, values))}])[1 + {key} % {len(values)}]"


def listed(values: Sequence[str]) -> str:
    return ", ".join(map(text, values))


def case(expr: str, mapping: Mapping, otherwise: str = "NULL") -> str:
    """CASE over a dictionary; ``otherwise`` is an SQL expression."""
    arms = " ".join(
        f"WHEN {text(k) if isinstance(k, str) else k} THEN {text(v) if isinstance(v, str) else v}"
        for k, v in mapping.items()
    )
    return f"CASE {expr} {arms} ELSE {otherwise} END"


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})
