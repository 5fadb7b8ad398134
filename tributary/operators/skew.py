"""Joins on natural keys of which some hold a large part of the rows.

A label such as "unknown" or a null key can hold half of a table. Its rows meet the
one dimension row they need by a broadcast of the frequent keys' rows, where they lie;
all other rows are shuffled by key. No session setting takes part in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.keys import attach_number

MOST_HOT = 10_000  # keys a broadcast may hold
TRACKED = 4  # items the sketch keeps for each key asked for


def key_hash(columns: Sequence[str]) -> Column:
    """One number per key; two keys with one number only share their way, never their rows."""
    return F.xxhash64(*[F.col(c) for c in columns])


def hot_bound(df: DataFrame) -> int:
    """How many keys can be hot at most: one is, with half a reducer's even share of the rows."""
    return min(MOST_HOT, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def frequent_hashes(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> list[int]:
    """Hashes of the keys that may hold more than one ``hot_bound``-th of the rows.

    One pass with a mergeable sketch of frequent items, which misses none; or, on rows
    that carry their number in ``weight``, exact sums. At most ``hot_bound`` numbers
    reach the driver.
    """
    most = hot_bound(df)
    hashes = df.select(key_hash(columns).alias("hash"), *([weight] if weight else []))
    if weight:
        counts = hashes.groupBy("hash").agg(F.sum(weight).alias("n"))
        total = hashes.agg(F.sum(weight)).scalar()
        found = counts.filter(F.col("n") * most > total).collect()
        return sorted(r["hash"] for r in found)
    sketch = F.expr(f"approx_top_k(hash, {most}, {max(1000, TRACKED * most)})")
    seen = hashes.agg(sketch.alias("top"), F.count("*").alias("rows")).first()
    return sorted(item for item, n in seen["top"] or () if n * most > seen["rows"])


def is_frequent(columns: Sequence[str], hashes: Sequence[int]) -> Column:
    quoted = ", ".join("`" + c.replace("`", "``") + "`" for c in columns)
    return F.expr(f"xxhash64({quoted}) IN ({', '.join(f'{h}L' if h > -(2**63) else '-9223372036854775807L - 1L' for h in hashes)})")


def attach_number_split(
    df: DataFrame,
    numbered: DataFrame,
    columns: Sequence[str],
    number: str,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """``attach_number`` for a dimension of any size, rows of hot keys apart.

    ``numbered`` holds a key once, so of the hot keys' rows at most ``hot_bound`` are
    broadcast. ``hot`` are the numbers ``frequent_hashes`` found; without them one
    pass over the rows looks for them.
    """
    hot = frequent_hashes(df, columns) if hot is None else hot
    if not hot:
        return attach_number(df, numbered, columns, number)
    frequent = is_frequent(columns, hot)
    few = F.broadcast(numbered.filter(frequent))
    return attach_number(df.filter(frequent), few, columns, number).unionByName(
        attach_number(df.filter(~frequent), numbered.filter(~frequent), columns, number)
    )
