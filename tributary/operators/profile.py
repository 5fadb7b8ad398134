"""Table profiles; each is one aggregate over all columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from tributary.functions.numbers import finite
from tributary.operators.keys import SMALL_ROWS
from tributary.operators.shape import text_columns
from tributary.session import shared_dir


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (column, value) per cell of the listed columns, values as text."""
    return df.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "column", "value")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls and null share in % of every column."""
    names = list(columns or df.columns)
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in names]
    wide = df.agg(F.count("*").alias("n_rows"), *nulls)
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in names])
    )
    rows = wide.select("n_rows", cells.alias("cell")).select("cell.column", "n_rows", "cell.n_null")
    share = F.round(F.try_divide(F.col("n_null") * 100.0, F.col("n_rows")), 4)
    return rows.withColumn("pct_null", share)


def label_share(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows, rows holding one label, and their share in %."""
    hits = F.count_if(F.col(column) == F.lit(value))
    return df.agg(
        F.count("*").alias("n_rows"),
        hits.alias("n_label"),
        F.round(F.try_divide(hits * 100.0, F.count("*")), 4).alias("pct_label"),
    )


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and surplus rows over some or all columns; nulls are equal.

    Text is grouped by its length and SHA-256 digest, so long texts are not shuffled.
    """
    names = list(columns or df.columns)
    texts = set(text_columns(df))
    keys: list[Column] = []
    for i, c in enumerate(names):
        if c in texts:
            keys.append(F.length(c).alias(f"l{i}"))
            keys.append(F.sha2(c, 256).alias(f"k{i}"))
        else:
            keys.append(F.col(c).alias(f"k{i}"))
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total, distinct = F.coalesce(F.sum("n"), F.lit(0)), F.count("*")
    return groups.agg(
        total.alias("n_rows"), distinct.alias("n_distinct"), (total - distinct).alias("n_duplicates")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


HEAD = 32  # characters of a value that are shuffled


def digest_counts(cells: DataFrame) -> DataFrame:
    """Rows (column, digest, n, size, head) of the distinct cells; no whole value is shuffled."""
    digest = F.unhex(F.sha2("value", 256)).alias("digest")
    return (
        cells.select("column", digest, F.length("value").alias("size"), F.left("value", F.lit(HEAD)).alias("head"))
        .groupBy("column", "digest", "size", "head")
        .agg(F.count("*").alias("n"))
    )


def column_describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per column.

    Cells are counted per (column, digest), so a value is shuffled by its digest and
    its first characters only. The most frequent value is the head itself if that is
    all of it; only longer winners are fetched, by a semi-join with their digests.
    Ties go to the smallest value.
    """
    cells = long_form(df, list(columns or text_columns(df)))
    shared_dir(df.sparkSession)
    counted = digest_counts(cells).checkpoint()
    best = F.min(F.when(F.col("digest").isNotNull(), F.struct((-F.col("n")).alias("neg"), "head")))
    found = counted.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("digest").isNotNull(), F.col("n"))), F.lit(0)).alias("n_values"),
        F.count("digest").alias("n_unique"),
        best.alias("best"),
    )
    ends = F.broadcast(found.select("column", "best.*"))  # one row per column
    winners = counted.join(ends, ["column", "head"]).filter(-F.col("n") == F.col("neg"))
    seen = winners.agg(F.count_if(F.col("size") > HEAD).alias("long"), F.count("*").alias("n")).first()
    tops = winners.select("column", F.col("head").alias("top"))
    if seen["long"]:
        named = winners.select("column", "digest")
        named = F.broadcast(named) if seen["n"] <= SMALL_ROWS else named
        tops = cells.withColumn("digest", F.unhex(F.sha2("value", 256))).join(named, ["column", "digest"], "left_semi").select(
            "column", F.col("value").alias("top")
        )
    top = tops.groupBy("column").agg(F.min("top").alias("top"))
    freq = (-F.col("best.neg")).alias("freq")
    return found.join(F.broadcast(top), "column", "left").select("column", "n_values", "n_unique", "top", freq)


def _summary(df: DataFrame, names: Sequence[str], value, of) -> DataFrame:
    """One row per column from one aggregate: ``of`` gives the named statistics of a value."""
    stats = [F.struct(F.lit(c).alias("column"), *of(value(F.col(c)))) for c in names]
    return df.agg(F.array(*stats).alias("cells")).select(F.inline("cells"))


def _quantiles(value: Column, accuracy: int) -> list[Column]:
    found = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
    return [F.get(found, F.lit(i)).alias(name) for i, name in enumerate(("q25", "q50", "q75"))]


def number_describe(
    df: DataFrame, columns: Sequence[str] | None = None, accuracy: int = 10_000
) -> DataFrame:
    """Values, mean, standard deviation, extremes and quartiles of number columns, by one aggregate.

    NaN and infinities count as missing. A quartile is a value of the column whose rank
    is off by at most a part ``1 / accuracy`` of the rows.
    """
    numbers = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]

    def of(x: Column) -> list[Column]:
        return [
            F.count(x).alias("n_values"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("low"), *_quantiles(x, accuracy), F.max(x).alias("high"),
        ]

    return _summary(df, list(columns or numbers), lambda c: finite(c.cast("double")), of)


def date_describe(
    df: DataFrame, columns: Sequence[str] | None = None, accuracy: int = 10_000
) -> DataFrame:
    """Values, extremes and quartiles of date and timestamp columns, as dates, by one aggregate."""
    dates = [f.name for f in df.schema if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))]

    def of(x: Column) -> list[Column]:
        ends = [F.min(x).alias("low"), *_quantiles(x, accuracy), F.max(x).alias("high")]
        return [F.count(x).alias("n_values"), *ends]

    return _summary(df, list(columns or dates), lambda c: c.cast("date"), of)


def watch(df: DataFrame, step: str, *extra: Column) -> tuple[DataFrame, Observation]:
    """Count the rows that pass a step, as a by-product of the job that runs it."""
    observation = Observation(step)
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows"), *extra), observation


def watched_rows(df: DataFrame, observations: Sequence[tuple[str, Observation]]) -> DataFrame:
    """Step counts as rows, once an action has run: (step, n_rows)."""
    rows = [(step, o.get["n_rows"]) for step, o in observations]
    return df.sparkSession.createDataFrame(rows, "step string, n_rows long")
