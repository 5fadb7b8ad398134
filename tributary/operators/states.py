"""Column profiles that can be merged: kept per run, and rules taken from their history.

A state is one row per column with counts, extremes, a sketch of the distinct values
and one of the quantiles. States of several runs merge without their rows: counts and
extremes exactly, distinct counts within ``DISTINCT_ERROR`` (two standard errors of the
sketch), quantiles within ``RANK_ERROR`` of their rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tributary.functions.numbers import finite
from tributary.operators.quality import RULES

LOG_SLOTS = 12  # of the distinct sketch: a standard error of 1.04 / sqrt(2 ** 12)
DISTINCT_ERROR = 2 * 1.04 / 2 ** (LOG_SLOTS / 2)
QUANTILE_ITEMS = 800  # of the quantile sketch
RANK_ERROR = 0.005
FRACTIONS = (0.05, 0.5, 0.95)
EXACT = "decimal(38,10)"  # holds every long, and decimals of up to 10 digits behind the point
MOMENT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _state(df: DataFrame, name: str) -> Column:
    """The state of one column: aggregates, all of the same types whatever the column's is."""
    kind, x = df.schema[name].dataType, F.col(name)
    floating = isinstance(kind, (FloatType, DoubleType))
    number = isinstance(kind, (IntegralType, DecimalType)) or floating
    value = finite(x.cast("double")) if floating else x
    missing = x.isNull() | F.isnan(x) if floating else x.isNull()
    cells = {
        "low_exact": F.min(x) if number and not floating else None,
        "high_exact": F.max(x) if number and not floating else None,
        "low_double": F.min(value) if floating else None,
        "high_double": F.max(value) if floating else None,
        "low_text": None,
        "high_text": None,
        "shortest": F.min(F.length(x)) if isinstance(kind, StringType) else None,
        "longest": F.max(F.length(x)) if isinstance(kind, StringType) else None,
    }
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        fmt = "yyyy-MM-dd" if isinstance(kind, DateType) else MOMENT
        cells |= {"low_text": F.date_format(F.min(x), fmt), "high_text": F.date_format(F.max(x), fmt)}
    kinds = {"exact": EXACT, "double": "double", "text": "string", "shortest": "int", "longest": "int"}
    extremes = [
        (F.lit(None) if c is None else c).cast(kinds[n.split("_")[-1]]).alias(n) for n, c in cells.items()
    ]
    ranked = F.kll_sketch_agg_double(value.cast("double"), F.lit(QUANTILE_ITEMS)) if number else F.lit(None)
    return F.struct(
        F.lit(name).alias("column"),
        F.lit(kind.simpleString()).alias("type"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(missing).alias("nulls"),
        *extremes,
        F.hll_sketch_agg(F.when(~missing, x.cast("string")), F.lit(LOG_SLOTS)).alias("distinct"),
        F.when(F.count(value) > 0, ranked).cast("binary").alias("ranked"),
    )


def column_states(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column, by one aggregate over the table; booleans and nested columns are left out."""
    known = (StringType, IntegralType, DecimalType, FloatType, DoubleType, DateType, TimestampType, TimestampNTZType)
    names = columns or [
        f.name for f in df.schema if isinstance(f.dataType, known) and not isinstance(f.dataType, BooleanType)
    ]
    return df.agg(F.array(*[_state(df, c) for c in names]).alias("states")).select(F.inline("states"))


def merge_states(states: DataFrame) -> DataFrame:
    """States of several runs as one per column; a column that has had several types has one for each."""
    lows = [F.min(c).alias(c) for c in ("low_exact", "low_double", "low_text", "shortest")]
    highs = [F.max(c).alias(c) for c in ("high_exact", "high_double", "high_text", "longest")]
    merged = states.groupBy("column", "type").agg(
        *[F.sum(c).alias(c) for c in ("rows", "nulls")],
        *lows,
        *highs,
        F.hll_union_agg("distinct").alias("distinct"),
        F.when(F.count("ranked") > 0, F.kll_merge_agg_double("ranked")).alias("ranked"),
    )
    return merged.select(*[c for c in states.columns if c in merged.columns])


def distinct_count(state: Column | str = "distinct") -> Column:
    return F.hll_sketch_estimate(state)


def quantile(fraction: float, state: Column | str = "ranked") -> Column:
    """The value of about this rank, null for a state without numbers."""
    held = F.col(state) if isinstance(state, str) else state
    rank = F.lit(min(1.0, max(0.0, fraction)))
    return F.when(held.isNotNull(), F.kll_sketch_get_quantile_double(held, rank))


def _extreme(end: str) -> Column:
    """An extreme as text in the column's own type."""
    exact = F.col(f"{end}_exact")
    whole = F.col("type").isin("tinyint", "smallint", "int", "bigint")
    return F.coalesce(
        F.when(whole, exact.cast("decimal(38,0)").cast("string")).otherwise(exact.cast("string")),
        F.col(f"{end}_double").cast("string"),
        F.col(f"{end}_text"),
    )


def rules_from_states(
    states: DataFrame, tolerance: float = 0.0, fractions: Sequence[float] = FRACTIONS
) -> DataFrame:
    """Rules that the runs of a history obey, one state per run and column.

    Null shares (of all runs together, plus ``tolerance``), ranges, lengths and types
    come from the merged states. Distinct counts and quantiles vary from batch to batch,
    so their bounds are the least and the largest of the runs, widened by the sketches'
    errors and by ``tolerance``. Columns that have had several types get no rules.
    """
    runs = states.join(
        states.groupBy("column").agg(F.count_distinct("type").alias("types")).filter("types = 1").drop("types"),
        "column",
    )
    merged = merge_states(runs)
    none = F.lit(None).cast("string")

    def rule(df: DataFrame, kind: str, low: Column, high: Column, member: Column = none, name: Column | None = None):
        label = F.concat(F.col("column"), F.lit(f": {kind}"), name if name is not None else F.lit(""))
        return df.select(
            label.alias("rule"), "column", F.lit(kind).alias("kind"), low.cast("string").alias("low"),
            high.cast("string").alias("high"), member.alias("member"),
        )

    share = F.least(F.lit(1.0), F.coalesce(F.try_divide("nulls", "rows"), F.lit(0.0)) + tolerance)
    spread = DISTINCT_ERROR + tolerance
    count = distinct_count()
    counted = runs.groupBy("column").agg(F.min(count).alias("least"), F.max(count).alias("most"))
    parts = [
        rule(merged, "type", none, none, F.col("type")),
        rule(merged, "null_share", F.lit("0.0"), share),
        rule(merged, "range", _extreme("low"), _extreme("high")).filter("low IS NOT NULL"),
        rule(merged.filter("shortest IS NOT NULL"), "length", F.col("shortest"), F.col("longest")),
        rule(counted, "distinct_count", F.floor(F.col("least") * (1 - spread)), F.ceil(F.col("most") * (1 + spread))),
    ]
    ranked = runs.filter("ranked IS NOT NULL")
    for fraction in fractions:
        low, high = quantile(fraction - RANK_ERROR - tolerance), quantile(fraction + RANK_ERROR + tolerance)
        ends = ranked.groupBy("column").agg(F.min(low).alias("least"), F.max(high).alias("most"))
        member = F.lit(str(fraction))
        parts.append(rule(ends, "quantile", F.col("least"), F.col("most"), member, F.lit(f" {fraction}")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.to(states.sparkSession.createDataFrame([], RULES).schema)
