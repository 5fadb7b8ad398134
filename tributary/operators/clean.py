"""Row filters, text clean-up of whole tables, code and name reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.recode import lookup, only_listed
from tributary.functions.text import canonical_unknown, fold, needs_fold, zero_pad
from tributary.operators.shape import map_columns, present, text_columns


def drop_all_null(df: DataFrame) -> DataFrame:
    """Rows with at least one value."""
    return df.na.drop("all")


def keep_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Closed range, either end optional; nulls fall out."""
    value = F.col(column)
    if low is not None:
        df = df.filter(value >= F.lit(low))
    if high is not None:
        df = df.filter(value <= F.lit(high))
    return df


def keep_ordered(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows where one column does not exceed another."""
    return df.filter(F.col(earlier) <= F.col(later))


def share_of(condition: Column, digits: int = 4) -> Column:
    """Share of rows, in percent, that meet a condition."""
    return F.round(F.try_divide(F.count_if(condition) * 100.0, F.count("*")), digits)


def condition_report(df: DataFrame, condition: Column, column: str) -> DataFrame:
    """Rows, hits, nulls, share of hits in % and extremes of a column, in one pass."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(condition).alias("n_hits"),
        F.count_if(F.col(column).isNull()).alias("n_null"),
        share_of(condition).alias("pct_hits"),
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
    )


def split_rows(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet a condition and the others, null outcomes among the others."""
    met = F.coalesce(condition, F.lit(False))
    return df.filter(met), df.filter(~met)


def fold_text(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    only_if_needed: bool = False,
) -> DataFrame:
    """Fold text columns.

    ``only_if_needed`` folds a column only if any of its values is null or has a
    capital letter. All columns are decided by one aggregate, evaluated as a
    subquery of the same query.
    """
    chosen = text_columns(df) if columns is None else present(df, columns)
    if not chosen:
        return df
    # One lambda for all columns: the tables of a fold are in the plan once.
    holder = "__folded"
    folded = {c: F.get(holder, F.lit(i)) for i, c in enumerate(chosen)}
    if only_if_needed:
        flags = df.agg(
            F.struct(*[F.bool_or(needs_fold(F.col(c))).alias(c) for c in chosen]).alias("flags")
        ).scalar()
        folded = {c: F.when(flags.getField(c), new).otherwise(F.col(c)) for c, new in folded.items()}
    return df.withColumn(holder, F.transform(F.array(*chosen), fold)).withColumns(folded).drop(holder)


def unify_unknown(
    df: DataFrame, variants: Sequence[str], label: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One label for nulls and spellings of "unknown", by default in all text columns."""
    return map_columns(df, columns, lambda c: canonical_unknown(c, variants, label))


def reconcile_code_name(
    df: DataFrame,
    code: str,
    name: str,
    catalogue: Mapping[str, str],
    unknown: str,
    no_code: Sequence[str] = (),
    no_name: Sequence[str] = (),
    width: int = 2,
) -> DataFrame:
    """Make a code and a name agree with a catalogue ``{code: name}``.

    Codes are padded, blanks and the listed texts count as missing, a missing
    side is looked up from the other, and what the catalogue lacks becomes
    ``unknown``. Either column may be absent from the table.
    """
    if code in df.columns:
        padded = zero_pad(F.col(code), width)
        df = df.withColumn(code, canonical_unknown(padded, no_code, unknown))
    if name in df.columns:
        df = df.withColumn(name, canonical_unknown(F.col(name), no_name, unknown))
    if code in df.columns and name in df.columns:
        codes = {v: k for k, v in catalogue.items()}
        no = F.lit(unknown)
        found = F.when(
            (F.col(code) == no) & (F.col(name) != no), lookup(F.col(name), codes)
        ).otherwise(F.col(code))
        df = df.withColumn(code, F.coalesce(found, no))
        df = df.withColumn(
            name,
            F.when(
                (F.col(name) == no) & (F.col(code) != no), lookup(F.col(code), catalogue)
            ).otherwise(F.col(name)),
        )
    if code in df.columns:
        df = df.withColumn(code, only_listed(F.col(code), list(catalogue), unknown))
    if name in df.columns:
        df = df.withColumn(name, only_listed(F.col(name), list(catalogue.values()), unknown))
    return df
