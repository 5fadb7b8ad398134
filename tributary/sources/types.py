"""Types of text columns, found in one pass.

Every value belongs to one class; the classes a column holds decide its type by a
lattice: null is below everything, integer < decimal < double, date < timestamp, and
whatever has no common type above it but text is text. Blanks around a value are no
matter, as in a cast. One aggregate covers all columns, one projection casts them; a
value that no longer fits by then fails the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.shape import text_columns
from tributary.sources.files import read_csv

INTEGER, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(7))
NUMBERS, MOMENTS = INTEGER | DECIMAL | DOUBLE, DATE | TIMESTAMP

LONG_DIGITS, MOST_DIGITS = 18, 38
_WHOLE = r"^[+-]?\d+$"
_POINT = r"^[+-]?\d*\.\d+$"
_FLOAT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DAY = r"^\d{4}-\d{2}-\d{2}$"
_MOMENT = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$"
_CODE = r"^[+-]?0\d"


def _digits(value: Column) -> tuple[Column, Column]:
    """Digits before the point, leading zeros left out, and behind it."""
    whole = F.regexp_replace(F.substring_index(value, ".", 1), r"^[+-]?0*", "")
    behind = F.when(F.contains(value, F.lit(".")), F.length(F.substring_index(value, ".", -1)))
    return F.length(whole), F.coalesce(behind, F.lit(0))


def value_class(value: Column, codes_as_text: bool = False) -> Column:
    """The class of a trimmed text, null for null."""
    before, behind = _digits(value)
    number = (
        F.when(value.rlike(_WHOLE) & (before <= LONG_DIGITS), INTEGER)
        .when(value.rlike(f"{_WHOLE}|{_POINT}") & (before + behind <= MOST_DIGITS), DECIMAL)
        .otherwise(DOUBLE)
    )
    if codes_as_text:
        number = F.when(value.rlike(_CODE), TEXT).otherwise(number)
    return (
        F.when(value.rlike(_FLOAT), number)
        .when(value.rlike(_DAY) & F.try_to_date(value, "yyyy-MM-dd").isNotNull(), DATE)
        .when(value.rlike(_MOMENT) & value.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(value).isin("true", "false"), BOOLEAN)
        .when(value.isNotNull(), TEXT)
    )


def common_type(classes: int, before: int, behind: int) -> str:
    """The least type that holds all classes; decimals are as wide as their digits need."""
    if classes == INTEGER:
        return "bigint"
    if classes in (DECIMAL, INTEGER | DECIMAL) and before + behind <= MOST_DIGITS:
        return f"decimal({max(1, before + behind)},{behind})"
    if classes and not classes & ~NUMBERS:
        return "double"
    if classes == DATE:
        return "date"
    if classes and not classes & ~MOMENTS:
        return "timestamp"
    return "boolean" if classes == BOOLEAN else "string"


def infer_types(
    df: DataFrame, columns: Sequence[str] | None = None, codes_as_text: bool = False
) -> dict[str, str]:
    """The type of every text column by one aggregate, which yields one row.

    A column without values stays text. With ``codes_as_text`` numbers with leading
    zeros are codes, and their columns stay text.
    """
    names = list(columns or text_columns(df))
    stats = []
    for i, c in enumerate(names):
        value = F.trim(F.col(c))
        found = value_class(value, codes_as_text)
        plain = value.rlike(f"{_WHOLE}|{_POINT}")
        before, behind = _digits(value)
        stats += [
            F.coalesce(F.bit_or(found), F.lit(0)).alias(f"c{i}"),
            F.coalesce(F.max(F.when(plain, before)), F.lit(0)).alias(f"b{i}"),
            F.coalesce(F.max(F.when(plain, behind)), F.lit(0)).alias(f"s{i}"),
        ]
    row = df.agg(*stats).first() if names else ()
    return {c: common_type(*row[3 * i : 3 * i + 3]) for i, c in enumerate(names)}


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns in their types; a value that does not fit fails the job."""
    casts = {c: F.trim(F.col(c)).cast(t) for c, t in types.items() if t != "string"}
    return df.withColumns(casts) if casts else df


def with_types(df: DataFrame, columns: Sequence[str] | None = None, codes_as_text: bool = False) -> DataFrame:
    """A table of texts with every column in the type its values have."""
    return cast_columns(df, infer_types(df, columns, codes_as_text))


def read_typed_csv(spark: SparkSession, path: str, codes_as_text: bool = False, **options) -> DataFrame:
    """Files with a header row, types inferred over all rows; options are those of ``read_csv``."""
    return with_types(read_csv(spark, path, **options), codes_as_text=codes_as_text)
