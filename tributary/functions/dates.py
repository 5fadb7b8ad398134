"""Date expressions on raw text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CLOCK = "[ H:m[:s[-SSSSSSSSS]]]"
_CLOCK_TEXT = r"( \d{1,2}:\d{1,2}(:\d{1,2}(-\d{1,9})?)?)?$"
_MONTH = r"(0?[1-9]|1[0-2])"
_DAY = r"\d{1,2}"

# Shape of the text (after separators are unified) and the format that reads it,
# in order of preference: year first, day first, month first.
_LADDER = (
    (rf"^\d{{4}}-{_MONTH}-{_DAY}{_CLOCK_TEXT}", f"yyyy-M-d{_CLOCK}"),
    (rf"^\d{{4}}-{_DAY}-{_MONTH}{_CLOCK_TEXT}", f"yyyy-d-M{_CLOCK}"),
    (rf"^{_DAY}-{_MONTH}-\d{{4}}{_CLOCK_TEXT}", f"d-M-yyyy{_CLOCK}"),
    (rf"^{_MONTH}-{_DAY}-\d{{4}}{_CLOCK_TEXT}", f"M-d-yyyy{_CLOCK}"),
)


def safe_timestamp(col: Column, fmt: str) -> Column:
    """Timestamp by one format, null on junk."""
    return F.try_to_timestamp(col.cast("string"), F.lit(fmt))


def mixed_timestamp(col: Column) -> Column:
    """Timestamp from rows in different formats, day first where both fit.

    Accepts "/", "-" and "." between the parts and an optional time. The shape
    of the text picks the one format to try, so junk costs no failed parse.
    """
    text = F.translate(F.trim(col.cast("string")), "/.Tt", "--  ")
    parsed = F.lit(None).cast("timestamp")
    for shape, fmt in reversed(_LADDER):
        parsed = F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(fmt))).otherwise(parsed)
    return parsed


# Formats a column may be in, in order of preference: where several read equally many
# values, the first of them is taken.
FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "dd/MM/yyyy", "dd-MM-yyyy", "MM/dd/yyyy", "MM-dd-yyyy")


def inferred_timestamps(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] = FORMATS
) -> dict[str, Column]:
    """For every column its values read by the one format that reads most of them.

    One aggregate over all columns counts what each format reads; its outcome enters
    the plan as a scalar subquery, so nothing is collected and no value is tried with
    a format that lost. Values the winner cannot read are null; so is a column no
    format reads.
    """
    counts = [
        F.count(safe_timestamp(F.col(c), fmt)).alias(f"n{i}_{j}")
        for i, c in enumerate(columns)
        for j, fmt in enumerate(formats)
    ]
    winners = []
    for i, c in enumerate(columns):
        ranked = [F.struct(F.col(f"n{i}_{j}").alias("n"), F.lit(-j).alias("place")) for j in range(len(formats))]
        best = F.array_max(F.array(*ranked))
        winners.append(F.when(best["n"] > 0, -best["place"]).alias(f"w{i}"))
    won = df.agg(*counts).select(F.struct(*winners)).scalar()
    out = {}
    for i, c in enumerate(columns):
        parsed = F.lit(None).cast("timestamp")
        for j, fmt in reversed(list(enumerate(formats))):
            parsed = F.when(won[f"w{i}"] == j, safe_timestamp(F.col(c), fmt)).otherwise(parsed)
        out[c] = parsed
    return out


def translate_months(col: Column, months: Mapping[str, str]) -> Column:
    """Month abbreviations of another language in English."""
    text = F.lower(col)
    for foreign, english in months.items():
        text = F.replace(text, F.lit(foreign), F.lit(english))
    return text


def month_name_date(col: Column, months: Mapping[str, str], fmt: str = "d-MMM-yyyy") -> Column:
    """Date from text with a month abbreviation; junk fails the job."""
    return F.to_date(translate_months(col, months), fmt)


def completed_years(start: Column, end: Column) -> Column:
    """Birthdays passed between two dates, by the calendar."""
    before_birthday = F.struct(F.month(end), F.dayofmonth(end)) < F.struct(
        F.month(start), F.dayofmonth(start)
    )
    return F.year(end) - F.year(start) - before_birthday.cast("int")
