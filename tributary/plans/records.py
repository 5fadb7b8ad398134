"""Exploratory half: raw person records to scored, encoded records and their star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tributary.functions.dates import completed_years, month_name_date
from tributary.functions.numbers import additive_index, bounded_label, strict_integer
from tributary.functions.recode import band, lookup, points, recode
from tributary.operators import clean, encode, shape
from tributary.operators.star import ROWS, Dimension, build_dimensions, build_fact, dimension_rows
from tributary.plans import vocabulary as v
from tributary.session import scratch_path

POINTS = ["p_age", "p_sex", "p_ethnicity", "p_fact"]

RECORD_DIMS = (
    Dimension("person", "id_person", ("sex", "ethnic_group", "classification")),
    Dimension("victimizing_act", "id_act", ("victimization_fact",)),
    Dimension("location", "id_location", ("commune",)),
    Dimension("registration_date", "id_date", ("date_processing",)),
)


def typed_records(raw: DataFrame, date_format: str = "d-MMM-yyyy") -> DataFrame:
    """Text records typed and recoded; a bad integer or date fails the job."""
    df = clean.drop_all_null(raw)
    df = df.na.fill(v.NOT_REGISTERED, ["victimization_fact", "commune"])
    df = shape.map_columns(df, v.RAW_INTEGERS, strict_integer)
    df = shape.map_columns(df, v.RAW_DATES, lambda c: month_name_date(c, v.MONTHS, date_format))
    for column, mapping in v.RAW_RECODES.items():
        df = shape.map_columns(df, [column], lambda c, m=mapping: recode(c, m))
    return shape.map_columns(
        df, ["commune"], lambda c: bounded_label(c, *v.COMMUNES, v.NOT_REGISTERED)
    )


def valid_records(df: DataFrame, metrics: Observation | None = None) -> DataFrame:
    """Records with plausible dates; impossible ages are computed from the dates.

    The faults are counted by the job that filters; ``metrics`` receives them.
    Filters are not pushed below an observation, so each date is parsed once, not
    once per condition.
    """
    born, processed = F.col("date_of_birth"), F.col(v.DATE)
    df = df.observe(
        metrics or Observation("record faults"),
        F.count("*").alias("n_rows"),
        F.count_if(~born.between(*map(F.lit, v.BIRTH_DATES))).alias("n_birth_invalid"),
        F.count_if(born.isNull()).alias("n_birth_null"),
        F.count_if(born > processed).alias("n_birth_later"),
        F.count_if(processed < F.lit(v.FIRST_PROCESSING)).alias("n_too_early"),
        F.count_if(processed > F.lit(v.LAST_PROCESSING)).alias("n_too_late"),
    )
    df = clean.keep_range(df, "date_of_birth", *v.BIRTH_DATES)
    age = F.col("years_in_the_visitia")
    years = completed_years(born, processed).cast("long")
    low, high = v.AGES
    impossible = (age < low) | (age > high)
    df = df.withColumn(
        "years_in_the_visitia", F.when(impossible, F.coalesce(years, age)).otherwise(age)
    )
    df = clean.keep_ordered(df, "date_of_birth", v.DATE)
    return clean.keep_range(df, v.DATE, low=v.FIRST_PROCESSING)


def scored_records(df: DataFrame) -> DataFrame:
    """Life-cycle band, points and vulnerability index."""
    df = df.withColumn(
        "classification", band(F.col("years_in_the_visitia"), v.AGE_EDGES, v.AGE_LABELS)
    )
    df = df.withColumns(
        {
            "p_age": lookup(F.col("classification"), v.AGE_POINTS),
            "p_sex": points(F.col("sex"), v.SEX_POINTS),
            "p_ethnicity": points(F.col("ethnic_group"), v.ETHNIC_POINTS),
            "p_fact": points(F.col("victimization_fact"), v.FACT_POINTS),
        }
    )
    return df.withColumn("vulnerability_index", additive_index(*map(F.col, POINTS)))


def encoded_records(df: DataFrame, max_sexes: int = 1000) -> DataFrame:
    """Ethnic group as a code, every sex as a 0/1 column.

    The records are stored once, for the codes, the values and the rows.
    """
    path = scratch_path(df.sparkSession, "records")
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    df = encode.label_encode(df, "ethnic_group", "ethnic_group_encoded")
    return encode.one_hot(df, "sex", "sex", max_columns=max_sexes)


def record_star(df: DataFrame) -> dict[str, DataFrame]:
    """Dimensions and fact of scored records; the fact repeats the table's row count."""
    combinations = dimension_rows(df, RECORD_DIMS)
    built = build_dimensions(combinations, RECORD_DIMS)
    tables = {dim.name: numbered.table for dim, numbered in built}
    tables["registration_date"] = tables["registration_date"].withColumn("year", F.year(v.DATE))
    fact, _ = build_fact(
        df, [(dim, numbered.for_join()) for dim, numbered in built], v.DATE, ["vulnerability_index"]
    )
    keys = [dim.id for dim in RECORD_DIMS]
    fact = fact.select(*keys, "vulnerability_index")
    total = combinations.agg(F.sum(ROWS)).scalar()
    return {**tables, "victims": shape.with_total_rows(fact, v.MEASURE, total)}


