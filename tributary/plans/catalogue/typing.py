"""Numbers, dates, bands and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions.dates import (
    completed_years,
    inferred_timestamps,
    mixed_timestamp,
    month_name_date,
    safe_timestamp,
    translate_months,
)
from tributary.functions.numbers import (
    additive_index,
    bounded_label,
    finite,
    integer_text,
    safe_integer,
    safe_number,
    strict_integer,
)
from tributary.functions.recode import band, lookup, points
from tributary.plans import vocabulary as v
from tributary.plans.catalogue.registry import case, listed, longs, plant, planted, query, table, text

JUNK = [None, "nan", "5d", "inf", " 7 ", "7.0", "", "-3", "1e3", ".5", "0x10", "+4."]


@query(
    "safe_numeric",
    f"""
    SELECT event_id,
           CASE WHEN regexp_full_match(trim(s), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
                THEN TRY_CAST(trim(s) AS DOUBLE) END AS number,
           TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(user_id AS VARCHAR) END AS BIGINT)
               AS lenient,
           CAST(CAST(user_id AS VARCHAR) AS BIGINT) AS strict,
           CASE WHEN user_id % 4 <> 0 THEN value END AS finite
    FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN CAST(value AS VARCHAR)
                         ELSE {planted("event_id", JUNK + ["8"])} END AS s FROM events)
    """,
)
def safe_numeric(spark, sf):
    event = F.col("event_id")
    raw = F.when(event % 2 == 0, F.col("value").cast("string")).otherwise(
        plant("event_id", JUNK + ["8"])
    )
    broken = F.when(F.col("user_id") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf, "events").select(
        "event_id",
        safe_number(raw).alias("number"),
        safe_integer(
            F.when(event % 3 == 0, F.lit("x")).otherwise(F.col("user_id").cast("string"))
        ).alias("lenient"),
        strict_integer(F.col("user_id").cast("string")).alias("strict"),
        finite(broken).alias("finite"),
    )


@query(
    "safe_date",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 1 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day
    FROM orders
    """,
)
def safe_date(spark, sf):
    printed = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = (
        F.when(F.col("o_orderkey") % 12 == 1, F.lit("junk"))
        .when(F.col("o_orderkey") % 12 == 7, F.date_format("o_orderdate", "dd.MM.yyyy"))
        .otherwise(printed)
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", F.to_date(safe_timestamp(raw, "yyyy-MM-dd")).alias("day")
    )


MIXED_SQL = """
SELECT o_orderkey, try_strptime(s, ['%Y-%m-%d', '%d/%m/%Y', '%d-%m-%Y', '%m/%d/%Y',
                                    '%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M'])::DATE AS day
FROM (SELECT o_orderkey, CASE o_orderkey % 8
        WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
        WHEN 2 THEN strftime(o_orderdate, '%-d/%-m/%Y')
        WHEN 3 THEN strftime(o_orderdate, '%d-%m-%Y')
        WHEN 4 THEN strftime(o_orderdate, '%m/%d/%Y')
        WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:11:12'
        WHEN 6 THEN strftime(o_orderdate, '%d/%m/%Y') || ' 13:45'
        ELSE 'sin fecha' END AS s
      FROM orders)
"""


@query("safe_date_mixed", MIXED_SQL)
def safe_date_mixed(spark, sf):
    def printed(fmt, tail=""):
        return F.concat(F.date_format("o_orderdate", fmt), F.lit(tail))

    shapes = [
        printed("yyyy-MM-dd"), printed("dd/MM/yyyy"), printed("d/M/yyyy"), printed("dd-MM-yyyy"),
        printed("MM/dd/yyyy"), printed("yyyy-MM-dd", " 10:11:12"), printed("dd/MM/yyyy", " 13:45"),
    ]
    raw = F.lit("sin fecha")
    for i, shape in enumerate(shapes):
        raw = F.when(F.col("o_orderkey") % 8 == i, shape).otherwise(raw)
    return table(spark, sf, "orders").select(
        "o_orderkey", F.to_date(mixed_timestamp(raw)).alias("day")
    )


SPANISH = ["ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic"]


@query(
    "month_abbrev",
    f"""
    SELECT o_orderkey, replace(replace(replace(replace(s, 'ene', 'jan'), 'ago', 'aug'),
                                       'dic', 'dec'), 'abr', 'apr') AS english,
           CAST(o_orderdate AS DATE) AS day
    FROM (SELECT *, strftime(o_orderdate, '%d-') || ([{listed(SPANISH)}])[month(o_orderdate)]
                    || strftime(o_orderdate, '-%Y') AS s FROM orders)
    """,
)
def month_abbrev(spark, sf):
    month = F.element_at(F.array(*map(F.lit, SPANISH)), F.month("o_orderdate"))
    raw = F.concat_ws(
        "-", F.date_format("o_orderdate", "dd"), month, F.date_format("o_orderdate", "yyyy")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        translate_months(raw, v.MONTHS).alias("english"),
        month_name_date(raw, v.MONTHS).alias("day"),
    )


@query(
    "date_parts",
    """
    SELECT o_orderkey, CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS d FROM orders)
    """,
)
def date_parts(spark, sf):
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year(day).cast("long").alias("year"), F.month(day).cast("long").alias("month")
    )


@query(
    "completed_years",
    """
    SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS start_day,
           CAST(l_shipdate AS DATE) AS end_day,
           CAST(year(l_shipdate) - year(o_orderdate)
                - CASE WHEN (month(l_shipdate), day(l_shipdate)) < (month(o_orderdate), day(o_orderdate))
                       THEN 1 ELSE 0 END AS BIGINT) AS years
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def completed_years_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("start_day"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("end_day")
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    years = completed_years(F.col("start_day"), F.col("end_day")).cast("long")
    return joined.withColumn("years", years)


@query(
    "band",
    f"""
    SELECT p_partkey, CASE WHEN age > -1 AND age <= 13 THEN 'Childhood' WHEN age > 13 AND age <= 26 THEN 'Youth'
                           WHEN age > 26 AND age <= 59 THEN 'Adulthood' WHEN age > 59 THEN 'Older adults'
                      END AS band
    FROM (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN NULL
                                 ELSE p_size * 2 - 5 END AS age FROM part)
    """,
)
def band_query(spark, sf):
    age = F.when(F.col("p_partkey") % 11 != 0, F.col("p_size") * 2 - 5)
    return table(spark, sf, "part").select(
        "p_partkey", band(age, v.AGE_EDGES, v.AGE_LABELS).alias("band")
    )


SEXES = ["Femenino", "Masculino", "ND", None]
GROUPS = [*v.ETHNIC_POINTS[0][0], *v.ETHNIC_POINTS[1][0], "Ninguno", None]
ACTS = [*v.FACT_POINTS[0][0], *v.FACT_POINTS[1][0], *v.FACT_POINTS[2][0], "Tortura", None]


def points_sql(column: str, groups) -> str:
    arms = " ".join(f"WHEN {column} IN ({listed(values)}) THEN {score}" for values, score in groups)
    return f"CASE {arms} ELSE 0 END"


SCORES_SQL = f"""
SELECT c_custkey, CAST({points_sql("s", v.SEX_POINTS)} AS BIGINT) AS p_sex,
       CAST({points_sql("g", v.ETHNIC_POINTS)} AS BIGINT) AS p_ethnicity,
       CAST({points_sql("f", v.FACT_POINTS)} AS BIGINT) AS p_fact,
       CAST({case("a", v.AGE_POINTS)} AS BIGINT) AS p_age
FROM (SELECT c_custkey, {planted("c_custkey", SEXES)} AS s, {planted("c_custkey", GROUPS)} AS g,
             {planted("c_custkey", ACTS)} AS f, {planted("c_nationkey", [*v.AGE_LABELS, None])} AS a
      FROM customer)
"""


def scores(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        points(plant("c_custkey", SEXES), v.SEX_POINTS).cast("long").alias("p_sex"),
        points(plant("c_custkey", GROUPS), v.ETHNIC_POINTS).cast("long").alias("p_ethnicity"),
        points(plant("c_custkey", ACTS), v.FACT_POINTS).cast("long").alias("p_fact"),
        lookup(plant("c_nationkey", [*v.AGE_LABELS, None]), v.AGE_POINTS).cast("long").alias("p_age"),
    )


@query("score_case", SCORES_SQL)
def score_case(spark, sf):
    return scores(spark, sf)


@query(
    "additive_index",
    f"SELECT c_custkey, p_age + p_sex + p_ethnicity + p_fact AS vulnerability_index FROM ({SCORES_SQL})",
)
def additive_index_query(spark, sf):
    parts = map(F.col, ["p_age", "p_sex", "p_ethnicity", "p_fact"])
    return scores(spark, sf).select("c_custkey", additive_index(*parts).alias("vulnerability_index"))


COMMUNES = ["7", "7.0", "7.9", "0", "23", " Rural ", "nan", None, "22", "22.5", "-1"]


@query(
    "numeric_label",
    f"""
    SELECT p_partkey,
           COALESCE(CAST(CAST(trunc(n) AS BIGINT) AS VARCHAR), trim(c)) AS commune_text,
           CASE WHEN trunc(n) BETWEEN 1 AND 22 THEN CAST(CAST(trunc(n) AS BIGINT) AS VARCHAR)
                ELSE {text(v.NOT_REGISTERED)} END AS commune
    FROM (SELECT p_partkey, c, CASE WHEN c <> 'nan' THEN TRY_CAST(c AS DOUBLE) END AS n
          FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size || '.0'
                                       ELSE {planted("p_partkey", COMMUNES)} END AS c FROM part))
    """,
)
def numeric_label(spark, sf):
    raw = F.when(
        F.col("p_partkey") % 2 == 0, F.concat(F.col("p_size").cast("string"), F.lit(".0"))
    ).otherwise(plant("p_partkey", COMMUNES))
    low, high = v.COMMUNES
    return table(spark, sf, "part").select(
        "p_partkey",
        integer_text(raw).alias("commune_text"),
        bounded_label(integer_text(raw), low, high, v.NOT_REGISTERED).alias("commune"),
    )


DAY_FORMATS = {"iso": "yyyy-MM-dd", "compact": "yyyyMMdd", "dashed": "MM-dd-yyyy", "slashed": "dd/MM/yyyy"}


@query(
    "inferred_date",
    f"""
    SELECT o_orderkey,
           {", ".join(f"CASE WHEN o_orderkey % 13 <> {i} THEN o_orderdate::DATE END AS {c}" for i, c in enumerate(DAY_FORMATS))},
           NULL::DATE AS junk
    FROM orders
    """,
)
def inferred_date(spark, sf):
    """Four columns of dates, each in a format of its own with some junk, and one that is only junk."""
    key = F.col("o_orderkey")
    texts = [
        F.when(key % 13 != i, F.date_format("o_orderdate", fmt)).otherwise(F.lit("sin fecha")).alias(c)
        for i, (c, fmt) in enumerate(DAY_FORMATS.items())
    ]
    rows = table(spark, sf, "orders").select("o_orderkey", *texts, F.lit("s/f").alias("junk"))
    found = inferred_timestamps(rows, [*DAY_FORMATS, "junk"])
    return rows.select("o_orderkey", *[c.cast("date").alias(name) for name, c in found.items()])
