import datetime as dt
import math

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions import dates, numbers, recode
from tributary.plans import vocabulary as v


def test_numbers_match_pandas_coercion(values):
    raw = [None, "7", " 7 ", "7.0", "nan", "5d", "1e3", ".5", "5.", "+7", "-7", "1,000", "", "x", "0x10", "1_000", "\t3\n"]
    expected = pd.to_numeric(pd.Series(raw, dtype=object), errors="coerce").tolist()
    got = values(raw, numbers.safe_number)
    assert got == [None if math.isnan(x) else x for x in expected]


def test_infinite_numbers_are_missing(values):
    assert values(["inf", "-Infinity", "1e999"], numbers.safe_number) == [None] * 3
    assert values([1.5, float("nan"), float("inf"), None], numbers.finite, "double") == [1.5, None, None, None]


def test_integer_casts(values):
    assert values(["7", " 8 ", "x", None], numbers.safe_integer) == [7, 8, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(["x"], numbers.strict_integer)


def test_commune_labels(values):
    raw = ["7", "7.0", "7.9", "0", "23", " Rural ", "nan", None, "22.9", "-3"]
    assert values(raw, numbers.integer_text) == ["7", "7", "7", "0", "23", "Rural", "nan", None, "22", "-3"]
    low, high = v.COMMUNES
    bounded = values(raw, lambda c: numbers.bounded_label(c, low, high, "No Registra"))
    assert bounded == ["7", "7", "7"] + ["No Registra"] * 5 + ["22", "No Registra"]


def test_mixed_dates_match_pandas(values):
    raw = [
        "05/06/2012", "5/6/2012", "12/31/2023", "31/12/2023", "31-12-2023", "2012-05-06", "2012/05/06",
        "5.6.2012", "2012-05-06 10:11:12", "05/06/2012 13:45", "junk", None, "31/02/2023", "99/99/2020",
    ]
    expected = pd.to_datetime(pd.Series(raw), format="mixed", dayfirst=True, errors="coerce")
    got = values(raw, dates.mixed_timestamp)
    assert got == [None if pd.isna(x) else x.to_pydatetime() for x in expected]


def test_folded_iso_time_stays_iso(values):
    got = values(["2012-05-06t00:00:00.000", "2012-05-06T10:11:12"], dates.mixed_timestamp)
    assert got == [dt.datetime(2012, 5, 6), dt.datetime(2012, 5, 6, 10, 11, 12)]


def test_bare_year_is_no_date(values):
    assert values(["2012", "201"], dates.mixed_timestamp) == [None, None]


def test_month_names(values):
    raw = ["05-ene-2012", "5-ago-2020", "31-dic-2019", "1-abr-2021", "7-may-2020"]
    got = values(raw, lambda c: dates.month_name_date(c, v.MONTHS))
    assert got == [
        dt.date(2012, 1, 5), dt.date(2020, 8, 5), dt.date(2019, 12, 31), dt.date(2021, 4, 1), dt.date(2020, 5, 7),
    ]


def test_one_format_only(values):
    got = values(["2012-05-06", "06/05/2012", None], lambda c: dates.safe_timestamp(c, "yyyy-MM-dd"))
    assert got == [dt.datetime(2012, 5, 6), None, None]


def python_years(start, end):
    return end.year - start.year - ((end.month, end.day) < (start.month, start.day))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.dates(dt.date(1900, 1, 1)), st.dates(dt.date(1900, 1, 1))), min_size=1, max_size=50))
def test_completed_years(spark, pairs):
    pairs = [(a, b) for a, b in pairs if max(a, b) < dt.date(2200, 1, 1)] + [
        (dt.date(2000, 2, 29), dt.date(2021, 2, 28))
    ]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a date, b date")
    got = df.select("i", dates.completed_years(F.col("a"), F.col("b")).alias("y")).orderBy("i")
    assert [r["y"] for r in got.collect()] == [python_years(a, b) for a, b in pairs]


def test_bands_match_pandas(values):
    ages = [-5, -1, 0, 13, 14, 26, 27, 59, 60, 113, None]
    expected = pd.cut(pd.Series(ages, dtype="float"), v.AGE_EDGES, labels=v.AGE_LABELS)
    got = values(ages, lambda c: recode.band(c, v.AGE_EDGES, v.AGE_LABELS), "int")
    assert got == [None if pd.isna(x) else x for x in expected]


def test_points_and_index(values, spark):
    assert values(["Femenino", "Masculino", "x", None], lambda c: recode.points(c, v.SEX_POINTS)) == [2, 1, 0, 0]
    assert values(["Youth", "x", None], lambda c: recode.lookup(c, v.AGE_POINTS)) == [1, None, None]
    df = spark.createDataFrame([(1, 2), (1, None)], "a int, b int")
    rows = df.select(numbers.additive_index(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r["s"] for r in rows] == [3, None]


def test_codes(values):
    raw = ["1", "20", "99", "x", None, "5.0", "5.5"]
    got = values(raw, lambda c: recode.code_label(c, v.FACT_CODES))
    assert got == [v.FACT_CODES[1], v.FACT_CODES[20], None, None, None, v.FACT_CODES[5], None]


def test_recode_keeps_quotes_and_backslashes(values):
    odd = {"it's": "a\\b", "c\\d": "e'f"}
    assert values(["it's", "c\\d", "g"], lambda c: recode.recode(c, odd)) == ["a\\b", "e'f", "g"]


def test_only_listed_treats_null_as_unlisted(values):
    assert values(["a", "b", None], lambda c: recode.only_listed(c, ["a"], "u")) == ["a", "u", "u"]
