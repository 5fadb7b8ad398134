import datetime as dt
import decimal
import re

import pytest
from pyspark.sql import functions as F

from tributary.functions.dates import inferred_timestamps
from tributary.operators import profile
from tributary.sources import types


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1", "-2", None, "+003"], "bigint"),
        (["1", " 2 "], "bigint"),
        (["999999999999999999", "1"], "bigint"),
        (["9999999999999999999", "1"], "decimal(19,0)"),
        (["1", "2.50", "-.5"], "decimal(3,2)"),
        (["1" * 39], "double"),
        (["1" * 30 + ".5", "0." + "1" * 20], "double"),
        (["1", "2.5", "1e3"], "double"),
        (["5."], "double"),
        (["2020-01-02", None], "date"),
        (["2020-02-30"], "string"),
        (["2020-01-02", "2020-01-02 03:04:05", "2020-01-02T03:04"], "timestamp"),
        (["2020-01-02", "1"], "string"),
        (["true", "False", None], "boolean"),
        (["true", "1"], "string"),
        (["1", "x"], "string"),
        ([None, None], "string"),
        ([""], "string"),
        (["nan", "1"], "string"),
    ],
)
def test_common_types(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert types.infer_types(df) == {"x": kind}
    typed = types.with_types(df)
    assert typed.schema["x"].dataType.simpleString() == kind
    assert typed.filter("x IS NOT NULL").count() == sum(v is not None for v in values)


def test_values_are_kept(spark):
    df = spark.createDataFrame([("01", "1.5", "2020-01-02", "k"), ("2", "22", None, None)], "a string, b string, c string, d string")
    got = [tuple(r) for r in types.with_types(df).collect()]
    assert got == [(1, decimal.Decimal("1.5"), dt.date(2020, 1, 2), "k"), (2, decimal.Decimal(22), None, None)]
    codes = types.infer_types(df, codes_as_text=True)
    assert codes["a"] == "string" and codes["b"] == "decimal(3,1)"
    assert types.infer_types(df, ["c"]) == {"c": "date"}


def test_all_columns_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", "x", "2.5")], "a string, b string, c string")
    df.write.parquet(path)
    wide = spark.read.parquet(path)
    seen = []
    first = type(wide).first

    def watched(self):
        seen.append(self._jdf.queryExecution().executedPlan().toString())
        return first(self)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(wide), "first", watched)
        types.infer_types(wide)
    assert len(seen) == 1 and seen[0].count("FileScan") == 1


def test_the_format_most_values_are_in(spark):
    rows = [("2020-01-02", "01/02/2020", "x"), ("2020-13-40", "13/02/2020", None), (None, "14/02/2020", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    found = inferred_timestamps(df, ["a", "b", "c"])
    got = df.select(*[c.cast("date").alias(n) for n, c in found.items()])
    feb = [dt.date(2020, 2, d) for d in (1, 13, 14)]
    assert [tuple(r) for r in got.collect()] == [(dt.date(2020, 1, 2), feb[0], None), (None, feb[1], None), (None, feb[2], None)]
    tie = spark.createDataFrame([("01/02/2020",)], "a string")
    for formats, month in ((("dd/MM/yyyy", "MM/dd/yyyy"), 2), (("MM/dd/yyyy", "dd/MM/yyyy"), 1)):
        column = inferred_timestamps(tie, ["a"], formats)["a"]
        assert tie.select(F.month(column)).first()[0] == month
    assert df.limit(0).select(inferred_timestamps(df.limit(0), ["a"])["a"]).collect() == []


LONG = "same beginning of more than thirty-two characters "


@pytest.mark.parametrize(
    ("values", "top", "freq"),
    [
        (["b", "a", "b", "a", None], "a", 2),
        ([LONG + "b", LONG + "a", LONG + "b", LONG + "a", LONG + "c"], LONG + "a", 2),
        ([LONG + "z", "b", LONG + "z"], LONG + "z", 2),
        ([LONG, LONG[:32], LONG[:32] + "!"], LONG[:32], 1),
        ([LONG[:31] + "\U0001f600" * 3, LONG[:31] + "\U0001f600" * 2], LONG[:31] + "\U0001f600" * 2, 1),
        ([None, None], None, None),
        (["", "", "x"], "", 2),
    ],
)
def test_the_most_frequent_text(spark, values, top, freq):
    df = spark.createDataFrame([(v, "k") for v in values], "x string, y string")
    got = {r.column: r for r in profile.column_describe(df).collect()}
    assert (got["x"].top, got["x"].freq) == (top, freq)
    assert got["x"].n_values == sum(v is not None for v in values)
    assert got["x"].n_unique == len({v for v in values if v is not None})
    assert (got["y"].top, got["y"].freq) == ("k", len(values))


def test_no_text_is_shuffled(spark, monkeypatch):
    df = spark.range(40).select(F.concat(F.repeat(F.lit("x"), 100_000), (F.col("id") % 3).cast("string")).alias("t"))
    plan = profile.digest_counts(profile.long_form(df, ["t"]))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(column") :]
    assert re.search(r"HashAggregate\(keys=\[column#\d+, digest#\d+, size#\d+, head#\d+\], functions=\[partial_count", below)
    for small in (0, 100):
        monkeypatch.setattr(profile, "SMALL_ROWS", small)
        row = profile.column_describe(df).first()
        assert (row.n_values, row.n_unique, row.freq) == (40, 3, 14) and row.top.endswith("x0")


def test_numbers_and_dates(spark):
    data = [(float(i), i, dt.date(2020, 1, 1 + i % 30)) for i in range(1, 101)] + [(float("nan"), None, None)]
    df = spark.createDataFrame(data, "x double, i int, d date")
    got = {r.column: r for r in profile.number_describe(df).collect()}
    for c in ("x", "i"):
        assert (got[c].n_values, got[c].mean, got[c].low, got[c].high) == (100, 50.5, 1.0, 100.0)
        assert (got[c].q25, got[c].q50, got[c].q75) == (25.0, 50.0, 75.0)
    day = profile.date_describe(df).first()
    assert (day.low, day.high, day.n_values) == (dt.date(2020, 1, 1), dt.date(2020, 1, 30), 100)
    assert [r.n_values for r in profile.number_describe(df.limit(0)).collect()] == [0, 0]
