from pyspark.sql import functions as F

from tributary.operators import clean, fused, profile


def table(spark, path):
    data = [(n, None if n % 3 == 0 else n / 2, "x" if n % 4 else None) for n in range(200)]
    spark.createDataFrame(data, "a int, b double, t string").write.parquet(path)
    return spark.read.parquet(path)


def reports():
    out = {f"below {n}": fused.condition_report(F.col("b") < n, "b") for n in range(0, 80, 10)}
    out |= {"label": fused.label_report("t", "x"), "nulls": fused.null_report(["a", "b", "t"])}
    return out | {"ends": fused.extremes_report(["a", "t"]), "even": fused.condition_report(F.col("a") % 2 == 0, "a")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_twelve_reports_equal_the_single_ones(spark, tmp_path):
    df = table(spark, str(tmp_path / "t"))
    found = fused.fused(df, reports())
    assert len(found) == 12
    for n in range(0, 80, 10):
        assert rows(found[f"below {n}"]) == rows(clean.condition_report(df, F.col("b") < n, "b"))
    assert rows(found["label"]) == rows(profile.label_share(df, "t", "x"))
    assert rows(found["nulls"]) == rows(profile.null_profile(df))
    assert found["nulls"].columns == profile.null_profile(df).columns
    assert rows(found["ends"]) == [("a", "0", "199"), ("t", "x", "x")]


def test_one_scan_for_all(spark, tmp_path):
    df = table(spark, str(tmp_path / "t"))
    plan = fused.fused_row(df, reports())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    for one in fused.fused(df, reports()).values():
        assert "FileScan" not in one._jdf.queryExecution().executedPlan().toString()


def test_an_empty_table(spark, tmp_path):
    df = table(spark, str(tmp_path / "t")).limit(0)
    found = fused.fused(df, reports())
    assert rows(found["nulls"]) == rows(profile.null_profile(df))
    assert rows(found["below 10"]) == [(0, 0, 0, None, None, None)]
