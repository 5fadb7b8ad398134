import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.operators import profile, quality
from tributary.session import scratch_path

SCHEMA = "n int, x double, day date, s string, free string"
GOOD = [(i, i / 2, dt.date(2020, 1, 1 + i), "ab"[i % 2], f"text {i}") for i in range(25)]


@pytest.fixture
def good(spark):
    return spark.createDataFrame(GOOD, SCHEMA)


def broken_rules(df, rules):
    return {r["rule"] for r in quality.validate(df, rules).filter("NOT ok").collect()}


DOMAINS = ["s"]


def test_a_table_obeys_its_own_rules(good):
    assert broken_rules(good, quality.infer_rules(good, DOMAINS)) == set()


def test_rule_kinds(good):
    found = quality.infer_rules(good, ["s", "free"]).collect()
    rules = {r["rule"]: r for r in found}
    assert sorted(r["member"] for r in found if r["rule"] == "s: value_set") == ["a", "b"]
    assert sum(r["rule"] == "free: value_set" for r in found) == 25
    assert (rules["day: range"]["low"], rules["day: range"]["high"]) == ("2020-01-01", "2020-01-25")
    assert (rules["free: length"]["low"], rules["free: length"]["high"]) == ("6", "7")


@pytest.mark.parametrize(
    "row, rule",
    [
        ((99, 1.0, dt.date(2020, 1, 2), "a", "text 1"), "n: range"),
        ((1, -0.5, dt.date(2020, 1, 2), "a", "text 1"), "x: range"),
        ((1, 1.0, dt.date(2031, 1, 2), "a", "text 1"), "day: range"),
        ((1, 1.0, dt.date(2020, 1, 2), "c", "text 1"), "s: value_set"),
        ((1, 1.0, dt.date(2020, 1, 2), "a", "text too long"), "free: length"),
        ((1, 1.0, None, "a", "text 1"), "day: null_share"),
    ],
)
def test_a_fault_breaks_its_rule(spark, good, row, rule):
    faulty = good.unionByName(spark.createDataFrame([row], SCHEMA))
    rules = quality.infer_rules(good, DOMAINS)
    assert broken_rules(faulty, rules) == {rule}
    with pytest.raises(ValueError, match=rule):
        quality.require_valid(quality.validate(faulty, rules))


def test_empty_and_narrow_tables_fail(good):
    rules = quality.infer_rules(good, DOMAINS)
    assert "row_count" in broken_rules(good.limit(0), rules)
    assert {"s: value_set", "s: length", "s: null_share"} <= broken_rules(good.drop("s"), rules)


def test_rules_are_stored_once(spark, good):
    path = scratch_path(spark, "rules")
    first = quality.load_or_infer(good, path).collect()
    again = quality.load_or_infer(good.withColumn("n", F.lit(1000)), path).collect()
    assert sorted(first) == sorted(again)
    quality.save_rules(quality.infer_rules(good.select("n")), path)
    assert {r["column"] for r in quality.load_rules(spark, path).collect()} == {None, "n"}


def test_outcomes_are_kept_per_run(spark, good):
    path = scratch_path(spark, "outcomes")
    outcome = quality.settled(quality.validate(good, quality.infer_rules(good)))
    for run in ("2024-01-01", "007", "007"):
        quality.save_outcome(outcome, path, run)
    kept = quality.load_outcomes(spark, path)
    assert kept.count() == 2 * outcome.count()
    assert {r["run"] for r in kept.select("run").collect()} == {"2024-01-01", "007"}


def test_not_a_number_bounds_nothing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0,), (2.0,), (nan,)], "x double")
    rules = quality.infer_rules(df)
    found = {r["rule"]: (r["low"], r["high"]) for r in rules.collect()}
    assert found["x: range"] == ("1.0", "2.0")
    assert float(found["x: null_share"][1]) == pytest.approx(1 / 3)
    assert broken_rules(spark.createDataFrame([(1.5,), (99.0,)], "x double"), rules) == {"x: range"}
    assert broken_rules(spark.createDataFrame([(nan,), (nan,)], "x double"), rules) >= {"x: null_share"}


def test_open_bounds_and_tolerance(spark, good):
    rules = quality.infer_rules(good, open_above=["day", "n"], tolerance=0.2)
    later = spark.createDataFrame([(999, 1.0, dt.date(2031, 1, 2), None, "text 1")], SCHEMA)
    assert broken_rules(good.unionByName(later), rules) == set()
    earlier = spark.createDataFrame([(-1, 1.0, dt.date(2011, 1, 2), "a", "text 1")], SCHEMA)
    assert broken_rules(good.unionByName(earlier), rules) == {"day: range", "n: range"}


def test_planted_violations(spark):
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "w")], "id int, v string")
    assert {r["id"] for r in quality.key_violations(dim, ["id"]).collect()} == {2, None}
    fact = spark.createDataFrame([(1,), (7,), (7,), (None,)], "k int")
    loose = quality.fk_violations(fact, [("k", dim, "id")]).collect()
    assert [(r["foreign_key"], r["value"], r["n"]) for r in loose] == [("k", "7", 2)]
    checked = quality.check_violations(dim.union(spark.createDataFrame([(9, None)], dim.schema)), F.col("v").isin("x", "y"))
    assert {r["v"] for r in checked.collect()} == {"z", "w"}


def test_steps_are_counted_by_the_job_itself(spark):
    df, read = profile.watch(spark.range(10), "read")
    df, kept = profile.watch(df.filter("id > 3"), "kept")
    df.write.format("noop").mode("overwrite").save()
    rows = profile.watched_rows(df, [("read", read), ("kept", kept)]).collect()
    assert [tuple(r) for r in rows] == [("read", 10), ("kept", 6)]
