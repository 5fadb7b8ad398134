import datetime as dt
import decimal
import math

import pytest
from pyspark.sql import functions as F

from tributary.operators import quality, states

KIND = "i bigint, p decimal(9,2), x double, t string, d date, m timestamp, b boolean"


def rows(spark, start, stop):
    day = dt.date(2020, 1, 1)
    data = [
        (
            n, decimal.Decimal(n) / 4, math.nan if n % 7 == 0 else n / 3, None if n % 5 == 0 else f"t{n % 40}",
            day + dt.timedelta(days=n % 90), dt.datetime(2020, 1, 1, n % 24, 0, 0, n), n % 2 == 0,
        )
        for n in range(start, stop)
    ]
    return spark.createDataFrame(data, KIND)


@pytest.fixture(scope="module")
def history(spark):
    parts = [rows(spark, 0, 1500), rows(spark, 1500, 1600), rows(spark, 1600, 4000), rows(spark, 0, 0)]
    kept = parts[0].union(parts[1]).union(parts[2])
    held = states.column_states(parts[0])
    for part in parts[1:]:
        held = held.unionByName(states.column_states(part))
    return held.cache(), kept.cache()


def exact(df):
    return {tuple(r) for r in df.filter("kind NOT IN ('distinct_count', 'quantile')").collect()}


def test_merged_states_give_the_rules_of_all_rows(history):
    held, kept = history
    merged = states.rules_from_states(states.merge_states(held))
    assert exact(merged) == exact(states.rules_from_states(states.column_states(kept)))
    assert {r.rule for r in merged.collect()} >= {"i: range", "d: range", "t: length", "x: type", "x: quantile 0.5"}
    bounds = {r.rule: (r.low, r.high) for r in merged.collect()}
    assert bounds["i: range"] == ("0", "3999") and bounds["t: length"] == ("2", "3")
    assert bounds["d: range"] == ("2020-01-01", "2020-03-30")


def test_sketches_are_within_their_error(history):
    held, kept = history
    got = {r.column: r for r in states.merge_states(held).select("column", states.distinct_count().alias("n")).collect()}
    for c in ("i", "p", "x", "t", "d"):
        true = kept.filter(~F.isnan(c) if c == "x" else F.lit(True)).select(c).na.drop().distinct().count()
        assert abs(got[c].n - true) <= states.DISTINCT_ERROR * true + 1
    for fraction in (0.05, 0.5, 0.95):
        one = states.merge_states(held).filter("column = 'i'").select(states.quantile(fraction)).first()[0]
        assert abs(one - fraction * 4000) <= 2 * states.RANK_ERROR * 4000


def test_a_batch_is_judged_by_its_history(history, spark):
    held, kept = history
    rules = states.rules_from_states(held.filter("rows > 0"))
    outcome = {r.rule: r.ok for r in quality.validate(kept, rules).collect()}
    assert outcome["i: range"] and outcome["t: distinct_count"] and outcome["x: quantile 0.5"] and outcome["p: type"]
    odd = kept.withColumn("i", (F.col("i") % 3).cast("int")).withColumn("x", F.col("x") * 100)
    outcome = {r.rule: r.ok for r in quality.validate(odd, rules).collect()}
    assert not outcome["i: type"] and not outcome["i: distinct_count"] and not outcome["x: quantile 0.95"]
    assert not outcome["x: range"] and outcome["t: length"]
    empty = {r.rule: r.ok for r in quality.validate(kept.limit(0), rules).collect()}
    assert empty["i: type"] and not empty["i: distinct_count"]


def test_a_column_of_several_types_has_no_rules(spark):
    one = states.column_states(spark.createDataFrame([(1, "a")], "x int, y string"))
    two = states.column_states(spark.createDataFrame([("1", "a")], "x string, y string"))
    both = one.unionByName(two)
    assert {r.column for r in states.rules_from_states(both).collect()} == {"y"}
    assert states.merge_states(both).filter("column = 'x'").count() == 2


def test_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, 0, 20).write.parquet(path)
    plan = states.column_states(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
