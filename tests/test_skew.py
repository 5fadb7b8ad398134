from statistics import median

import pytest
from pyspark.sql import functions as F

from tributary.operators import skew
from tributary.operators.keys import attach_number


@pytest.fixture
def plain_joins(spark):
    """No broadcasts and no adaptive help."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def tables(spark, rows=80_000):
    """Half of the rows hold one label, a quarter a null; the rest 1,000 labels."""
    n = F.col("id")
    label = F.when(n % 2 == 0, F.lit("unknown")).when(n % 4 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("label "), (n % 4000).cast("string"))
    )
    df = spark.range(0, rows, 1, 8).select("id", label.alias("name"), (n % 1).alias("kind"))
    dim = df.select("name", "kind").distinct().select(F.xxhash64("name").alias("number"), "name", "kind")
    return df, dim


def test_hot_keys_are_found(spark):
    df, _ = tables(spark)
    hot = skew.frequent_hashes(df, ["name", "kind"])
    want = df.filter("name = 'unknown' OR name IS NULL").select(skew.key_hash(["name", "kind"])).distinct()
    assert set(hot) == {r[0] for r in want.collect()}
    counted = df.groupBy("name", "kind").agg(F.count("*").alias("n"))
    assert skew.frequent_hashes(counted, ["name", "kind"], "n") == hot
    assert skew.frequent_hashes(df.limit(0), ["name"]) == []
    assert len(skew.frequent_hashes(df, ["id"])) == 0


def test_no_task_has_most_of_the_rows(spark, plain_joins):
    df, dim = tables(spark)
    keys = ["name", "kind"]
    plain = attach_number(df, dim, keys, "number")
    split = skew.attach_number_split(df, dim, keys, "number")

    def sizes(joined):
        rows = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        return sorted(r["count"] for r in rows)

    before, after = sizes(plain), sizes(split)
    assert before[-1] > 2 * median(before)
    assert after[-1] <= 2 * median(after)
    text = split._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" in text
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
    assert split.count() == df.count() and split.filter("number IS NULL").count() == 0


def test_without_hot_keys_it_is_the_plain_join(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, name string")
    dim = spark.createDataFrame([(7, "a"), (8, None)], "number int, name string")
    rows = {tuple(r) for r in skew.attach_number_split(df, dim, ["name"], "number", []).collect()}
    assert rows == {(1, "a", 7), (2, None, 8), (3, "c", None)}
    hot = skew.frequent_hashes(df, ["name"])
    assert {tuple(r) for r in skew.attach_number_split(df, dim, ["name"], "number", hot).collect()} == rows
