import pytest
from pyspark.sql import functions as F

from tributary.operators import aggregate, clean, encode, keys, profile, shape
from tributary.plans import vocabulary as v

ROWS = [
    ("a", "x", 1.0), ("a", "x", None), ("a", None, 2.5), (None, None, None), (None, None, None),
    ("b", "y", None), ("b", "y", None), ("b", "z", 4.0),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "k string, g string, m double")


def as_set(frame):
    return {tuple(r) for r in frame.collect()}


def test_null_keys_and_empty_sums(df):
    sums = aggregate.group_sum(df, ["k", "g", "absent"], "m")
    assert as_set(sums) == {
        ("a", "x", 1.0), ("a", None, 2.5), (None, None, 0.0), ("b", "y", 0.0), ("b", "z", 4.0),
    }
    counts = aggregate.group_count(df, ["k", "g"])
    assert ("b", "y", 2) in as_set(counts) and (None, None, 2) in as_set(counts)


def test_flags(df):
    observed = aggregate.group_sum(df, ["k"], "m", flag="f", flag_mode="observed")
    assert as_set(observed.select("k", "f")) == {("a", "reported"), ("b", "reported"), (None, "unknown")}
    constant = aggregate.group_sum(df, ["k"], "m", flag="f")
    assert {r["f"] for r in constant.collect()} == {"reported"}


def test_sum_of_sums_is_the_sum(df):
    once = aggregate.group_sum(df, ["k", "g"], "m")
    assert as_set(aggregate.consolidate(once, ["k", "g"], "m")) == as_set(once)
    halves = [aggregate.group_sum(df.filter(c), ["k", "g"], "m") for c in ("m > 2", "m <= 2 OR m IS NULL")]
    union = halves[0].unionByName(halves[1])
    assert as_set(aggregate.consolidate(union, ["k", "g"], "m")) == as_set(once)


def test_collapsed_rows_weigh_what_they_stand_for(df):
    few = aggregate.collapse(df, ["k", "g", "m"], "w")
    assert few.count() == 6
    assert as_set(aggregate.group_count(few, ["k"], weight="w")) == as_set(aggregate.group_count(df, ["k"]))
    assert as_set(aggregate.group_sum(few, ["k"], "m", weight="w")) == as_set(aggregate.group_sum(df, ["k"], "m"))


def test_mode_ties_go_to_the_smallest(spark):
    rows = [(1, "b"), (1, "a"), (1, None), (1, None), (1, None), (2, "c")]
    modes = aggregate.mode_per_group(spark.createDataFrame(rows, "g int, x string"), ["g"], "x")
    assert as_set(modes) == {(1, "a", 1), (2, "c", 1)}


def test_shares(spark):
    rows = [("a",)] * 5 + [("b",)] * 3 + [("c",)] * 3 + [(None,)] * 9
    df = spark.createDataFrame(rows, "x string")
    top = [tuple(r) for r in aggregate.value_shares(df, "x", k=2).orderBy(F.desc("n")).collect()]
    assert top == [("a", 5, 45.4545), ("b", 3, 27.2727)]
    assert as_set(aggregate.value_shares(df, "x")) == {("a", 5, 45.4545), ("b", 3, 27.2727), ("c", 3, 27.2727)}


def test_histogram_edges(spark):
    df = spark.range(0, 11).select(F.col("id").cast("double").alias("x"))
    bins = aggregate.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [2, 2, 2, 2, 3]
    assert (bins[0]["low"], bins[-1]["high"]) == (0.0, 10.0)
    same = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [r["n"] for r in aggregate.histogram(same, "x", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_categories_without_rows_stay(spark):
    df = spark.createDataFrame([("Youth",), ("Youth",), (None,)], "b string")
    counts = aggregate.ordered_category_count(df, "b", v.AGE_LABELS).orderBy("position").collect()
    assert [r["n"] for r in counts] == [0, 2, 0, 0]


def test_profiles(spark):
    rows = [("a", 1), ("a", 1), ("b", None), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "s string, n int")
    assert as_set(profile.null_profile(df)) == {("s", 5, 2, 40.0), ("n", 5, 3, 60.0)}
    assert as_set(profile.duplicate_count(df)) == {(5, 3, 2)}
    assert as_set(profile.duplicate_count(df, ["s"])) == {(5, 3, 2)}
    assert as_set(profile.column_describe(df)) == {("s", 3, 2, "a", 2)}
    assert as_set(profile.label_share(df, "s", "a")) == {(5, 2, 40.0)}
    empty = spark.createDataFrame([("", 1), (None, 1)], "s string, n int")
    assert as_set(profile.duplicate_count(empty, ["s"])) == {(2, 2, 0)}


def test_filters(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (None, 2), (None, None)], "a int, b int")
    assert as_set(clean.drop_all_null(df)) == {(1, 2), (3, 2), (None, 2)}
    assert as_set(clean.keep_ordered(df, "a", "b")) == {(1, 2)}
    assert as_set(clean.keep_range(df, "a", 1, 2)) == {(1, 2)}
    met, others = clean.split_rows(df, F.col("a") > 2)
    assert (met.count(), others.count()) == (1, 3)


@pytest.fixture(params=["true", "false"])
def coalescing(spark, request):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, before)


def test_large_tables_are_numbered_in_several_partitions(spark, coalescing):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("a"))
    numbered = keys.number_distinct(df, ["a"], "id", start=0).table
    assert numbered.filter("a != id").count() == 0 and numbered.count() == 5000
    if coalescing == "false":
        assert numbered.select(F.spark_partition_id()).distinct().count() > 1


def test_numbers_are_a_bijection_in_order(spark):
    rows = [(i % 97, str(i % 13)) for i in range(3000)] + [(None, "x"), (None, None)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(7)
    numbered = keys.number_distinct(df, ["a", "b"], "id")
    got = numbered.table.orderBy("id").collect()
    expected = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [(r["a"], r["b"]) for r in got] == expected
    assert [r["id"] for r in got] == list(range(1, len(expected) + 1))
    assert numbered.rows == len(expected)


def test_an_empty_table_has_no_numbers(spark):
    empty = keys.number_distinct(spark.createDataFrame([], "a int"), ["a"], "id")
    assert (empty.rows, empty.table.collect()) == (0, [])


def test_pivot_is_complete_or_loud(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "zz", 9), (2, "x", 1), (2, None, 3)], "i int, k string, n int")
    assert as_set(aggregate.pivot_first(df, "i", "k", None, "n")) == {(1, 5, 9), (2, 1, None)}
    with pytest.raises(Exception, match="no column for zz"):
        aggregate.pivot_first(df, "i", "k", ["x"], "n").collect()
    with pytest.raises(Exception, match="two rows for one cell"):
        aggregate.pivot_first(df.union(df.limit(1)), "i", "k", ["x", "zz"], "n").collect()


def test_pivot_looks_up_no_more_columns_than_allowed(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "zz", 9), (2, None, 3)], "i int, k string, n int")
    assert as_set(aggregate.pivot_first(df, "i", "k", None, "n", max_columns=2)) == {(1, 5, 9)}
    with pytest.raises(ValueError, match="more than 1 values"):
        aggregate.pivot_first(df, "i", "k", None, "n", max_columns=1)


def test_not_a_number_is_missing_in_a_histogram(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (nan,), (inf,), (None,)], "x double")
    bins = aggregate.histogram(df, "x", 2).orderBy("bin").collect()
    assert [(b["low"], b["high"], b["n"]) for b in bins] == [(0.0, 1.0, 1), (1.0, 2.0, 2)]


def test_encodings(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "x string")
    assert as_set(encode.label_encode(df, "x", "c")) == {("b", 1), ("a", 0), (None, None)}
    assert as_set(encode.label_mapping(df, "x", "c")) == {(0, "a"), (1, "b")}
    hot = encode.one_hot(df, "x", "x", max_columns=2)
    assert hot.columns == ["x", "x_a", "x_b"]
    assert as_set(hot) == {("b", 0, 1), ("a", 1, 0), (None, 0, 0)}
    with pytest.raises(ValueError, match="more than 1"):
        encode.one_hot(df, "x", "x", max_columns=1)
    with pytest.raises(ValueError, match="most columns"):
        encode.one_hot(df, "x", "x")


def test_union_keeps_all_rows(spark):
    one = spark.createDataFrame([(1, "x")], "total_victim int, sex string")
    two = spark.createDataFrame([("a", 2.0)], "source string, total_victim double")
    union = shape.union_conformed([one, two], v.HARMONISED)
    assert union.schema.fieldNames() == v.HARMONISED.fieldNames()
    assert [f.dataType for f in union.schema] == [f.dataType for f in v.HARMONISED]
    assert union.agg(F.sum("total_victim")).first()[0] == 3.0


def test_partitioning_does_not_change_results(spark, df):
    expected = as_set(aggregate.group_sum(df, ["k", "g"], "m"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        shuffled = df.repartition(5).orderBy(F.rand(1))
        assert as_set(aggregate.group_sum(shuffled, ["k", "g"], "m")) == expected
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_skewed_group(spark):
    """A third of the rows under one key."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 100).alias("k"),
        (F.col("id") % 7).cast("string").alias("x"),
    )
    modes = {r["k"]: (r["mode"], r["n"]) for r in aggregate.mode_per_group(df, ["k"], "x").collect()}
    exact = {}
    for i in range(30_000):
        k = -1 if i % 3 == 0 else i % 100
        exact.setdefault(k, {}).setdefault(str(i % 7), 0)
        exact[k][str(i % 7)] += 1
    assert modes == {k: min(((x, n) for x, n in c.items()), key=lambda p: (-p[1], p[0])) for k, c in exact.items()}
