"""Physical plans: what must and must not occur in them."""

import pytest

from tributary.plans.catalogue import QUERIES

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"
JOINING = [
    "star_join_extract", "column_compare_filter", "completed_years", "avg_topk", "histogram",
    "ordered_category_count", "label_encode", "insert_ignore_dim", "extend_dimension", "fact_build",
    "fk_violations", "report_year_group", "report_group_total", "report_mode_by_group",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    yield
    spark.conf.set(THRESHOLD, before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


@pytest.mark.parametrize("name", JOINING)
def test_large_sides_are_merged(spark, sf_dir, no_broadcast, name):
    """Beyond the threshold no join needs one side in memory, except counted small tables."""
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in ("label_encode", "fact_build", "report_mode_by_group"):
        assert "BroadcastHashJoin" not in text


def test_small_dimensions_are_broadcast(spark, sf_dir):
    text = plan(QUERIES["fact_build"](spark, sf_dir))
    assert text.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in text


def test_grouping_has_one_exchange_and_partial_sums(spark, sf_dir):
    text = plan(QUERIES["group_sum_null_zero"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text


def test_projection_and_filters_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["range_filter"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThanOrEqual(o_orde" in text
    scan = text[text.index("ReadSchema") :]
    assert "o_totalprice" not in scan and "o_orderstatus" not in scan


def test_top_k_needs_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["avg_topk"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan(QUERIES["value_share_topk"](spark, sf_dir))


def test_profiles_scan_once(spark, sf_dir):
    for name in ("null_profile", "invalid_share", "duplicate_count", "value_share_topk"):
        assert plan(QUERIES[name](spark, sf_dir)).count("FileScan") == 1


def test_long_texts_are_not_shuffled(spark, sf_dir):
    text = plan(QUERIES["duplicate_count"](spark, sf_dir))
    assert "sha2" in text and "hashpartitioning(text" not in text


def test_numbering_has_no_window_and_no_join(spark, sf_dir):
    text = plan(QUERIES["surrogate_dim_ranges"](spark, sf_dir))
    assert "Window" not in text and "Join" not in text and "Exchange" not in text


def test_the_number_pattern_runs_once(spark):
    from tributary.functions.numbers import safe_number

    df = spark.createDataFrame([("1",)], "x string").repartition(1)
    text = plan(df.select(safe_number(df.x).alias("y")))
    assert text.count("regexp_extract") == 1


def test_record_star_reads_its_records_once(spark, sf_dir):
    text = plan(QUERIES["record_star"](spark, sf_dir))
    assert text.count("FileScan") == 1
