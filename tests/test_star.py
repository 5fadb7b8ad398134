import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.operators import quality, star
from tributary.operators.star import Dimension, StarStore
from tributary.plans import reports
from tributary.session import scratch_path

PERSON = Dimension("person", "id_person", ("sex", "group"))
PLACE = Dimension("place", "id_place", ("place",))
DAY = dt.date(2020, 1, 2)


def rows(spark, data):
    return spark.createDataFrame(data, "sex string, group string, place string, day timestamp, n double")


@pytest.fixture
def batch(spark):
    moment = dt.datetime(2020, 1, 2, 10)
    return rows(
        spark,
        [
            ("f", "a", "p", moment, 1.0), ("f", None, "p", moment, 2.9), (None, None, None, moment, 3.0),
            ("m", "a", "q", None, 4.0), ("f", "a", "q", moment, None),
        ],
    )


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_fact_finds_null_keys_and_rejects_undated(batch):
    dims = [(d, n.table) for d, n in star.build_dimensions(batch, [PERSON, PLACE])]
    fact, rejected = star.build_fact(batch, dims, "day", ["n"], integers=["n"])
    assert fact.count() == 4 and rejected.count() == 1
    assert fact.filter("id_person IS NULL OR id_place IS NULL").count() == 0
    assert as_set(fact.select("day")) == {(DAY,)}
    assert sorted(r["n"] for r in fact.filter("n IS NOT NULL").collect()) == [1, 2, 3]


def test_dates(spark, batch):
    assert as_set(star.date_dimension(batch, "day")) == {(DAY, 2020, 1)}


def test_insert_ignore_keeps_the_stored_row(spark):
    stored = spark.createDataFrame([(1, "old"), (None, "old")], "id int, x string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (None, "new")], "id int, x string")
    assert as_set(star.insert_ignore(stored, batch, ["id"])) == {(1, "old"), (None, "old"), (2, "a")}


def test_ids_are_stable_over_runs(spark, batch):
    first = star.build_dimension(batch, PLACE).table
    later = rows(spark, [("f", "a", "0", None, 1.0), ("f", "a", "p", None, 1.0)])
    grown = {r["place"]: r["id_place"] for r in star.extend_dimension(first, later, PLACE).collect()}
    before = {r["place"]: r["id_place"] for r in first.collect()}
    assert grown == {**before, "0": len(before) + 1}


def load(spark, path):
    return StarStore(spark, path, (PERSON, PLACE), "day", ("n",), ("n",))


def test_loading_twice_is_loading_once(spark, batch):
    store = load(spark, scratch_path(spark, "star"))
    store.load(batch, "run-1")
    once = {name: as_set(store.table(name)) for name in ("person", "place", "dates", "facts", "rejects")}
    store.load(batch, "run-1")
    assert {name: as_set(store.table(name)) for name in once} == once
    assert store.table("facts").count() == 4 and store.table("person").count() == 4


def test_second_run_extends(spark, batch):
    store = load(spark, scratch_path(spark, "star"))
    store.load(batch, "run-1")
    places = as_set(store.table("place"))
    store.load(rows(spark, [("f", "a", "new", dt.datetime(2021, 3, 4), 5.0)]), "run-2")
    assert places < as_set(store.table("place"))
    assert store.table("facts").count() == 5 and store.table("dates").count() == 2
    for dim in (PERSON, PLACE):
        assert quality.key_violations(store.table(dim.name), [dim.id]).count() == 0
    loose = quality.fk_violations(
        store.table("facts"),
        [(d.id, store.table(d.name), d.id) for d in (PERSON, PLACE)] + [("day", store.table("dates"), "day")],
    )
    assert loose.count() == 0


def test_reset_drops_what_was_stored(spark, batch):
    store = load(spark, scratch_path(spark, "star"))
    store.load(batch, "run-1")
    store.reset(batch.filter("place = 'q'"), "run-2")
    assert as_set(store.table("place").select("place")) == {("q",)}
    assert store.table("facts").count() == 1


def test_a_mended_batch_leaves_nothing_of_the_first(spark, batch):
    store = load(spark, scratch_path(spark, "star"))
    store.load(batch, "2024-01-01")
    mended = batch.withColumn("day", F.coalesce("day", F.lit(dt.datetime(2020, 5, 6))))
    store.load(mended, "2024-01-01")
    assert store.table("facts").count() == 5 and store.table("rejects").count() == 0
    store.load(batch.filter("day IS NULL"), "2024-01-01")
    assert store.table("facts").count() == 0 and store.table("rejects").count() == 1
    assert {r["run"] for r in store.table("rejects").collect()} == {"2024-01-01"}


@pytest.mark.parametrize(
    ("fault", "constraint"),
    [
        (("f", "a", None, DAY, None), "not null: n"),
        (("f" * 101, "a", "p", DAY, 1.0), "length: sex"),
        (("f", "a", "p", DAY, -1.0), "check: n >= 0"),
    ],
)
def test_a_broken_constraint_stops_the_load(spark, fault, constraint):
    good = rows(spark, [("f", "a", "p", dt.datetime(2020, 1, 2), 1.0)])
    bad = good.union(spark.createDataFrame([fault], "sex string, group string, place string, day date, n double"))
    path = scratch_path(spark, "star")
    store = StarStore(spark, path, (PERSON, PLACE), "day", ("n",), (), ("n",), 100, "n >= 0")
    with pytest.raises(star.ConstraintBroken, match=constraint):
        store.load(bad, "r")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.table("facts")
    found = {r["constraint"]: r["n"] for r in store.violations(bad).collect()}
    assert found[constraint] == 1
    store.load(good, "r")
    assert store.table("facts").count() == 1


def test_reports(spark):
    fact = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 2), (3, 1)], "p int, a int")
    person = spark.createDataFrame([(1, "f"), (2, "m")], "id_p int, sex string")
    act = spark.createDataFrame([(1, "x"), (2, "w")], "id_a int, act string")
    both = [(person, "p", "id_p"), (act, "a", "id_a")]
    assert as_set(reports.count_by(fact, both[:1], ["sex"])) == {("f", 3), ("m", 1)}
    assert as_set(reports.most_common(fact, *both, "sex", "act")) == {("f", "x", 2), ("m", "w", 1)}
    wide = reports.counts_over_time(reports.count_by(fact, both, ["act", "sex"]), "act", "sex", ["f", "m"], "total")
    assert as_set(wide) == {("x", 2, None), ("w", 1, 1)}


def test_dimension_joins_left_and_inner(spark):
    fact = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one")], "k_dim int, name string")
    assert as_set(star.star_join(fact, [(dim, "k", "k_dim")])) == {(1, "one")}
    assert star.star_join(fact, [(dim, "k", "k_dim")], "left").count() == 3
