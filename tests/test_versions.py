import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from tributary.operators import quality
from tributary.operators.star import ConstraintBroken, Dimension, StarStore
from tributary.session import scratch_path
from tributary.sources.versions import Part, Snapshot, Table, VersionConflict, VersionLog

PERSON = Dimension("person", "id_person", ("sex", "group"))
PLACE = Dimension("place", "id_place", ("place",))
NAMES = ("person", "place", "dates", "facts", "rejects")
KIND = "sex string, group string, place string, day timestamp, n double"
DAY = dt.datetime(2020, 1, 2)


def batch(spark, data):
    return spark.createDataFrame(data, KIND)


def first(spark):
    return batch(spark, [("f", "a", "p", DAY, 1.0), ("m", None, None, DAY, 2.0), ("f", "a", "q", None, 3.0)])


def second(spark):
    return batch(spark, [("m", "b", "new", dt.datetime(2021, 5, 6), 4.0), ("f", "a", "p", None, 5.0)])


def store(spark, path=None, **options):
    return StarStore(spark, path or scratch_path(spark, "star"), (PERSON, PLACE), "day", ("n",), ("n",), **options)


def content(star, version=None):
    return {name: sorted(map(tuple, star.table(name, version).collect()), key=str) for name in NAMES}


class Killed(BaseException):
    """Ends a load where it stands."""


@pytest.mark.parametrize("method", ["load", "reset"])
@pytest.mark.parametrize("step", range(6))
def test_a_load_that_dies_leaves_the_old_star(spark, monkeypatch, method, step):
    """Killed before each of its writes, without a chance to clean up, a load shows nothing."""
    star = store(spark)
    star.load(first(spark), "1")
    before = content(star)
    writes = []
    stage, commit = VersionLog.stage, VersionLog.commit

    def counted(of):
        def run(*args, **options):
            writes.append(of.__name__)
            if len(writes) > step:
                raise Killed
            return of(*args, **options)

        return run

    with monkeypatch.context() as patch:
        patch.setattr(VersionLog, "stage", counted(stage))
        patch.setattr(VersionLog, "commit", counted(commit))
        patch.setattr("tributary.operators.star.remove_path", lambda *_: None)
        with pytest.raises(Killed):
            getattr(star, method)(second(spark), "2")
    assert writes[-1] == ("stage", "stage", "stage", "stage", "stage", "commit")[step]
    assert content(star) == before
    getattr(star, method)(second(spark), "2")
    assert star.table("facts").count() == (3 if method == "load" else 1)
    for dim in (PERSON, PLACE):
        assert quality.key_violations(star.table(dim.name), [dim.id]).count() == 0
    left = star.log.vacuum(keep=1, older_than=0)
    assert len(left) >= step and content(star)["facts"]


def test_a_failing_reload_leaves_the_former_run(spark, monkeypatch):
    star = store(spark)
    star.load(first(spark), "1")
    before = content(star)
    monkeypatch.setattr("tributary.operators.star.build_dimension", None)  # not needed for a known star
    monkeypatch.setattr(
        "tributary.operators.star.attach_number",
        lambda df, numbered, columns, number: df.withColumn(number, F.lit(None).cast("long")),
    )
    with pytest.raises(ConstraintBroken, match="without a dimension row"):
        star.load(second(spark), "1")
    assert content(star) == before
    assert star.log.versions() == [1]


def test_only_one_of_two_loads_numbers_a_member(spark, monkeypatch):
    """A load that another one overtakes starts anew from the other's version."""
    path = scratch_path(spark, "star")
    star = store(spark, path)
    star.load(first(spark), "1")
    commit = VersionLog.commit
    overtaken = []

    def slow(self, base, tables):
        if not overtaken:
            overtaken.append(True)
            store(spark, path).load(second(spark), "other")
        return commit(self, base, tables)

    monkeypatch.setattr(VersionLog, "commit", slow)
    star.load(second(spark), "2")
    assert star.log.versions() == [1, 2, 3]
    assert star.table("facts").count() == 4
    for dim in (PERSON, PLACE):
        table = star.table(dim.name)
        assert quality.key_violations(table, [dim.id]).count() == 0
        assert quality.key_violations(table, list(dim.columns)).filter("n > 1").count() == 0
    overtaken.clear()
    with pytest.raises(VersionConflict):
        store(spark, path, attempts=1).load(second(spark), "3")
    assert star.log.versions() == [1, 2, 3, 4]


def test_of_many_writers_of_a_version_one_wins(spark):
    log = VersionLog(spark, scratch_path(spark, "log"))
    outcomes = []

    def write(n):
        try:
            log.commit(Snapshot(0), {f"t{n}": Table("{}")})
            outcomes.append(n)
        except VersionConflict:
            pass

    threads = [threading.Thread(target=write, args=(n,)) for n in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(outcomes) == 1
    assert list(log.latest().tables) == [f"t{outcomes[0]}"]
    assert [s.getPath().getName() for s in log._listed("_log") if not s.getPath().getName().endswith(".crc")] == [
        f"{1:020d}.json"
    ]


def test_earlier_versions_can_be_read(spark):
    star = store(spark)
    star.load(first(spark), "1")
    one = content(star)
    loaded = star.load(second(spark), "2")
    assert loaded.version == 2 and loaded.rows["facts"] == 1 and loaded.rows["rejects"] == 1
    assert loaded.members == {"person": 1, "place": 1}
    assert content(star, 1) == one
    star.log.vacuum(keep=2, older_than=0)
    assert content(star, 1) == one
    star.reset(second(spark), "3")
    now = content(star)
    removed = star.log.vacuum(keep=1, older_than=3600)
    assert all(name.startswith("_log/") for name in removed)
    star.log.vacuum(keep=1, older_than=0)
    assert content(star) == now and star.log.versions() == [3]


def test_runs_are_any_text(spark):
    star = store(spark)
    for run in ("007", "a/b=c %", "ü"):
        star.load(second(spark), run)
    assert {r["run"] for r in star.table("facts").collect()} == {"007", "a/b=c %", "ü"}
    assert Table("{}", (Part("x", 3, "1"), Part("y", 4, "2"))).with_run(Part("z", 1, "1")).rows == 5
