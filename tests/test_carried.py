import decimal
import random

import pytest

from tributary.operators.carried import Carried
from tributary.session import scratch_path
from tributary.sources.versions import VersionConflict, VersionLog

KEYS = ["place", "kind"]


def rows(spark, data, kind):
    return spark.createDataFrame(data, f"place string, kind int, n {kind}, other string")


def made(r, n, kind):
    number = {"long": int, "double": lambda x: x / 10, "decimal(9,2)": lambda x: decimal.Decimal(x) / 100}[kind]
    return [
        (r.choice(["p", "q", None]), r.choice([1, 2, None]), None if r.random() < 0.2 else number(r.randrange(-50, 900)), "x")
        for _ in range(n)
    ]


def recomputed(runs):
    groups = {}
    for data in runs.values():
        for place, kind, n, _ in data:
            groups.setdefault((place, kind), []).append(n)
    return {k: sum(n for n in ns if n is not None) for k, ns in groups.items()}


def found(store):
    return {(r.place, r.kind): r.n for r in store.table().collect()}


def same(got, want):
    assert got.keys() == want.keys()
    assert all(abs(float(got[k]) - float(want[k])) < 1e-9 for k in want)


@pytest.mark.parametrize("kind", ["long", "double", "decimal(9,2)"])
def test_equals_a_full_recomputation(spark, kind):
    """Runs added, repeated, mended, emptied, and a key that only one run ever had."""
    r = random.Random(kind)
    store = Carried(spark, scratch_path(spark, "carried"), KEYS, "n")
    runs = {}
    steps = [("1", 30), ("2", 20), ("1", 25), ("2", 0), ("3", 10), ("1", 0), ("2", 5)]
    for run, size in steps:
        runs[run] = made(r, size, kind)
        if run == "3":
            runs[run].append(("only here", 9, None, "x"))
        store.add(rows(spark, runs[run], kind), run)
        same(found(store), recomputed(runs))
    runs["3"] = []
    store.add(rows(spark, [], kind), "3")
    same(found(store), recomputed(runs))
    assert ("only here", 9) not in found(store)


def test_a_later_day_reads_its_rows_and_what_is_stored(spark, tmp_path):
    """The raw rows of day 1 may be gone by day 2."""
    store = Carried(spark, scratch_path(spark, "carried"), KEYS, "n")
    one, two = made(random.Random(1), 40, "long"), made(random.Random(2), 40, "long")
    path = str(tmp_path / "day-1")
    rows(spark, one, "long").write.parquet(path)
    store.add(spark.read.parquet(path), "1")
    for file in (tmp_path / "day-1").iterdir():
        file.unlink()
    store.add(rows(spark, two, "long"), "2")
    same(found(store), recomputed({"1": one, "2": two}))


def test_a_run_that_dies_changes_nothing(spark, monkeypatch):
    store = Carried(spark, scratch_path(spark, "carried"), KEYS, "n")
    one, two = made(random.Random(1), 20, "long"), made(random.Random(2), 20, "long")
    store.add(rows(spark, one, "long"), "1")
    before = found(store)

    def overtaken(self, base, tables):
        raise VersionConflict("overtaken")

    with monkeypatch.context() as patch:
        patch.setattr(VersionLog, "commit", overtaken)
        with pytest.raises(VersionConflict):
            store.add(rows(spark, two, "long"), "1")
    assert found(store) == before
    assert store.log.vacuum(keep=1, older_than=0) == []
