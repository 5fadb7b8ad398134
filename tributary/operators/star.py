"""Star schema: extract, dimensions, facts, incremental and repeatable loads."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tributary.operators.clean import split_rows
from tributary.operators.keys import (
    SMALL_ROWS,
    Numbered,
    attach_number,
    null_safe_match,
    number_distinct,
)
from tributary.operators.skew import attach_number_split, frequent_hashes
from tributary.session import remove_path, shared_dir
from tributary.sources.files import SourceMissing
from tributary.sources.versions import Snapshot, Table, VersionConflict, VersionLog


@dataclass(frozen=True)
class Dimension:
    """A dimension of a star: its table name, id column and natural key."""

    name: str
    id: str
    columns: Sequence[str]


def star_join(
    fact: DataFrame,
    dims: Sequence[tuple[DataFrame, str, str]],
    how: str = "inner",
) -> DataFrame:
    """Join dimensions ``(table, key in fact, key in table)`` to a fact.

    Unhinted: a dimension is broadcast when its size is under the session's
    threshold, at planning or at run time; beyond it Spark sorts and merges, and
    adaptive execution splits hot keys.
    """
    for dim, fact_key, dim_key in dims:
        renamed = f"__dim_{dim_key}"
        side = dim.withColumnRenamed(dim_key, renamed)
        fact = fact.join(side, F.col(fact_key) == F.col(renamed), how).drop(renamed)
    return fact


def build_dimension(df: DataFrame, dim: Dimension) -> Numbered:
    """Distinct natural keys with surrogate ids 1..n."""
    return number_distinct(df, dim.columns, dim.id)


ROWS = "__rows"


def dimension_rows(df: DataFrame, dims: Sequence[Dimension], *more: str) -> DataFrame:
    """The stored combinations of all natural keys (and more columns), with their row counts.

    One pass over the input from which every dimension can be made.
    """
    columns = list(dict.fromkeys([*(c for dim in dims for c in dim.columns), *more]))
    shared_dir(df.sparkSession)
    return df.groupBy(*columns).agg(F.count("*").alias(ROWS)).checkpoint()


def build_dimensions(
    df: DataFrame, dims: Sequence[Dimension]
) -> list[tuple[Dimension, Numbered]]:
    """Several dimensions from one pass over the input.

    The combinations of all natural keys are stored first, unless ``df`` is what
    ``dimension_rows`` made; each dimension is then made from them.
    """
    stored = df if ROWS in df.columns else dimension_rows(df, dims)
    return [(dim, build_dimension(stored, dim)) for dim in dims]


def date_dimension(df: DataFrame, column: str) -> DataFrame:
    """Distinct dates with year and month; the date is its own key, null has no row."""
    day = F.to_date(column)
    return (
        df.select(day.alias(column))
        .filter(F.col(column).isNotNull())
        .distinct()
        .select(column, F.year(column).alias("year"), F.month(column).alias("month"))
    )


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing rows plus incoming rows whose key is new; one row per new key.

    Of several incoming rows with one key the smallest is kept. They are reduced
    before the join, so a hot key reaches it as one row.
    """
    rest = [c for c in incoming.columns if c not in key]
    single = incoming.select(*key).distinct()
    if rest:
        single = incoming.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__row"))
        single = single.select(*key, "__row.*")
    fresh = single.join(existing, null_safe_match(single, existing, key), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def new_members(
    existing: DataFrame, df: DataFrame, dim: Dimension, highest: int | None = None
) -> Numbered:
    """Natural keys a stored dimension lacks, numbered from its highest id on.

    The highest id is looked up unless it is known.
    """
    incoming = df.select(*dim.columns).distinct()
    fresh = incoming.join(
        existing, null_safe_match(incoming, existing, dim.columns), "left_anti"
    )
    if highest is None:
        highest = existing.agg(F.coalesce(F.max(dim.id), F.lit(0))).scalar()
    return number_distinct(fresh, dim.columns, dim.id, start=highest + 1)


def extend_dimension(existing: DataFrame, df: DataFrame, dim: Dimension) -> DataFrame:
    """A stored dimension with the new members of a batch; ids already given stay."""
    return existing.select(dim.id, *dim.columns).unionByName(new_members(existing, df, dim).table)


def build_fact(
    df: DataFrame,
    dims: Sequence[tuple[Dimension, DataFrame]],
    date: str,
    measures: Sequence[str],
    integers: Sequence[str] = (),
    hot: Mapping[str, Sequence[int]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fact rows with surrogate keys, and the rows rejected for lack of a date.

    Every dimension is left-joined on its whole natural key with null matching
    null. Columns in ``integers`` are cut to whole numbers. ``hot`` names the
    frequent keys of dimensions whose join is to keep them apart.
    """
    dated, rejected = split_rows(df.withColumn(date, F.to_date(date)), F.col(date).isNotNull())
    for dim, table in dims:
        if hot and hot.get(dim.name):
            dated = attach_number_split(dated, table, dim.columns, dim.id, hot[dim.name])
        else:
            dated = attach_number(dated, table, dim.columns, dim.id)
    cut = {c: F.col(c).try_cast("long") for c in integers}
    fact = dated.withColumns(cut) if cut else dated
    return fact.select(*[dim.id for dim, _ in dims], date, *measures), rejected


class ConstraintBroken(ValueError):
    """A batch breaks a constraint of the star it is loaded into."""


def together(*calls: Callable) -> list:
    """Results of calls whose small jobs run side by side; all have ended when one's error is raised."""
    with ThreadPoolExecutor(len(calls)) as pool:
        running = [pool.submit(call) for call in calls]
    return [one.result() for one in running]


@dataclass(frozen=True)
class Loaded:
    """What a load has stored: the version it made, rows by table, new members by dimension."""

    version: int
    rows: Mapping[str, int]
    members: Mapping[str, int]


@dataclass(frozen=True)
class StarStore:
    """A star kept as Parquet below one shared path, in whole versions.

    Dimensions only grow, by members not yet stored. Facts and rejects are kept per
    run, and a repeated run replaces its own, so loading a batch twice equals loading
    it once, and loading a mended batch leaves nothing of the first.

    A batch is checked before any of it is visible: ``not_null`` columns hold no
    null, natural keys are at most ``max_length`` characters long, ``check`` (an
    SQL condition on the batch) is not false, and every fact finds its dimensions.
    All tables of a load become visible by one commit; a load that fails or dies
    before it leaves the star as it was. Of two loads at once the second to commit
    starts anew from the other's version, ``attempts`` times at most, so no member
    is numbered twice.
    """

    spark: SparkSession
    path: str
    dims: Sequence[Dimension]
    date: str
    measures: Sequence[str]
    integers: Sequence[str] = field(default=())
    not_null: Sequence[str] = field(default=())
    max_length: int = 100
    check: str | None = None
    attempts: int = 3

    @property
    def log(self) -> VersionLog:
        return VersionLog(self.spark, self.path)

    def _read(self, snapshot: Snapshot, name: str) -> DataFrame:
        if name not in snapshot.tables:
            raise SourceMissing(f"[PATH_NOT_FOUND] version {snapshot.version} of {self.path} has no table '{name}'")
        return self.log.read(name, snapshot.tables[name])

    def table(self, name: str, version: int | None = None) -> DataFrame:
        """A table of the last version, or of an earlier one."""
        return self._read(self.log.latest() if version is None else self.log.at(version), name)

    def register_views(self) -> None:
        """Every table of one version of the star as a view of its name, for SQL reports."""
        snapshot = self.log.latest()
        for name in [dim.name for dim in self.dims] + ["dates", "facts"]:
            self._read(snapshot, name).createOrReplaceTempView(name)

    def violations(self, df: DataFrame) -> DataFrame:
        """Rows of the batch that break each constraint: (constraint, n), none left out."""
        texts = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
        keys = dict.fromkeys(c for dim in self.dims for c in dim.columns)
        broken = {f"not null: {c}": F.col(c).isNull() for c in self.not_null}
        broken |= {f"length: {c}": F.length(c) > self.max_length for c in keys if c in texts}
        if self.check:
            broken[f"check: {self.check}"] = ~F.expr(self.check)
        counts = [F.count_if(condition).alias(f"n{i}") for i, condition in enumerate(broken.values())]
        cells = [F.struct(F.lit(c).alias("constraint"), F.col(f"n{i}").alias("n")) for i, c in enumerate(broken)]
        return df.agg(*counts).select(F.inline(F.array(*cells)))

    def _require(self, df: DataFrame) -> None:
        if not any((self.not_null, self.dims, self.check)):
            return
        broken = self.violations(df).filter("n > 0").collect()
        if broken:
            listed = "; ".join(f"{r['constraint']} ({r['n']} rows)" for r in broken)
            raise ConstraintBroken(f"{len(broken)} constraints broken: {listed}")

    def _members(self, rows: DataFrame, dim: Dimension, stored: Table | None, load: str) -> Table:
        """A dimension with the batch's new members; ids are 1 to the number of members."""
        if stored is None:
            return self.log.stage(build_dimension(rows, dim).table, dim.name, load)[0]
        members = new_members(self.log.read(dim.name, stored), rows, dim, stored.rows)
        if not members.rows:
            return stored
        return stored.plus(*self.log.stage(members.table, dim.name, load)[0].parts)

    def _dates(self, rows: DataFrame, stored: Table | None, load: str) -> Table:
        dates = date_dimension(rows, self.date)
        if stored is None:
            return self.log.stage(dates, "dates", load)[0]
        fresh = dates.join(self.log.read("dates", stored), self.date, "left_anti")
        return stored.plus(*self.log.stage(fresh, "dates", load)[0].parts)

    def _stage_all(self, df: DataFrame, rows: DataFrame, run: str, base: Snapshot, load: str) -> dict[str, Table]:
        names = [*(dim.name for dim in self.dims), "dates"]
        staged = together(
            *[partial(self._members, rows, dim, base.tables.get(dim.name), load) for dim in self.dims],
            partial(self._dates, rows, base.tables.get("dates"), load),
        )
        tables = dict(zip(names, staged, strict=True))
        hot = {
            dim.name: frequent_hashes(rows, dim.columns, ROWS)
            for dim in self.dims
            if tables[dim.name].rows > SMALL_ROWS
        }
        dims = [(dim, self.log.read(dim.name, tables[dim.name])) for dim in self.dims]
        fact, rejected = build_fact(df, dims, self.date, self.measures, self.integers, hot)
        loose = [F.count_if(F.col(dim.id).isNull()).alias(dim.id) for dim in self.dims]
        (facts, seen), (rejects, _) = together(
            partial(self.log.stage, fact, "facts", load, run, loose),
            partial(self.log.stage, rejected, "rejects", load, run),
        )
        if missing := [dim.id for dim in self.dims if seen.get(dim.id)]:
            raise ConstraintBroken(f"facts without a dimension row: {', '.join(missing)}")
        for name, own in (("facts", facts), ("rejects", rejects)):
            tables[name] = base.tables[name].with_run(own.parts[0]) if name in base.tables else own
        return tables

    def _load(self, df: DataFrame, run: str, keep: bool) -> Loaded:
        self._require(df)
        rows = dimension_rows(df, self.dims, self.date)
        for attempt in range(1, self.attempts + 1):
            last, load = self.log.latest(), uuid.uuid4().hex
            base = last if keep else Snapshot(last.version)
            try:
                tables = self._stage_all(df, rows, run, base, load)
                version = self.log.commit(base, tables).version
            except BaseException as error:
                for name in [*(dim.name for dim in self.dims), "dates", "facts", "rejects"]:
                    remove_path(self.spark, f"{self.path}/{name}/load={load}")
                if isinstance(error, VersionConflict) and attempt < self.attempts:
                    continue
                raise
            own = {n: sum(p.rows for p in t.parts if p.load == load) for n, t in tables.items()}
            return Loaded(version, own, {dim.name: own[dim.name] for dim in self.dims})
        raise ValueError("attempts must be 1 or more")

    def load(self, df: DataFrame, run: str) -> Loaded:
        """Store a batch: new dimension members, dates, facts and rejected rows.

        The batch is read for its constraints, once for all dimensions and dates,
        for its facts, and for its undated rows only; it should be a stored one.
        """
        return self._load(df, run, keep=True)

    def reset(self, df: DataFrame, run: str) -> Loaded:
        """A star with nothing but this batch; if it cannot be loaded, the old one stays."""
        return self._load(df, run, keep=False)
