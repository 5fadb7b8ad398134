"""Consolidation that carries on: a day reads its own rows and what earlier days left.

Every run leaves a partial aggregate, a row per key; the total over all runs is stored
beside them. A new run is added to the total. A run that is repeated is first taken
out: subtracted where sums are whole numbers or decimals; where they are doubles, whose
subtraction would leave rounding behind, the keys it touched are summed again from the
partials. Keys no run has rows of disappear. Partials and total change in one version,
so a run that dies in between leaves both as they were.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from tributary.operators.keys import null_safe_match
from tributary.session import remove_path
from tributary.sources.versions import VersionLog

SUM, VALUES, ROWS = "__sum", "__values", "__rows"


@dataclass(frozen=True)
class Carried:
    """A consolidated table below one shared path: sums of ``measure`` per key."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    measure: str

    @property
    def log(self) -> VersionLog:
        return VersionLog(self.spark, self.path)

    def _partial(self, df: DataFrame) -> DataFrame:
        kind = df.schema[self.measure].dataType
        total = "long" if isinstance(kind, IntegralType) else "double"
        if isinstance(kind, DecimalType):
            total = f"decimal(38,{kind.scale})"
        return df.groupBy(*self.keys).agg(
            F.sum(self.measure).cast(total).alias(SUM),
            F.count(self.measure).alias(VALUES),
            F.count(F.lit(1)).alias(ROWS),
        )

    def _merged(self, partials: DataFrame) -> DataFrame:
        kind = partials.schema[SUM].dataType
        sums = [F.sum(SUM).cast(kind).alias(SUM), *[F.sum(c).alias(c) for c in (VALUES, ROWS)]]
        return partials.groupBy(*self.keys).agg(*sums).filter(F.col(ROWS) > 0)

    def _replaced(self, total: DataFrame, old: DataFrame, new: DataFrame, partials: DataFrame) -> DataFrame:
        """The total with a run's old rows out and its new ones in."""
        columns = [*self.keys, SUM, VALUES, ROWS]
        if partials.schema[SUM].dataType.simpleString() != "double":
            out = old.select(*self.keys, *[(-F.col(c)).alias(c) for c in (SUM, VALUES, ROWS)])
            return self._merged(total.select(columns).unionByName(out).unionByName(new.select(columns)))
        touched = old.select(*self.keys).unionByName(new.select(*self.keys)).distinct()
        rest = total.join(touched, null_safe_match(total, touched, self.keys), "left_anti")
        again = partials.join(touched, null_safe_match(partials, touched, self.keys), "left_semi")
        return rest.select(columns).unionByName(self._merged(again).select(columns))

    def add(self, df: DataFrame, run: str) -> int:
        """Adds a run, or replaces it; the version made. An empty run takes its rows out."""
        log, load = self.log, uuid.uuid4().hex
        base = log.latest()
        try:
            staged, _ = log.stage(self._partial(df), "partials", load, run)
            new = log.read("partials", staged)
            if not base.version:
                partials, total = staged, self._merged(new)
            else:
                before = base.tables["partials"]
                partials = before.with_run(staged.parts[0])
                total = log.read("total", base.tables["total"])
                old = [p for p in before.parts if p.run == run]
                if old:
                    total = self._replaced(
                        total, log.read("partials", type(before)(before.schema, tuple(old))), new,
                        log.read("partials", partials),
                    )
                else:
                    total = self._merged(total.unionByName(new.drop("run")))
            return log.commit(base, {"partials": partials, "total": log.stage(total, "total", load)[0]}).version
        except BaseException:
            for name in ("partials", "total"):
                remove_path(self.spark, f"{self.path}/{name}/load={load}")
            raise

    def table(self) -> DataFrame:
        """One row per key of all runs; a key without any value sums to 0."""
        total = self.log.read("total", self.log.latest().tables["total"])
        return total.select(*self.keys, F.coalesce(SUM, F.lit(0)).alias(self.measure))
