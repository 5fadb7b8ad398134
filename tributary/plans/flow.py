"""The daily batch: sources to consolidated table to validated star."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tributary.operators import quality
from tributary.operators.profile import duplicate_count, watch
from tributary.operators.star import Dimension, StarStore
from tributary.plans import vocabulary as v
from tributary.plans.recipes import Recipe, consolidated
from tributary.sources.files import read_parquet, write_parquet

STAR = (
    Dimension("person", "id_person", ("sex", "ethnic_group", "age_range")),
    Dimension("victimizing_act", "id_act", ("victimization_fact",)),
    Dimension("location", "id_location", ("state_dept",)),
)


# What every batch must obey, whatever the batches before it held. Rules that
# are stored take the place of these.
CONTRACT = [
    ("row_count", None, "row_count", "1", None, None),
    ("source: null_share", "source", "null_share", "0.0", "0.0", None),
    (f"{v.MEASURE}: null_share", v.MEASURE, "null_share", "0.0", "0.0", None),
    (f"{v.MEASURE}: range", v.MEASURE, "range", "0", None, None),
    *[(f"{c}: length", c, "length", "1", "100", None) for c in v.GRAIN if c not in (v.DATE, "year", "month")],
]


def star_store(spark: SparkSession, path: str) -> StarStore:
    return StarStore(
        spark,
        path,
        STAR,
        v.DATE,
        (v.MEASURE, "source"),
        integers=(v.MEASURE,),
        not_null=(v.MEASURE, "source"),
        check=f"{v.MEASURE} >= 0",
    )


@dataclass(frozen=True)
class FlowPaths:
    """Where one flow keeps its tables, on storage all executors share."""

    consolidated: str
    rules: str
    outcomes: str
    star: str


def run_flow(
    spark: SparkSession,
    sources: Sequence[tuple[DataFrame, Recipe]],
    paths: FlowPaths,
    run: str,
    reference: DataFrame | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Harmonise, consolidate, validate and load: (outcome, rows at every step).

    The consolidated table is written once and read by validation and load, so a
    restart need not repeat the sources. Rules are the stored ones; if there are
    none, those inferred from ``reference`` (with options of ``infer_rules``),
    or else the contract; never those of the batch itself. A broken rule stops
    the flow before the load; its outcome is stored either way.
    """
    seen = [(recipe.tag, *watch(df, f"{run} {i}")) for i, (df, recipe) in enumerate(sources)]
    watched = [(df, recipe) for (_, df, _), (_, recipe) in zip(seen, sources, strict=True)]
    write_parquet(consolidated(watched), paths.consolidated)
    table = read_parquet(spark, paths.consolidated, "consolidated")
    rules = quality.load_rules(spark, paths.rules)
    if rules is None and reference is None:
        rules = spark.createDataFrame(CONTRACT, quality.RULES)
    elif rules is None:
        rules = quality.load_or_infer(reference, paths.rules, **options)
    outcome = quality.settled(quality.validate(table, rules))
    quality.save_outcome(outcome, paths.outcomes, run)
    quality.require_valid(outcome)
    store = star_store(spark, paths.star)
    loaded = store.load(table, run)
    counts = [(f"read {tag}", observed.get["n_rows"], None) for tag, _, observed in seen]
    found = duplicate_count(table, v.GRAIN).first()
    counts.append(("consolidated", found["n_rows"], found["n_duplicates"]))
    counts += [(name, loaded.rows[name], None) for name in ("facts", "rejects")]
    return outcome, spark.createDataFrame(counts, "step string, n_rows long, n_duplicates long")
