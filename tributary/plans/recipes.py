"""The three sources as parameters over shared operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.dates import mixed_timestamp, safe_timestamp
from tributary.functions.numbers import safe_number
from tributary.functions.recode import code_label, recode
from tributary.functions.text import compact_range
from tributary.operators import aggregate, clean, shape
from tributary.plans import vocabulary as v
from tributary.session import shared_dir


@dataclass(frozen=True)
class Recipe:
    """How one source becomes harmonised rows.

    Steps run in the order of the fields: names, constants, collapsing, folding,
    unknowns, code labels and fallbacks, reconciliation, recodes, range labels,
    typing, grouping. A step skips the columns a table lacks.
    """

    tag: str
    names: Callable[[DataFrame], DataFrame] | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    drops: Sequence[str] = ()
    constants: Mapping[str, str] = field(default_factory=dict)
    # For sources with a row per record: equal raw rows are counted first and
    # stored, so cleaning sees each combination once and no step reads the
    # source a second time.
    collapse: bool = False
    fold_only_if_needed: bool = False
    unknowns: Sequence[str] = tuple(v.UNKNOWN_VARIANTS)
    codes: Mapping[str, Mapping[int, str]] = field(default_factory=dict)
    fallbacks: Mapping[str, str] = field(default_factory=dict)
    # Unknowns are labelled before fallbacks, so a fallback reaches non-text
    # columns only; True lets it act on missing text as well.
    fallback_first: bool = False
    reconcile: Mapping[str, object] | None = None
    recodes: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    ranges: Sequence[str] = ()
    numbers: Sequence[str] = ()
    timestamp: Callable[[Column], Column] = mixed_timestamp
    measure: str | None = v.MEASURE

    def with_(self, **changes) -> Recipe:
        return replace(self, **changes)


CITY = Recipe(
    tag=v.TAGS[0],
    renames={"classification": "age_range"},
    drops=["total_victim"],
    constants={"state_dept": "valle del cauca"},
    collapse=True,
    fold_only_if_needed=True,
    recodes={
        "ethnic_group": v.ETHNIC_GROUP_CITY,
        "sex": v.SEX,
        "age_range": v.AGE_RANGE,
    },
    numbers=["vulnerability_index"],
    timestamp=lambda c: safe_timestamp(c, "yyyy-MM-dd[ HH:mm:ss]"),
    measure=None,
)

REGION = Recipe(
    tag=v.TAGS[1],
    names=shape.lower_names,
    renames=v.RENAMES,
    constants={"state_dept": "santander"},
    codes={"param_victimization_fact": v.FACT_CODES},
    fallbacks={"victimization_fact": "param_victimization_fact"},
    recodes={"victimization_fact": v.FACT_REPAIRS, "ethnic_group": v.ETHNIC_GROUP_REGION},
    ranges=["age_range"],
)

NATIONAL = Recipe(
    tag=v.TAGS[2],
    names=shape.fold_names,
    renames=v.RENAMES,
    unknowns=tuple(v.UNKNOWN_VARIANTS_NATIONAL),
    reconcile={
        "code": "cod_estado_depto",
        "name": "state_dept",
        "catalogue": v.DEPARTMENTS,
        "unknown": v.UNKNOWN,
        "no_code": v.NO_DEPARTMENT_CODE,
        "no_name": v.NO_DEPARTMENT_NAME,
    },
    recodes={"ethnic_group": v.ETHNIC_GROUP_NATIONAL},
    ranges=["age_range"],
)


WEIGHT = "rows"


def used_columns(recipe: Recipe) -> list[str]:
    """Columns that can reach the result, by their harmonised names."""
    extra = [*recipe.codes, *recipe.fallbacks.values()]
    if recipe.reconcile:
        extra += [recipe.reconcile["code"], recipe.reconcile["name"]]
    if recipe.measure:
        extra.append(recipe.measure)
    return list(dict.fromkeys([*v.GRAIN, *extra]))


def named_rows(df: DataFrame, recipe: Recipe) -> DataFrame:
    """A source's raw rows under harmonised names, tagged."""
    if recipe.names:
        df = recipe.names(df)
    df = shape.rename(df, recipe.renames)
    df = shape.drop(df, *recipe.drops)
    return shape.tag(shape.with_constants(df, recipe.constants), recipe.tag)


def clean_rows(df: DataFrame, recipe: Recipe) -> DataFrame:
    """A source's rows with harmonised names, labels and types, not yet grouped.

    Collapsed rows carry the number of raw rows they stand for.
    """
    df = named_rows(df, recipe)
    if recipe.collapse:
        # The year is derived from the date again; a raw one would split groups.
        derived = ["year", "month"] if v.DATE in df.columns else []
        columns = [c for c in used_columns(recipe) if c not in derived]
        shared_dir(df.sparkSession)
        df = aggregate.collapse(df, columns, WEIGHT).checkpoint()
    df = clean.fold_text(df, only_if_needed=recipe.fold_only_if_needed)
    if recipe.fallback_first:
        df = _label_codes(df, recipe)
        df = clean.unify_unknown(df, recipe.unknowns, v.UNKNOWN)
    else:
        df = clean.unify_unknown(df, recipe.unknowns, v.UNKNOWN)
        df = _label_codes(df, recipe)
    if recipe.reconcile:
        df = clean.reconcile_code_name(df, **recipe.reconcile)
    for column, mapping in recipe.recodes.items():
        df = shape.map_columns(df, [column], lambda c, m=mapping: recode(c, m))
    df = shape.map_columns(df, recipe.ranges, compact_range)
    df = shape.map_columns(df, recipe.numbers, safe_number)
    return _typed(df, recipe)


def _label_codes(df: DataFrame, recipe: Recipe) -> DataFrame:
    for column, mapping in recipe.codes.items():
        df = shape.map_columns(df, [column], lambda c, m=mapping: code_label(c, m))
    for column, other in recipe.fallbacks.items():
        if other in df.columns and column in df.columns:
            df = df.withColumn(column, F.coalesce(column, other))
    return df


def _typed(df: DataFrame, recipe: Recipe) -> DataFrame:
    if v.DATE in df.columns:
        df = df.withColumn(v.DATE, recipe.timestamp(F.col(v.DATE)))
        df = df.withColumns({"year": F.year(v.DATE), "month": F.month(v.DATE)})
    if recipe.measure:
        df = shape.map_columns(df, [recipe.measure], safe_number)
    return df


def apply_recipe(df: DataFrame, recipe: Recipe, flag_mode: str = "reference") -> DataFrame:
    """A source's rows harmonised and grouped: a count, or the sum of its measure."""
    rows = clean_rows(df, recipe)
    labels = (v.REPORTED, v.UNKNOWN)
    weight = WEIGHT if recipe.collapse else None
    if recipe.measure:
        return aggregate.group_sum(
            rows, v.GRAIN, recipe.measure, v.MEASURE, v.FLAG, labels, flag_mode, weight
        )
    counted = aggregate.group_count(rows, v.GRAIN, v.MEASURE, weight)
    return counted.withColumn(v.FLAG, F.lit(v.REPORTED))


def measured_rows(df: DataFrame, recipe: Recipe) -> DataFrame:
    """A source's cleaned rows with what each adds to the measure, not yet grouped."""
    rows = clean_rows(df, recipe)
    weight = F.col(WEIGHT) if recipe.collapse else F.lit(1)
    return rows.withColumn(v.MEASURE, F.col(recipe.measure) * weight if recipe.measure else weight)


def harmonise(sources: Sequence[tuple[DataFrame, Recipe]]) -> DataFrame:
    """All sources, each grouped, in one table of the harmonised schema."""
    return shape.union_conformed([apply_recipe(df, r) for df, r in sources], v.HARMONISED)


def consolidated(sources: Sequence[tuple[DataFrame, Recipe]]) -> DataFrame:
    """One row per distinct harmonised key over all sources.

    Equal to consolidating ``harmonise``, but the cleaned rows of all sources
    meet in one aggregate, so the data are shuffled once instead of twice.
    """
    rows = shape.union_conformed([measured_rows(df, r) for df, r in sources], v.HARMONISED)
    return aggregate.consolidate(rows, v.GRAIN, v.MEASURE)
