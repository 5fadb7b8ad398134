"""Rules inferred from a table, validation, and key checks.

A rule is a row ``(rule, column, kind, low, high, member)``; bounds are kept as
text in the column's own type, so the table can be stored as JSON. A value set
is as many rows as it has members.

Kinds: ``row_count`` (table), ``null_share`` (NaN counts as null), ``range``
(numbers, dates), ``length`` (text), ``value_set`` (the columns named as domains);
from the history of ``states``: ``type`` (the member), ``distinct_count`` (estimated)
and ``quantile`` (approximate; the member is its fraction).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    FractionalType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tributary.functions.numbers import finite
from tributary.functions.recode import literal
from tributary.operators.keys import null_safe_match
from tributary.operators.profile import long_form
from tributary.session import path_exists
from tributary.sources.files import read_runs, write_run

RULES = "rule string, column string, kind string, low string, high string, member string"


def _ordered(df: DataFrame) -> list[str]:
    kinds = (NumericType, DateType, TimestampType, TimestampNTZType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def _missing(df: DataFrame, column: str) -> str:
    floating = isinstance(df.schema[column].dataType, FractionalType) and not isinstance(
        df.schema[column].dataType, DecimalType
    )
    name = f"`{column}`"
    return f"({name} IS NULL OR isnan({name}))" if floating else f"({name} IS NULL)"


def infer_rules(
    df: DataFrame,
    domains: Sequence[str] = (),
    open_above: Sequence[str] = (),
    tolerance: float = 0.0,
) -> DataFrame:
    """Rules that hold for a table, which should be another one than is validated.

    One aggregate yields counts, nulls, extremes and lengths of all columns. The
    columns named in ``domains`` get their values as a rule, however many there
    are. Columns in ``open_above`` have no upper bound; null shares may grow by
    ``tolerance``. NaN and infinities bound nothing.
    """
    ordered, texts = _ordered(df), _texts(df)
    checked = ordered + texts
    stats = [F.count("*").alias("rows")]
    stats += [F.expr(f"count_if({_missing(df, c)})").alias(f"null {c}") for c in checked]
    for c in ordered:
        floating = isinstance(df.schema[c].dataType, (FloatType, DoubleType))
        value = finite(F.col(c)) if floating else F.col(c)
        stats += [
            F.min(value).cast("string").alias(f"min {c}"),
            F.max(value).cast("string").alias(f"max {c}"),
        ]
    for c in texts:
        size = F.length(c)
        stats += [F.min(size).cast("string").alias(f"min {c}"), F.max(size).cast("string").alias(f"max {c}")]
    found = df.agg(*stats).first()

    rows = [("row_count", None, "row_count", "1", None, None)]
    for c in checked:
        share = found[f"null {c}"] / found["rows"] if found["rows"] else 0.0
        rows.append((f"{c}: null_share", c, "null_share", "0.0", str(min(1.0, share + tolerance)), None))
    for kind, names in (("range", ordered), ("length", texts)):
        for c in names:
            if found[f"min {c}"] is not None:
                low, high = found[f"min {c}"], None if c in open_above else found[f"max {c}"]
                rows.append((f"{c}: {kind}", c, kind, low, high, None))
    rules = df.sparkSession.createDataFrame(rows, RULES)
    if not domains:
        return rules
    members = long_form(df, list(domains)).filter("value IS NOT NULL").distinct()
    none = F.lit(None).cast("string")
    return rules.unionByName(
        members.select(
            F.concat("column", F.lit(": value_set")).alias("rule"),
            "column",
            F.lit("value_set").alias("kind"),
            none.alias("low"),
            none.alias("high"),
            F.col("value").alias("member"),
        )
    )


def _outcome(df: DataFrame, rule: Row) -> tuple[str, str]:
    """SQL aggregates (observed, ok) of one rule without members."""
    name, kind = f"`{rule['column']}`", rule["kind"]
    if kind == "row_count":
        bounds = [("count(*) >= ", rule["low"]), ("count(*) <= ", rule["high"])]
        return "count(*)", " AND ".join(text + b for text, b in bounds if b is not None)
    if rule["column"] not in df.columns:
        return "max('no such column')", "bool_and(false)"
    if kind == "null_share":
        share = f"coalesce(try_divide(count_if({_missing(df, rule['column'])}), count(*)), 0D)"
        return share, f"{share} <= {float(rule['high'])!r}D"
    if kind == "type":
        held = df.schema[rule["column"]].dataType.simpleString()
        same = str(held == rule["member"]).lower()
        return f"coalesce(max({literal(held)}), {literal(held)})", f"coalesce(bool_and({same}), {same})"
    if kind in ("distinct_count", "quantile"):
        values = f"CASE WHEN NOT {_missing(df, rule['column'])} THEN {name} END"
        seen = f"hll_sketch_estimate(hll_sketch_agg(string({values}), 12))"
        if kind == "quantile":
            seen = f"percentile_approx(double({values}), {float(rule['member'])!r}D, 10000)"
        return seen, f"{seen} BETWEEN {float(rule['low'])!r}D AND {float(rule['high'])!r}D"
    cast = "int" if kind == "length" else df.schema[rule["column"]].dataType.simpleString()
    value = f"length({name})" if kind == "length" else name
    outside = [
        f"{value} {sign} cast({literal(rule[end])} AS {cast})"
        for end, sign in (("low", "<"), ("high", ">"))
        if rule[end] is not None
    ]
    broken = f"count_if({' OR '.join(outside) or 'false'})"
    return broken, f"{broken} = 0"


def _strangers(df: DataFrame, sets: DataFrame) -> DataFrame:
    """Outcome of the value sets: rows whose value is no member.

    Values are counted before they meet the members.
    """
    named = sets.select("rule", "column", "kind").distinct()
    columns = [r["column"] for r in named.select("column").distinct().collect()]
    there = [c for c in columns if c in df.columns]
    absent = F.array(*[F.lit(c) for c in columns if c not in there]).cast("array<string>")
    outcome = named.withColumn("absent", F.array_contains(absent, F.col("column")))
    strange = F.lit(0).cast("long")
    if there:
        cells = long_form(df, there).filter("value IS NOT NULL")
        counted = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
        members = sets.select("column", F.col("member").alias("value"))
        loose = counted.join(members, ["column", "value"], "left_anti")
        outcome = outcome.join(loose.groupBy("column").agg(F.sum("n").alias("n")), "column", "left")
        strange = F.coalesce("n", F.lit(0))
    return outcome.select(
        "rule",
        "column",
        "kind",
        F.when(F.col("absent"), F.lit("no such column")).otherwise(strange.cast("string")).alias("observed"),
        (~F.col("absent") & (strange == 0)).alias("ok"),
    )


def validate(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Outcome of every rule: (rule, column, kind, observed, ok).

    All rules but value sets are evaluated by one aggregate over the table, value
    sets by one more. ``observed`` is the row count, the null share, or the
    number of rows that break the rule.
    """
    checks, cells = [], []
    for i, rule in enumerate(rules.filter("kind <> 'value_set'").collect()):
        observed, ok = _outcome(df, rule)
        checks += [F.expr(f"string({observed}) AS seen{i}"), F.expr(f"coalesce({ok}, false) AS ok{i}")]
        named = ", ".join(f"string({literal(rule[c])}) AS {c}" for c in ("rule", "column", "kind"))
        cells.append(f"struct({named}, seen{i} AS observed, ok{i} AS ok)")
    sets = rules.filter("kind = 'value_set'")
    some_sets = not sets.isEmpty()
    if not cells:
        return _strangers(df, sets)
    outcome = df.agg(*checks).selectExpr(f"inline(array({', '.join(cells)}))")
    return outcome.unionByName(_strangers(df, sets)) if some_sets else outcome


def settled(outcome: DataFrame) -> DataFrame:
    """An outcome computed once, so that storing and judging it scan nothing again."""
    return outcome.sparkSession.createDataFrame(outcome.collect(), outcome.schema)


class ValidationFailed(ValueError):
    """At least one rule is broken."""


def require_valid(outcome: DataFrame) -> None:
    """Stop unless every rule holds."""
    broken = outcome.filter(~F.col("ok")).select("rule", "observed").collect()
    if broken:
        listed = "; ".join(f"{r['rule']} ({r['observed']})" for r in broken)
        raise ValidationFailed(f"{len(broken)} rules broken: {listed}")


def save_rules(rules: DataFrame, path: str) -> None:
    """Store rules, replacing those stored before."""
    rules.coalesce(1).write.mode("overwrite").json(path)


def load_rules(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.schema(RULES).json(path) if path_exists(spark, path) else None


def load_or_infer(reference: DataFrame, path: str, **options) -> DataFrame:
    """The stored rules; only if none are stored, those of ``reference``, stored now.

    The options are those of ``infer_rules``.
    """
    spark = reference.sparkSession
    stored = load_rules(spark, path)
    if stored is None:
        save_rules(infer_rules(reference, **options), path)
        stored = load_rules(spark, path)
    return stored


def save_outcome(outcome: DataFrame, path: str, run: str) -> None:
    """Keep the outcome of a run in the result store; a repeated run replaces its own."""
    write_run(outcome, path, run)


def load_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """The outcomes of all runs kept."""
    return read_runs(spark, path)


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that are null or occur more than once, with their row count."""
    missing = F.lit(False)
    for c in key:
        missing = missing | F.col(c).isNull()
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | missing)


def fk_violations(
    fact: DataFrame, dims: Sequence[tuple[str, DataFrame, str]]
) -> DataFrame:
    """Fact values without a row in the dimension: (foreign_key, value, n).

    Values are counted before the anti join, so a hot or dangling key reaches
    the join as one row. Null foreign keys pass.
    """
    parts = []
    for column, dim, key in dims:
        used = fact.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        keys = dim.select(F.col(key).alias(column))
        loose = used.join(keys, null_safe_match(used, keys, [column]), "left_anti")
        parts.append(
            loose.select(
                F.lit(column).alias("foreign_key"), F.col(column).cast("string").alias("value"), "n"
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def check_violations(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that break a check; an unknown outcome passes, as in SQL."""
    return df.filter(~condition)
