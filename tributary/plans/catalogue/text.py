"""Text functions and recoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions.recode import code_label, recode
from tributary.functions.text import compact_range, fold, fold_literal, zero_pad
from tributary.operators import clean
from tributary.plans import vocabulary as v
from tributary.plans.catalogue.registry import case, listed, plant, planted, query, table, text

WHITE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def folded(column: str) -> str:
    return f"regexp_replace(lower(strip_accents({column})), '^{WHITE}+|{WHITE}+$', '', 'g')"


@query("normalize_text", f"SELECT doc_id, {folded('text')} AS folded, lang FROM documents")
def normalize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fold(F.col("text")).alias("folded"), "lang")


RARE = ["㎏", "가", "각하", "㍿", "ﷲ", "x"]
RARE_FOLDED = [fold_literal(c) for c in RARE]


@query(
    "normalize_text_exact",
    f"""
    SELECT doc_id, {folded("(text || '|')")} || {planted("doc_id", RARE_FOLDED)} AS folded FROM documents
    """,
)
def normalize_text_exact(spark, sf):
    """Texts that end with a character that folds to several ones."""
    rare = F.concat("text", F.lit("|"), plant("doc_id", RARE))
    return table(spark, sf, "documents").select("doc_id", fold(rare).alias("folded"))


REPLIES = ["Sí", "NO", " tal vez ", "Ñandú"]


@query(
    "normalize_text_conditional",
    f"""
    SELECT p_partkey, p_name, lower(p_brand) AS p_brand, {folded(planted("p_partkey", REPLIES))} AS reply,
           {planted("p_partkey", ["sí", "otro día"])} AS small
    FROM part
    """,
)
def normalize_text_conditional(spark, sf):
    """Columns with capitals are folded; all-lower ones keep their accents."""
    part = table(spark, sf, "part").select(
        "p_partkey",
        "p_name",
        "p_brand",
        plant("p_partkey", REPLIES).alias("reply"),
        plant("p_partkey", ["sí", "otro día"]).alias("small"),
    )
    return clean.fold_text(part, only_if_needed=True)


RAW_STATUS = ["no registra", "nd", "", None, "nan", "none", "pagado", "no informado", "sin definir"]


@query(
    "canonical_unknown",
    f"""
    SELECT o_orderkey,
           CASE WHEN s IS NULL OR s IN ({listed(v.UNKNOWN_VARIANTS_NATIONAL)})
                THEN {text(v.UNKNOWN)} ELSE s END AS status,
           COALESCE(f, {text(v.NOT_REGISTERED)}) AS filled
    FROM (SELECT o_orderkey, {planted("o_orderkey", RAW_STATUS)} AS s,
                 {planted("o_custkey", ["a", None, "b"])} AS f FROM orders)
    """,
)
def canonical_unknown(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey",
        plant("o_orderkey", RAW_STATUS).alias("status"),
        plant("o_custkey", ["a", None, "b"]).alias("filled"),
    )
    labelled = clean.unify_unknown(raw, v.UNKNOWN_VARIANTS_NATIONAL, v.UNKNOWN, ["status"])
    return labelled.na.fill(v.NOT_REGISTERED, ["filled"])


ETHNIC = list(v.ETHNIC_GROUP_NATIONAL) + ["ninguna", None]
FACTS = list(v.FACT_REPAIRS) + ["homicidio", None]


@query(
    "recode_map",
    f"""
    SELECT event_id, {case("e", v.ETHNIC_GROUP_NATIONAL, "e")} AS ethnic_group,
           {case("f", v.FACT_REPAIRS, "f")} AS fact,
           {case("event_type", {"click": "visit", "view": "visit"}, "event_type")} AS kind
    FROM (SELECT event_id, event_type, {planted("event_id", ETHNIC)} AS e,
                 {planted("user_id", FACTS)} AS f FROM events)
    """,
)
def recode_map(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        recode(plant("event_id", ETHNIC), v.ETHNIC_GROUP_NATIONAL).alias("ethnic_group"),
        recode(plant("user_id", FACTS), v.FACT_REPAIRS).alias("fact"),
        recode(F.col("event_type"), {"click": "visit", "view": "visit"}).alias("kind"),
    )


CODES = ["1", "5", " 6 ", "20", "16", "x", None, "7.0", "7.5"]


@query(
    "code_lookup",
    f"""
    SELECT p_partkey, {case("p_size", v.FACT_CODES)} AS by_number,
           {case("TRY_CAST(c AS DOUBLE)", v.FACT_CODES)} AS by_text
    FROM (SELECT *, {planted("p_partkey", CODES)} AS c FROM part)
    """,
)
def code_lookup(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        code_label(F.col("p_size"), v.FACT_CODES).alias("by_number"),
        code_label(plant("p_partkey", CODES), v.FACT_CODES).alias("by_text"),
    )


@query(
    "coalesce_fallback",
    f"""
    SELECT event_id, COALESCE({planted("event_id", ["homicidio", None, None])},
                              {case("user_id % 21", v.FACT_CODES)}) AS fact
    FROM events
    """,
)
def coalesce_fallback(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.coalesce(
            plant("event_id", ["homicidio", None, None]),
            code_label(F.col("user_id") % 21, v.FACT_CODES),
        ).alias("fact"),
    )


@query(
    "range_label_compact",
    """
    SELECT p_partkey,
           trim(replace(replace(replace(raw, 'entre', ''), 'y', '-'), ' - ', '-')) AS compact,
           trim(replace(regexp_replace(replace(raw, 'entre', ''), '\\by\\b', '-', 'g'), ' - ', '-'))
               AS connector
    FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 THEN 'mayor de ' || p_size
                                 ELSE 'entre ' || p_size || ' y ' || (p_size + 9) END AS raw FROM part)
    """,
)
def range_label_compact(spark, sf):
    size = F.col("p_size")
    raw = F.when(
        F.col("p_partkey") % 5 == 4, F.concat(F.lit("mayor de "), size.cast("string"))
    ).otherwise(F.concat(F.lit("entre "), size.cast("string"), F.lit(" y "), (size + 9).cast("string")))
    return table(spark, sf, "part").select(
        "p_partkey",
        compact_range(raw).alias("compact"),
        compact_range(raw, connector_only=True).alias("connector"),
    )


SIGNED = ["5", "-5", "0", "sin informacion", None, "42", ""]


@query(
    "zero_pad",
    f"""
    SELECT c_custkey,
           CASE WHEN length(n) < 2 THEN lpad(n, 2, '0') ELSE n END AS padded,
           CASE WHEN s IS NULL THEN NULL WHEN length(s) >= 3 THEN s
                WHEN s[1] = '-' THEN '-' || lpad(s[2:], 2, '0') ELSE lpad(s, 3, '0') END AS signed
    FROM (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS n, {planted("c_custkey", SIGNED)} AS s
          FROM customer)
    """,
)
def zero_pad_query(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        zero_pad(F.col("c_nationkey"), 2).alias("padded"),
        zero_pad(plant("c_custkey", SIGNED), 3).alias("signed"),
    )


RAW_CODES = [*v.DEPARTMENTS, "5", "8", "0", "00", "42", "nan", None, "sin informacion", "-5", "5.0"]
RAW_NAMES = [
    *v.DEPARTMENTS.values(), "sin definir", "sin informacion", "nan", None, "atlantida", "none",
    "sin informacion",
]
DEPT_NAMES = {name: code for code, name in v.DEPARTMENTS.items()}
U = text(v.UNKNOWN)

RECONCILE_SQL = f"""
WITH raw AS (
  SELECT o_orderkey, {planted("o_orderkey", RAW_CODES)} AS c, {planted("o_custkey", RAW_NAMES)} AS n
  FROM orders
), known AS (
  SELECT o_orderkey,
         CASE WHEN c IS NULL OR p IN ({listed(v.NO_DEPARTMENT_CODE)}) THEN {U} ELSE p END AS c,
         CASE WHEN n IS NULL OR n IN ({listed(v.NO_DEPARTMENT_NAME)}) THEN {U} ELSE n END AS n
  FROM (SELECT *, CASE WHEN length(c) < 2 THEN lpad(c, 2, '0') ELSE c END AS p FROM raw)
), coded AS (
  SELECT o_orderkey, n, CASE WHEN c = {U} AND n <> {U} THEN {case("n", DEPT_NAMES)} ELSE c END AS c
  FROM known
), named AS (
  SELECT o_orderkey, c,
         CASE WHEN n = {U} AND c <> {U} THEN {case("c", v.DEPARTMENTS)} ELSE n END AS n
  FROM coded
)
SELECT o_orderkey,
       CASE WHEN c IN ({listed(list(v.DEPARTMENTS))}) THEN c ELSE {U} END AS cod_estado_depto,
       CASE WHEN n IN ({listed(list(v.DEPARTMENTS.values()))}) THEN n ELSE {U} END AS state_dept
FROM named
"""


@query("code_name_reconcile", RECONCILE_SQL)
def code_name_reconcile(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey",
        plant("o_orderkey", RAW_CODES).alias("cod_estado_depto"),
        plant("o_custkey", RAW_NAMES).alias("state_dept"),
    )
    return clean.reconcile_code_name(
        raw, "cod_estado_depto", "state_dept", v.DEPARTMENTS, v.UNKNOWN,
        v.NO_DEPARTMENT_CODE, v.NO_DEPARTMENT_NAME,
    )
