"""Whole recipes and flows.

The given tables play the three sources: order lines the relational star, events
the CSV with numeric counts, orders the paged national source. Labels, mixed
dates, junk and gaps are planted by key, in every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions.recode import band, lookup
from tributary.functions.text import label
from tributary.plans import flow, records
from tributary.plans import vocabulary as v
from tributary.plans.catalogue.registry import case, listed, longs, plant, planted, query, table, text
from tributary.plans.catalogue.scans import EXTRACT_SQL, extract
from tributary.plans.catalogue.typing import SPANISH, points_sql
from tributary.plans.recipes import CITY, NATIONAL, REGION, apply_recipe, consolidated
from tributary.session import scratch_path

# Raw labels, and what they become.
CITY_SEX = ["Masculino", "Femenino", None, "ND"]
CITY_SEX_CLEAN = ["hombre", "mujer", v.UNKNOWN, v.UNKNOWN]
CITY_ETHNIC = ["Afrodescendiente", "Negro", " Moreno", "Indígena", "No Registra", "Mestizo", None]
CITY_ETHNIC_CLEAN = [
    "afrocolombiano", "afrocolombiano", "afrocolombiano", "indigena", v.UNKNOWN, "mestizo", v.UNKNOWN,
]
CITY_FACT = {"1-URGENT": "Homicidio", "2-HIGH": "DESAPARICIÓN FORZADA", "3-MEDIUM": "Amenaza"}
CITY_FACT_CLEAN = {"1-URGENT": "homicidio", "2-HIGH": "desaparicion forzada", "3-MEDIUM": "amenaza"}

REGION_FACT = [
    "DesapariciÃ³n forzada",
    "Homicidio",
    "  AMENAZA ",
    None,
    "Acto terrorista / Atentados / Combates / Enfrentamientos / Hostigamientos",
    "Minas antipersonal, MuniciÃ³n sin explotar y Artefacto explosivo improvisado",
    "Desaparición Forzada",
]
REGION_FACT_CLEAN = [
    "desaparicion forzada",
    "homicidio",
    "amenaza",
    v.UNKNOWN,
    "acto terrorista/atentados/combates/enfrentamientos/hostigamientos",
    "minas antipersonal, municion sin explotar y artefacto explosivo improvisado",
    "desaparicion forzada",
]
REGION_SEX = ["Hombre", "Mujer ", "nd", None]
REGION_SEX_CLEAN = ["hombre", "mujer", v.UNKNOWN, v.UNKNOWN]
REGION_ETHNIC = [
    "Indígena (Acreditado RA)", "Negro(a) o Afrocolombiano(a)", "Gitano(a) ROM", "Ninguna",
    "Raizal del Archipiélago de San Andrés y Providencia",
]
REGION_ETHNIC_CLEAN = ["indigena", "afrocolombiano", "rom", "ninguna", "raizal"]
REGION_AGE = ["entre 6 y 11", "ENTRE 61 Y 100", "ND", None, "entre 0 y 5"]
REGION_AGE_CLEAN = ["6-11", "61-100", v.UNKNOWN, v.UNKNOWN, "0-5"]
REGION_COUNT = ["7", " 7 ", "7.0", "nan", "5d", None, "12"]
REGION_COUNT_CLEAN = [7, 7, 7, 0, 0, 0, 12]

NATIONAL_CODES = [*v.DEPARTMENTS, "5", "8", "0", "00", "42", "NaN", None, "Sin Informacion"]
NATIONAL_CODES_CLEAN = [*v.DEPARTMENTS, "05", "08", *[v.UNKNOWN] * 6]
NATIONAL_NAMES = ["Antioquia", "BOGOTÁ, D.C.", "Sin definir", "Atlántida", None, "Nariño", "Quindío"]
NATIONAL_NAMES_KNOWN = ["antioquia", "bogota, d.c.", v.UNKNOWN, "atlantida", v.UNKNOWN, "narino", "quindio"]
NATIONAL_ETHNIC = [
    "Palenquero (Acreditado RA)", "Gitano (RROM) (Acreditado RA)", "Indígena", "No Informado",
]
NATIONAL_ETHNIC_CLEAN = ["palenquero", "rom", "indigena", v.UNKNOWN]

STAMP = "yyyy-MM-dd HH:mm:ss"
GRAIN_SQL = ", ".join(v.GRAIN)


def city_raw(spark, sf):
    key = "l_orderkey"
    flat = extract(spark, sf)
    return flat.select(
        F.col("l_linenumber").cast("string").alias("vulnerability_index"),
        F.lit(1).alias("total_victim"),
        plant(key, CITY_SEX).alias("sex"),
        plant(key, CITY_ETHNIC).alias("ethnic_group"),
        band(F.col("l_quantity"), v.AGE_EDGES, v.AGE_LABELS).alias("classification"),
        lookup(F.col("o_orderpriority"), CITY_FACT).alias("victimization_fact"),
        F.col("r_name").alias("commune"),
        F.when(F.col(key) % 10 != 9, F.date_format("order_date", "yyyy-MM-dd")).alias(v.DATE),
        "order_year",
        "source",
    )


CITY_SQL = f"""
SELECT {GRAIN_SQL}, COUNT(*)::DOUBLE AS total_victim FROM (
  SELECT CASE WHEN l_orderkey % 10 <> 9 THEN order_date::TIMESTAMP END AS date_processing,
         year(CASE WHEN l_orderkey % 10 <> 9 THEN order_date END) AS year,
         month(CASE WHEN l_orderkey % 10 <> 9 THEN order_date END) AS month,
         'valle del cauca' AS state_dept,
         {case("o_orderpriority", CITY_FACT_CLEAN, text(v.UNKNOWN))} AS victimization_fact,
         {planted("l_orderkey", CITY_SEX_CLEAN)} AS sex,
         {planted("l_orderkey", CITY_ETHNIC_CLEAN)} AS ethnic_group,
         CASE WHEN l_quantity <= 13 THEN '0-13' WHEN l_quantity <= 26 THEN '14-26'
              WHEN l_quantity <= 59 THEN '27-59' ELSE '60+' END AS age_range,
         'cali' AS source
  FROM ({EXTRACT_SQL}))
GROUP BY {GRAIN_SQL}
"""


def region_raw(spark, sf):
    key = "event_id"
    return table(spark, sf, "events").select(
        F.when(F.col(key) % 9 == 4, F.lit("sin fecha"))
        .when(F.col(key) % 2 == 0, F.date_format("ts", "dd/MM/yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("Fecha_Corte"),
        plant(key, REGION_FACT).alias("HECHO"),
        (F.col("user_id") % 21).alias("PARAM_HECHO"),
        plant("user_id", REGION_SEX).alias("SEXO"),
        plant("user_id", REGION_ETHNIC).alias("ETNIA"),
        plant(key, REGION_AGE).alias("CICLO_VITAL"),
        plant(key, REGION_COUNT).alias("PER_OCU"),
    )


REGION_SQL = f"""
SELECT {GRAIN_SQL}, SUM(n)::DOUBLE AS total_victim FROM (
  SELECT CASE WHEN event_id % 9 <> 4 THEN CAST(ts AS DATE)::TIMESTAMP END AS date_processing,
         year(CASE WHEN event_id % 9 <> 4 THEN ts END) AS year,
         month(CASE WHEN event_id % 9 <> 4 THEN ts END) AS month,
         'santander' AS state_dept, {planted("event_id", REGION_FACT_CLEAN)} AS victimization_fact,
         {planted("user_id", REGION_SEX_CLEAN)} AS sex,
         {planted("user_id", REGION_ETHNIC_CLEAN)} AS ethnic_group,
         {planted("event_id", REGION_AGE_CLEAN)} AS age_range, 'santander' AS source,
         ([{", ".join(map(str, REGION_COUNT_CLEAN))}])[1 + event_id % {len(REGION_COUNT_CLEAN)}] AS n
  FROM events)
GROUP BY {GRAIN_SQL}
"""


def national_raw(spark, sf):
    key = "o_orderkey"
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        F.when(F.col(key) % 5 == 0, F.date_format(day, "d/M/yyyy"))
        .when(F.col(key) % 5 == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(F.col(key) % 5 == 2, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:11:12")))
        .when(F.col(key) % 5 == 3, F.date_format(day, "dd-MM-yyyy"))
        .alias("Fecha Corte"),
        plant(key, NATIONAL_CODES).alias("Cod Estado Depto"),
        plant(key, NATIONAL_NAMES).alias("Estado Depto"),
        F.col("o_orderpriority").alias("Hecho"),
        plant(key, REGION_SEX).alias("Sexo"),
        plant(key, NATIONAL_ETHNIC).alias("Etnía"),
        plant("o_custkey", REGION_AGE).alias("Ciclo Vital"),
        label(F.col("o_custkey") % 90).alias("Per Ocu"),
    )


DEPT_NAMES = {name: code for code, name in v.DEPARTMENTS.items()}
UNKNOWN = text(v.UNKNOWN)

NATIONAL_SQL = f"""
SELECT {GRAIN_SQL}, SUM(n)::DOUBLE AS total_victim FROM (
  SELECT d AS date_processing, year(d) AS year, month(d) AS month,
         CASE WHEN name IN ({listed(list(v.DEPARTMENTS.values()))}) THEN name ELSE {UNKNOWN} END AS state_dept,
         lower(o_orderpriority) AS victimization_fact, sex, ethnic_group, age_range,
         'nacional (colombia)' AS source, o_custkey % 90 AS n
  FROM (SELECT *, CASE WHEN n0 = {UNKNOWN} THEN {case("c0", v.DEPARTMENTS)} ELSE n0 END AS name
        FROM (SELECT o_orderpriority, o_custkey,
                     CASE WHEN o_orderkey % 5 = 2 THEN o_orderdate::DATE + INTERVAL '10 hours 11 minutes 12 seconds'
                          WHEN o_orderkey % 5 <> 4 THEN o_orderdate::DATE::TIMESTAMP END AS d,
                     {planted("o_orderkey", NATIONAL_CODES_CLEAN)} AS c0,
                     {planted("o_orderkey", NATIONAL_NAMES_KNOWN)} AS n0,
                     {planted("o_orderkey", REGION_SEX_CLEAN)} AS sex,
                     {planted("o_orderkey", NATIONAL_ETHNIC_CLEAN)} AS ethnic_group,
                     {planted("o_custkey", REGION_AGE_CLEAN)} AS age_range
              FROM orders)))
GROUP BY {GRAIN_SQL}
"""

SHOWN = f"""
strftime(date_processing, '%Y-%m-%d %H:%M:%S') AS date_processing, CAST(year AS BIGINT) AS year,
CAST(month AS BIGINT) AS month, state_dept, victimization_fact, sex, ethnic_group, age_range, source
"""


def shown(df):
    columns = [*v.GRAIN, v.MEASURE]
    dated = df.withColumn(v.DATE, F.date_format(v.DATE, STAMP))
    return longs(dated, "year", "month").withColumn(v.MEASURE, F.col(v.MEASURE).cast("double")).select(
        *columns, *[c for c in df.columns if c not in columns]
    )


def shown_sql(sql: str, flag: bool = True) -> str:
    extra = f", {text(v.REPORTED)} AS {v.FLAG}" if flag else ""
    return f"SELECT {SHOWN}, total_victim{extra} FROM ({sql})"


@query("recipe_city", shown_sql(CITY_SQL))
def recipe_city(spark, sf):
    return shown(apply_recipe(city_raw(spark, sf), CITY))


@query("recipe_region", shown_sql(REGION_SQL))
def recipe_region(spark, sf):
    return shown(apply_recipe(region_raw(spark, sf), REGION))


@query("recipe_national", shown_sql(NATIONAL_SQL))
def recipe_national(spark, sf):
    return shown(apply_recipe(national_raw(spark, sf), NATIONAL))


def sources(spark, sf):
    return [
        (city_raw(spark, sf), CITY),
        (region_raw(spark, sf), REGION),
        (national_raw(spark, sf), NATIONAL),
    ]


ALL_SQL = f"{CITY_SQL} UNION ALL {REGION_SQL} UNION ALL {NATIONAL_SQL}"
CONSOLIDATED_SQL = f"""
SELECT {GRAIN_SQL}, SUM(total_victim) AS total_victim FROM ({ALL_SQL}) GROUP BY {GRAIN_SQL}
"""


@query("flagship", shown_sql(CONSOLIDATED_SQL, flag=False))
def flagship(spark, sf):
    return shown(consolidated(sources(spark, sf)))


@query(
    "flow_star",
    f"""
    SELECT CAST(date_processing AS DATE) AS date_processing, state_dept, victimization_fact, sex,
           ethnic_group, age_range, CAST(total_victim AS BIGINT) AS total_victim, source
    FROM ({CONSOLIDATED_SQL}) WHERE date_processing IS NOT NULL
    """,
)
def flow_star(spark, sf):
    """Sources to validated star, loaded twice, then read back through its dimensions."""
    base = scratch_path(spark, "flow")
    paths = flow.FlowPaths(
        f"{base}/consolidated", f"{base}/rules", f"{base}/outcomes", f"{base}/star"
    )
    flow.run_flow(spark, sources(spark, sf), paths, "day-1")
    store = flow.star_store(spark, paths.star)
    store.load(spark.read.parquet(paths.consolidated), "day-1")
    facts = store.table("facts")
    for dim in flow.STAR:
        facts = facts.join(store.table(dim.name), dim.id, "left")
    return facts.select(
        v.DATE, "state_dept", "victimization_fact", "sex", "ethnic_group", "age_range",
        v.MEASURE, "source",
    )


@query(
    "flow_metrics",
    f"""
    WITH c AS ({CONSOLIDATED_SQL})
    SELECT 'consolidated' AS step, COUNT(*) AS n_rows, 0::BIGINT AS n_duplicates FROM c
    UNION ALL SELECT 'facts', COUNT(*), NULL FROM c WHERE date_processing IS NOT NULL
    UNION ALL SELECT 'rejects', COUNT(*), NULL FROM c WHERE date_processing IS NULL
    UNION ALL SELECT 'read', COUNT(*), NULL FROM lineitem
    UNION ALL SELECT 'read', COUNT(*), NULL FROM events
    UNION ALL SELECT 'read', COUNT(*), NULL FROM orders
    """,
)
def flow_metrics(spark, sf):
    """Rows and duplicates at every step of a flow."""
    base = scratch_path(spark, "flow")
    paths = flow.FlowPaths(*(f"{base}/{n}" for n in ("consolidated", "rules", "outcomes", "star")))
    _, steps = flow.run_flow(spark, sources(spark, sf), paths, "day-1")
    return steps.withColumn("step", F.element_at(F.split("step", " "), 1))


RECORD_SEX = ["Femenino", "Masculino", "Otro"]
RECORD_ETHNIC = ["Indígena", "Mestizo", "Negro", "Ninguno", "Rom"]
RECORD_ETHNIC_CLEAN = ["Indigena", "Mestizo", "Negro", "Ninguno", "Rom"]
RECORD_COMMUNE = ["7", "7.0", "22.5", "0", "23", None, " 15 "]
RECORD_COMMUNE_CLEAN = ["7", "7", "22", "No Registra", "No Registra", "No Registra", "15"]
RECORD_FACT = ["Homicidio", "Amenaza", None, "Tortura", *v.RAW_RECODES["victimization_fact"]]
RECORD_FACT_CLEAN = [
    "Homicidio", "Amenaza", "No Registra", "Tortura", *v.RAW_RECODES["victimization_fact"].values(),
]


def spanish(day):
    month = F.element_at(F.array(*map(F.lit, SPANISH)), F.month(day))
    return F.concat_ws("-", F.dayofmonth(day).cast("string"), month, F.year(day).cast("string"))


def records_raw(spark, sf):
    """Orders as person records in text, every 17th wholly null."""
    key = F.col("o_orderkey")
    processed = F.to_date(F.add_months("o_orderdate", 12 * 16))
    born = F.date_add(processed, 100 - ((F.col("o_custkey") * 37 + key) % 42000).cast("int"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", processed.alias("p"), born.alias("b"))
    age = F.when(key % 9 == 0, F.lit("-5")).when(key % 9 == 1, F.lit("200")).otherwise(
        (F.col("o_custkey") % 100).cast("string")
    )
    cells = {
        "code_sspm": key.cast("string"),
        "date_processing": spanish(F.col("p")),
        "code_municipality": F.lit("76001"),
        "municipality": F.lit("Cali"),
        "departament": F.lit("Valle del Cauca"),
        "sex": plant("o_orderkey", RECORD_SEX),
        "ethnic_group": plant("o_orderkey", RECORD_ETHNIC),
        "date_of_birth": spanish(F.col("b")),
        "years_in_the_visitia": age,
        "commune": plant("o_orderkey", RECORD_COMMUNE),
        "victimization_fact": plant("o_custkey", RECORD_FACT),
        "cut-off_date": spanish(F.col("p")),
        "web_report_date": spanish(F.col("p")),
    }
    return orders.select(*[F.when(key % 17 != 0, c).alias(name) for name, c in cells.items()])


RECORDS_SQL = f"""
SELECT *, CASE classification {" ".join(f"WHEN '{k}' THEN {p}" for k, p in v.AGE_POINTS.items())} END
          + p_sex + p_ethnicity + p_fact AS vulnerability_index
FROM (
  SELECT o_orderkey AS code_sspm, p AS date_processing, b AS date_of_birth, age AS years, sex,
         ethnic_group, commune, victimization_fact,
         CASE WHEN age > -1 AND age <= 13 THEN 'Childhood' WHEN age > 13 AND age <= 26 THEN 'Youth'
              WHEN age > 26 AND age <= 59 THEN 'Adulthood' WHEN age > 59 THEN 'Older adults' END AS classification,
         {points_sql("sex", v.SEX_POINTS)} AS p_sex,
         {points_sql("ethnic_group", v.ETHNIC_POINTS)} AS p_ethnicity,
         {points_sql("victimization_fact", v.FACT_POINTS)} AS p_fact
  FROM (
    SELECT *, CASE WHEN o_orderkey % 9 IN (0, 1)
                   THEN year(p) - year(b) - CASE WHEN (month(p), day(p)) < (month(b), day(b)) THEN 1 ELSE 0 END
                   ELSE o_custkey % 100 END AS age,
           {planted("o_orderkey", RECORD_SEX)} AS sex,
           {planted("o_orderkey", RECORD_ETHNIC_CLEAN)} AS ethnic_group,
           {planted("o_orderkey", RECORD_COMMUNE_CLEAN)} AS commune,
           {planted("o_custkey", RECORD_FACT_CLEAN)} AS victimization_fact
    FROM (SELECT *, p + CAST(100 - (o_custkey * 37 + o_orderkey) % 42000 AS INTEGER) AS b
          FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate + INTERVAL 16 YEAR AS DATE) AS p FROM orders))
    WHERE o_orderkey % 17 <> 0 AND b BETWEEN DATE '1910-01-01' AND DATE '2023-11-30' AND b <= p
          AND p >= DATE '2012-06-05'))
"""


def scored(spark, sf):
    return records.scored_records(records.valid_records(records.typed_records(records_raw(spark, sf))))


@query(
    "scored_records",
    f"""
    SELECT code_sspm, date_processing, date_of_birth, CAST(years AS BIGINT) AS years, sex, ethnic_group,
           commune, victimization_fact, classification, CAST(vulnerability_index AS BIGINT) AS vulnerability_index,
           CAST(DENSE_RANK() OVER (ORDER BY ethnic_group) - 1 AS BIGINT) AS ethnic_group_encoded,
           CASE WHEN sex = 'Femenino' THEN 1 ELSE 0 END AS sex_Femenino,
           CASE WHEN sex = 'Masculino' THEN 1 ELSE 0 END AS sex_Masculino,
           CASE WHEN sex = 'Otro' THEN 1 ELSE 0 END AS sex_Otro
    FROM ({RECORDS_SQL})
    """,
)
def scored_records(spark, sf):
    encoded = records.encoded_records(scored(spark, sf))
    return longs(encoded, "vulnerability_index").select(
        "code_sspm", v.DATE, "date_of_birth", F.col("years_in_the_visitia").alias("years"), "sex",
        "ethnic_group", "commune", "victimization_fact", "classification", "vulnerability_index",
        "ethnic_group_encoded", "sex_Femenino", "sex_Masculino", "sex_Otro",
    )


@query(
    "record_star",
    f"""
    WITH r AS ({RECORDS_SQL}),
    person AS (SELECT *, ROW_NUMBER() OVER (ORDER BY sex, ethnic_group, classification NULLS FIRST) AS id_person
               FROM (SELECT DISTINCT sex, ethnic_group, classification FROM r)),
    act AS (SELECT *, ROW_NUMBER() OVER (ORDER BY victimization_fact) AS id_act
            FROM (SELECT DISTINCT victimization_fact FROM r)),
    loc AS (SELECT *, ROW_NUMBER() OVER (ORDER BY commune) AS id_location
            FROM (SELECT DISTINCT commune FROM r)),
    days AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date_processing) AS id_date
             FROM (SELECT DISTINCT date_processing FROM r))
    SELECT id_person, id_act, id_location, id_date, CAST(vulnerability_index AS BIGINT) AS vulnerability_index,
           COUNT(*) OVER () AS total_victim
    FROM r JOIN person p ON r.sex = p.sex AND r.ethnic_group = p.ethnic_group
                        AND r.classification IS NOT DISTINCT FROM p.classification
           JOIN act USING (victimization_fact) JOIN loc USING (commune) JOIN days USING (date_processing)
    """,
)
def record_star(spark, sf):
    return longs(records.record_star(scored(spark, sf))["victims"], "vulnerability_index")
