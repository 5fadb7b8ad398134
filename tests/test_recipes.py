import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tributary.operators import aggregate, quality
from tributary.plans import flow, records
from tributary.plans import vocabulary as v
from tributary.plans.recipes import CITY, NATIONAL, REGION, apply_recipe, clean_rows, consolidated, harmonise
from tributary.session import scratch_path

CITY_COLUMNS = (
    "vulnerability_index string, total_victim int, sex string, ethnic_group string, classification string, "
    "victimization_fact string, commune string, date_processing string, year string, source string"
)
CITY_ROWS = [
    ("7", 9, "Masculino", "Negro", "Youth", "Homicidio", "7", "2020-05-06", "2020", "raw"),
    ("x", 9, "Masculino", " MORENO", "Youth", "Homicidio", "8", "2020-05-06 00:00:00", "2020", "raw"),
    (None, 9, "Femenino", None, "Older adults", "Tortura", "9", "junk", None, "raw"),
]
REGION_COLUMNS = "FECHA_CORTE string, Hecho string, PARAM_HECHO string, SEXO string, ETNIA string, CICLO_VITAL string, PER_OCU string"
REGION_ROWS = [
    ("31/12/2023", "Desaparición forzada", "4", "Hombre", "Indígena (Acreditado RA)", "entre 6 y 11", "7"),
    ("2023-12-31", "DesapariciÃ³n forzada ", "4", "HOMBRE", "indigena", "ENTRE 6 Y 11", " 7 "),
    ("12/31/2023", None, "5", "ND", "No Registra", None, "nan"),
    (None, "Tortura", "99", "Mujer", "Gitano(a) ROM", "entre 61 y 100", "5d"),
]
NATIONAL_COLUMNS = (
    "`Fecha Corte` string, `Cod Estado Depto` string, `Estado Depto` string, Hecho string, Sexo string, "
    "`Etnía` string, `Ciclo Vital` string, `Per Ocu` string, vigencia string"
)


def national(code, name, count="1"):
    return ("5/6/2012", code, name, "Amenaza", "Mujer", "Palenquero", "entre 0 y 5", count, "2012")


@pytest.fixture(scope="module")
def sources(spark):
    return [
        (spark.createDataFrame(CITY_ROWS, CITY_COLUMNS), CITY),
        (spark.createDataFrame(REGION_ROWS, REGION_COLUMNS), REGION),
        (spark.createDataFrame([national("5", None), national(None, "Antioquia", "2")], NATIONAL_COLUMNS), NATIONAL),
    ]


def picked(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_city(sources):
    df, recipe = sources[0]
    got = picked(
        apply_recipe(df, recipe), "sex", "ethnic_group", "age_range", "year", "month", "state_dept", "source",
        v.MEASURE, v.FLAG,
    )
    assert got == {
        ("hombre", "afrocolombiano", "14-26", 2020, 5, "valle del cauca", "cali", 2, "reportado"),
        ("mujer", "sin informacion", "60+", None, None, "valle del cauca", "cali", 1, "reportado"),
    }


def test_collapsing_changes_nothing(sources):
    df, _ = sources[0]
    plain = CITY.with_(collapse=False)
    assert picked(apply_recipe(df, CITY), *v.GRAIN, v.MEASURE) == picked(apply_recipe(df, plain), *v.GRAIN, v.MEASURE)
    region, recipe = sources[1]
    assert picked(apply_recipe(region, recipe), *v.GRAIN, v.MEASURE) == picked(
        apply_recipe(region, recipe.with_(collapse=True)), *v.GRAIN, v.MEASURE
    )


def test_region(sources):
    df, recipe = sources[1]
    got = picked(apply_recipe(df, recipe), v.DATE, "victimization_fact", "sex", "ethnic_group", "age_range", v.MEASURE)
    last = dt.datetime(2023, 12, 31)
    assert got == {
        (last, "desaparicion forzada", "hombre", "indigena", "6-11", 14.0),
        (last, v.UNKNOWN, v.UNKNOWN, v.UNKNOWN, v.UNKNOWN, 0.0),
        (None, "tortura", "mujer", "rom", "61-100", 0.0),
    }


def test_fallback_before_unknown(sources):
    df, recipe = sources[1]
    first = apply_recipe(df, recipe.with_(fallback_first=True))
    assert ("desplazamiento",) in picked(first, "victimization_fact")


def test_observed_flag(sources):
    df, recipe = sources[1]
    flags = picked(apply_recipe(df, recipe, "observed"), "victimization_fact", v.FLAG)
    assert ("tortura", v.UNKNOWN) in flags and ("desaparicion forzada", v.REPORTED) in flags


DEPARTMENT_CASES = [
    ("5", "Antioquia", "05", "antioquia"),
    ("5", None, "05", "antioquia"),
    (None, "BOGOTÁ, D.C.", "11", "bogota, d.c."),
    ("00", "Sin definir", v.UNKNOWN, v.UNKNOWN),
    ("42", None, v.UNKNOWN, v.UNKNOWN),
    (None, "Atlántida", v.UNKNOWN, v.UNKNOWN),
    ("5.0", "Nariño", v.UNKNOWN, "narino"),
    ("99", "Antioquia", "99", "antioquia"),
    ("-5", None, v.UNKNOWN, v.UNKNOWN),
]


def test_departments(spark):
    rows = [(*national(code, name)[:-1], str(i)) for i, (code, name, *_) in enumerate(DEPARTMENT_CASES)]
    cleaned = clean_rows(spark.createDataFrame(rows, NATIONAL_COLUMNS), NATIONAL)
    got = {int(r["vigencia"]): (r["cod_estado_depto"], r["state_dept"]) for r in cleaned.collect()}
    assert got == {i: tuple(case[2:]) for i, case in enumerate(DEPARTMENT_CASES)}


def test_sparse_source(spark):
    df = spark.createDataFrame([("Hombre", "3"), ("hombre ", "4")], "SEXO string, PER_OCU string")
    got = apply_recipe(df, REGION)
    assert v.DATE not in got.columns and got.first()[v.MEASURE] == 7.0


def test_consolidation_is_idempotent(sources):
    table = consolidated(sources)
    stepwise = aggregate.consolidate(harmonise(sources), v.GRAIN, v.MEASURE)
    assert picked(table, *v.GRAIN, v.MEASURE) == picked(stepwise, *v.GRAIN, v.MEASURE)
    assert table.groupBy(*v.GRAIN).count().filter("count > 1").count() == 0
    assert table.agg(F.sum(v.MEASURE)).first()[0] == 3 + 14 + 3
    assert {r["source"] for r in table.collect()} == set(v.TAGS)


def paths(spark):
    base = scratch_path(spark, "flow")
    return flow.FlowPaths(*[f"{base}/{n}" for n in ("consolidated", "rules", "outcomes", "star")])


def test_flow_twice(spark, sources):
    where = paths(spark)
    for _ in range(2):
        outcome, steps = flow.run_flow(spark, sources, where, "2024-01-01")
        assert outcome.filter("NOT ok").count() == 0
    store = flow.star_store(spark, where.star)
    table = spark.read.parquet(where.consolidated)
    assert store.table("facts").count() == table.filter("date_processing IS NOT NULL").count()
    assert store.table("rejects").count() == table.filter("date_processing IS NULL").count()
    dated = table.filter("date_processing IS NOT NULL").agg(F.sum(v.MEASURE)).first()[0]
    assert store.table("facts").agg(F.sum(v.MEASURE)).first()[0] == dated
    counts = {r["step"]: (r["n_rows"], r["n_duplicates"]) for r in steps.collect()}
    assert counts["consolidated"] == (table.count(), 0)
    assert counts["facts"][0] + counts["rejects"][0] == table.count()
    read = [counts[f"read {recipe.tag}"][0] for _, recipe in sources]
    assert read == [df.count() for df, _ in sources]


def test_a_second_day_passes_and_a_fault_does_not(spark, sources):
    where = paths(spark)
    reference = consolidated(sources)
    open_above = [v.DATE, "year", "month", v.MEASURE]
    options = {"domains": ["source"], "open_above": open_above, "tolerance": 0.5}
    flow.run_flow(spark, sources, where, "2024-01-01", reference, **options)
    later = [
        (df.withColumn("date_processing", F.lit("2031-05-07")) if recipe is CITY else df, recipe)
        for df, recipe in sources
    ]
    flow.run_flow(spark, later, where, "2024-01-02")
    store = flow.star_store(spark, where.star)
    assert {r["run"] for r in store.table("facts").select("run").collect()} == {"2024-01-01", "2024-01-02"}
    with pytest.raises(quality.ValidationFailed, match="source: value_set"):
        flow.run_flow(spark, [(df, replace(r, tag=f"new {r.tag}")) for df, r in later], where, "2024-01-03")
    kept = quality.load_outcomes(spark, where.outcomes)
    assert {r["run"] for r in kept.filter("NOT ok").select("run").collect()} == {"2024-01-03"}


def test_broken_rule_stops_the_load(spark, sources):
    where = paths(spark)
    first = consolidated(sources).filter("source = 'cali'")
    quality.save_rules(quality.infer_rules(first, ["source"]), where.rules)
    with pytest.raises(quality.ValidationFailed, match="source: value_set"):
        flow.run_flow(spark, sources, where, "2024-01-01")
    assert spark.read.parquet(where.outcomes).filter("NOT ok").count() > 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{where.star}/facts")


def raw_record(**cells):
    record = dict.fromkeys(v.RAW_COLUMNS)
    record |= {
        "code_sspm": "1", "code_municipality": "76001", "years_in_the_visitia": "30", "sex": "Femenino",
        "ethnic_group": "Indígena", "date_of_birth": "1-ene-1990", "date_processing": "5-ago-2020",
        "commune": "7.0", "victimization_fact": "Homicidio",
    }
    return tuple((record | cells)[c] for c in v.RAW_COLUMNS)


def scored(spark, *rows):
    raw = spark.createDataFrame(list(rows), ", ".join(f"`{c}` string" for c in v.RAW_COLUMNS))
    return records.scored_records(records.valid_records(records.typed_records(raw)))


SCORE_CASES = [
    ({}, 1 + 2 + 2 + 3, 30),
    ({"years_in_the_visitia": "-5"}, 8, 30),
    ({"years_in_the_visitia": "200", "date_of_birth": "6-ago-1990"}, 8, 29),
    ({"years_in_the_visitia": "70", "sex": None}, 2 + 0 + 2 + 3, 70),
    ({"victimization_fact": None}, 1 + 2 + 2 + 1, 30),
    ({"ethnic_group": "Ninguno", "victimization_fact": "Tortura"}, 1 + 2, 30),
]


def test_scores(spark):
    rows = [raw_record(**cells, code_sspm=str(i)) for i, (cells, *_) in enumerate(SCORE_CASES)]
    got = {
        r["code_sspm"]: (r["vulnerability_index"], r["years_in_the_visitia"], r["commune"])
        for r in scored(spark, *rows).collect()
    }
    assert got == {i: (index, age, "7") for i, (_, index, age) in enumerate(SCORE_CASES)}


def test_invalid_records_are_removed(spark):
    invalid = [
        {"date_of_birth": "1-dic-1909"},
        {"date_of_birth": None},
        {"date_of_birth": "6-ago-2020"},
        {"date_processing": "4-jun-2012", "date_of_birth": "1-ene-1990"},
        dict.fromkeys(v.RAW_COLUMNS),
    ]
    assert scored(spark, *[raw_record(**cells) for cells in invalid]).count() == 0


def test_record_star(spark):
    df = scored(spark, raw_record(), raw_record(sex="Masculino"), raw_record(commune=None))
    tables = records.record_star(df)
    facts = tables["victims"]
    assert facts.count() == 3 and {r[v.MEASURE] for r in facts.collect()} == {3}
    for name, column in (("person", "id_person"), ("location", "id_location"), ("registration_date", "id_date")):
        assert facts.join(tables[name], column, "left_anti").count() == 0
    assert {r["year"] for r in tables["registration_date"].collect()} == {2020}
    seen = Observation("faults")
    records.valid_records(
        records.typed_records(
            spark.createDataFrame(
                [raw_record(), raw_record(date_of_birth=None)],
                ", ".join(f"`{c}` string" for c in v.RAW_COLUMNS),
            )
        ),
        seen,
    ).count()
    assert (seen.get["n_rows"], seen.get["n_birth_null"]) == (2, 1)
    encoded = records.encoded_records(df)
    assert {(r["sex_Femenino"], r["sex_Masculino"]) for r in encoded.collect()} == {(1, 0), (0, 1)}
