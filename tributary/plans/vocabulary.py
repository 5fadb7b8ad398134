"""Labels, codes, recode tables, limits and schemas of the domain.

They decide the results and are given by the sources and the consumers of the
consolidated table; operators take them as parameters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

UNKNOWN = "sin informacion"
REPORTED = "reportado"
NOT_REGISTERED = "No Registra"

UNKNOWN_VARIANTS = [
    "no registra", "no informa", "sin informacion", "no informado", "no registrado",
    "nan", "none", "nd", "",
]
UNKNOWN_VARIANTS_NATIONAL = [
    "no registra", "no informa", "sin informacion", "no informado", "no registrado",
    "sin definir", "nan", "none", "nd", "",
]

# Ingest tags and the tags that replace them in the harmonised table.
INGEST_TAGS = ["source1_cali", "source2_santander", "source3_api_displacement"]
TAGS = ["cali", "santander", "nacional (colombia)"]

RENAMES = {
    "fecha_corte": "date_processing",
    "estado_depto": "state_dept",
    "sexo": "sex",
    "hecho": "victimization_fact",
    "param_hecho": "param_victimization_fact",
    "etnia": "ethnic_group",
    "ciclo_vital": "age_range",
    "per_ocu": "total_victim",
}

SEX = {"masculino": "hombre", "femenino": "mujer"}

ETHNIC_GROUP_CITY = {
    "afrodescendiente": "afrocolombiano",
    "negro": "afrocolombiano",
    "moreno": "afrocolombiano",
}
ETHNIC_GROUP_REGION = {
    "indigena (acreditado ra)": "indigena",
    "indigena": "indigena",
    "negro(a) o afrocolombiano(a)": "afrocolombiano",
    "afrocolombiano (acreditado ra)": "afrocolombiano",
    "negro (acreditado ra)": "afrocolombiano",
    "raizal del archipielago de san andres y providencia": "raizal",
    "gitano(a) rom": "rom",
    "gitano (rrom) (acreditado ra)": "rom",
}
ETHNIC_GROUP_NATIONAL = {
    "afrocolombiano (acreditado ra)": "afrocolombiano",
    "negro(a) o afrocolombiano(a)": "afrocolombiano",
    "negro (acreditado ra)": "afrocolombiano",
    "indigena": "indigena",
    "indigena (acreditado ra)": "indigena",
    "gitano(a) rom": "rom",
    "gitano (rrom) (acreditado ra)": "rom",
    "raizal del archipielago de san andres y providencia": "raizal",
    "palenquero (acreditado ra)": "palenquero",
    "palenquero": "palenquero",
}

AGE_RANGE = {
    "adulthood": "27-59",
    "youth": "14-26",
    "childhood": "0-13",
    "older adults": "60+",
}

FACT_CODES = {
    1: "acto terrorista/atentados/combates/enfrentamientos/hostigamientos",
    2: "amenaza",
    3: "delitos contra la libertad e integridad sexual",
    4: "desaparicion forzada",
    5: "desplazamiento",
    6: "homicidio",
    7: "minas antipersonal/municion sin explotar/artefacto explosivo",
    8: "secuestro",
    9: "tortura",
    10: "vinculacion de ninos a grupos armados",
    11: "abandono o despojo de tierras",
    12: "perdida de bienes",
    13: "lesiones fisicas",
    14: "lesiones psicologicas",
    15: "confinamiento",
    20: "sin informacion",
}

# Wrongly decoded or differently spaced labels, as they look after folding.
FACT_REPAIRS = {
    "acto terrorista / atentados / combates / enfrentamientos / hostigamientos":
        "acto terrorista/atentados/combates/enfrentamientos/hostigamientos",
    "desaparicia3n forzada": "desaparicion forzada",
    "desaparicia\x83a3n forzada": "desaparicion forzada",
    "desaparicii¿1⁄2n forzada": "desaparicion forzada",
    "vinculacia3n de nia±os nia±as y adolescentes a actividades relacionadas con grupos armados":
        "vinculacion de ninos ninas y adolescentes a actividades relacionadas con grupos armados",
    "minas antipersonal, municii¿1⁄2n sin explotar y artefacto explosivo improvisado":
        "minas antipersonal, municion sin explotar y artefacto explosivo improvisado",
    "minas antipersonal, municia3n sin explotar y artefacto explosivo improvisado":
        "minas antipersonal, municion sin explotar y artefacto explosivo improvisado",
}

# Official department codes.
DEPARTMENTS = {
    "91": "amazonas", "05": "antioquia", "81": "arauca", "08": "atlantico", "11": "bogota, d.c.",
    "13": "bolivar", "15": "boyaca", "17": "caldas", "18": "caqueta", "85": "casanare",
    "19": "cauca", "20": "cesar", "27": "choco", "23": "cordoba", "25": "cundinamarca",
    "94": "guainia", "95": "guaviare", "41": "huila", "44": "la guajira", "47": "magdalena",
    "50": "meta", "52": "narino", "54": "norte de santander", "86": "putumayo", "63": "quindio",
    "66": "risaralda", "88": "san andres", "68": "santander", "70": "sucre", "73": "tolima",
    "76": "valle del cauca", "97": "vaupes", "99": "vichada",
}
NO_DEPARTMENT_CODE = ["00", "0", "sin informacion", "nan", "none"]
NO_DEPARTMENT_NAME = ["sin definir", "sin informacion", "nan", "none"]

START_YEAR = 2012

# Harmonised table and its grain.
HARMONISED = StructType([
    StructField("date_processing", TimestampType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("state_dept", StringType()),
    StructField("victimization_fact", StringType()),
    StructField("sex", StringType()),
    StructField("ethnic_group", StringType()),
    StructField("age_range", StringType()),
    StructField("total_victim", DoubleType()),
    StructField("source", StringType()),
])
MEASURE = "total_victim"
FLAG = "total_victim_flag"
DATE = "date_processing"
GRAIN = [f.name for f in HARMONISED if f.name != MEASURE]

# Raw exploratory records: columns by position.
RAW_COLUMNS = [
    "code_sspm", "date_processing", "code_municipality", "municipality", "departament", "sex",
    "ethnic_group", "date_of_birth", "years_in_the_visitia", "commune", "victimization_fact",
    "cut-off_date", "web_report_date",
]
RAW_INTEGERS = ["years_in_the_visitia", "code_sspm", "code_municipality"]
RAW_DATES = ["web_report_date", "cut-off_date", "date_of_birth", "date_processing"]
MONTHS = {"ene": "jan", "ago": "aug", "dic": "dec", "abr": "apr"}
RAW_RECODES = {
    "victimization_fact": {
        "Vinculacion de Niños Niñas y Adolescentes a Actividades Relacionadas con grupos armados":
            "Vinculacion de Ninos Ninas y Adolescentes a Actividades Relacionadas con grupos armados",
    },
    "ethnic_group": {"Indígena": "Indigena"},
}

# Limits of valid records.
COMMUNES = (1, 22)
BIRTH_DATES = (dt.date(1910, 1, 1), dt.date(2023, 11, 30))
FIRST_PROCESSING = dt.date(2012, 6, 5)
LAST_PROCESSING = dt.date(2023, 12, 30)
AGES = (0, 113)

# Life-cycle bands, right-closed, and the points of the vulnerability index.
AGE_EDGES = [-1, 13, 26, 59, float("inf")]
AGE_LABELS = ["Childhood", "Youth", "Adulthood", "Older adults"]
AGE_POINTS = {"Childhood": 2, "Youth": 1, "Adulthood": 1, "Older adults": 2}
SEX_POINTS = [(["Femenino"], 2), (["Masculino"], 1)]
ETHNIC_POINTS = [
    (["Indigena", "Afrodescendiente", "Afrocolombiano", "Palenquero", "Raizal", "Rom"], 2),
    (["Mestizo", "Negro", "Moreno", "Otro"], 1),
]
FACT_POINTS = [
    (
        [
            "Desplazamiento forzado",
            "Homicidio",
            "Delitos contra la libertad y la integridad sexual en desarrollo del conflicto armado",
        ],
        3,
    ),
    (
        [
            "Amenaza",
            "Desaparicion forzada",
            "Secuestro",
            "Abandono o Despojo Forzado de Tierras",
            "Acto terrorista/Atentados/Combates/Enfrentamientos/Hostigamientos",
            "Lesiones personales y psicologicas que produzcan o no incapacidad permanente",
            "Vinculacion de Ninos Ninas y Adolescentes a Actividades Relacionadas con grupos armados",
            "Perdida de Bienes Muebles o Inmuebles",
            "Eventos masivos",
        ],
        2,
    ),
    (["No Registra"], 1),
]
