import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tributary.functions import text
from tributary.functions.recode import recode
from tributary.operators import clean, shape
from tributary.plans import vocabulary as v

HARD = [
    None, "", "  Ñandú\t", " DesapariciÃ³n Forzada ", "½ hora", "ﬁn", "İstanbul", "ΑΒΓΣ",
    "straße", "²³¹", "ǅ", "Ⅷ…", "école", "Ａｂｃ", "\x1cx\x1f", "Việt Nam", "日本 ㈱", "𝐀𝐛", "plain",
    "desapariciï¿½n forzada", "NIÃ±OS", "DesapariciÂ\x83Ã³n",
]


def by_python(s):
    if s is None:
        return None
    kept = [c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)]
    return "".join(kept).lower().strip()


def test_fold_equals_python(values):
    hard = [*HARD, "각하", "㎏ ㏄", "ﷺ", "ﻼ", "a㍿", "힣가 a"]
    assert values(hard, text.fold) == [by_python(s) for s in hard]


def test_fold_of_every_fold_character(values):
    source, _, expanded = text._fold_rules()
    syllables = [chr(c) for c in range(text.SYLLABLES[0], text.SYLLABLES[1] + 1)]
    chars = [f"a{c}b" for c in [*source, *expanded, *syllables]]
    assert values(chars, text.fold) == [by_python(s) for s in chars]


def test_fold_is_idempotent(values):
    once = values(HARD, text.fold)
    assert values(once, text.fold) == once


def test_repairs_reach_folded_labels(values):
    raw = ["DesapariciÃ³n Forzada", "Minas antipersonal, MuniciÃ³n sin explotar y Artefacto explosivo improvisado"]
    repaired = values(raw, lambda c: recode(text.fold(c), v.FACT_REPAIRS))
    assert repaired == [
        "desaparicion forzada",
        "minas antipersonal, municion sin explotar y artefacto explosivo improvisado",
    ]


def test_conditional_fold(spark):
    df = spark.createDataFrame(
        [("sí", "Sí", None), ("otro día", "no", "día")], "a string, b string, c string"
    )
    rows = clean.fold_text(df, only_if_needed=True).collect()
    assert {r["a"] for r in rows} == {"sí", "otro día"}
    assert {r["b"] for r in rows} == {"si", "no"}
    assert {r["c"] for r in rows} == {None, "dia"}
    forced = clean.fold_text(df).collect()
    assert {r["a"] for r in forced} == {"si", "otro dia"}


def test_unknown_labels(spark, values):
    got = values(
        [None, "nd", "", "nan", "x", "ND"],
        lambda c: text.canonical_unknown(c, v.UNKNOWN_VARIANTS, v.UNKNOWN),
    )
    assert got == [v.UNKNOWN] * 4 + ["x", "ND"]
    df = spark.createDataFrame([(None, 1), ("none", None)], "s string, n int")
    cleaned = clean.unify_unknown(df, v.UNKNOWN_VARIANTS, v.UNKNOWN)
    again = clean.unify_unknown(cleaned, v.UNKNOWN_VARIANTS, v.UNKNOWN)
    assert cleaned.collect() == again.collect()
    assert {r["n"] for r in cleaned.collect()} == {1, None}


def test_range_labels_match_pandas(values):
    raw = ["entre 6 y 11", "entre 61 y 100", "mayor", " 18 - 28 ", None, "nd"]
    series = pd.Series(raw, dtype=object)
    for old, new in (("entre", ""), ("y", "-"), (" - ", "-")):
        series = series.str.replace(old, new, regex=False)
    expected = [None if x is None else x for x in series.str.strip().tolist()]
    assert values(raw, text.compact_range) == expected
    assert values(["mayor de 60 y mas"], lambda c: text.compact_range(c, connector_only=True)) == [
        "mayor de 60-mas"
    ]


@pytest.mark.parametrize("width", [2, 3, 5])
def test_zero_pad_equals_zfill(values, width):
    raw = ["5", "-5", "+7", "42", "sin informacion", "", "00", "-", "5.0"]
    assert values(raw, lambda c: text.zero_pad(c, width)) == [s.zfill(width) for s in raw]
    assert values([None], lambda c: text.zero_pad(c, width)) == [None]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Código Depto` int, `AÑO ` int")
    assert shape.fold_names(df).columns == ["codigo_depto", "ano"]
    clash = spark.createDataFrame([(1, 2)], "`Año` int, `ano` int")
    with pytest.raises(ValueError, match="collide"):
        shape.fold_names(clash)


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("A", 1)], "s string, n int")
    assert shape.map_columns(df, ["s", "not_there"], F.lower).collect()[0]["s"] == "a"
    assert shape.map_columns(df, ["not_there"], F.lower) is df
    assert shape.text_columns(df) == ["s"]
    assert shape.drop(shape.rename(df, {"x": "y"}), "z").columns == ["s", "n"]
