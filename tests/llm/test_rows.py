"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_pipeline import good, repeated, words

from tributary.llm import exact, quality

LONG = "lorem ipsum dolor " * 20_000
TEXTS = [
    None, "", " \n\t", "one", "a b c d e f g h " * 2, "x " * 50, "line one\nline one\nline one\n\nother",
    "#*$%&|<> " * 30, "CAPS " * 40, LONG, "\x0b\x0c", "é ü ñ", " ".join(f"w{n}" for n in range(60)),
]


def signals(text):
    text = text or ""
    own = words(text)
    full = [x for x in text.split("\n") if words(x)]
    counts = (
        len(own),
        sum(map(len, own)),
        sum(c in "#*$%&|<>" for c in text),
        len(full) - len(set(full)),
        repeated(own),
    )
    return (*counts, counts[0] < 20 or 100 * counts[4] > 30 * counts[0], good(text))


def test_quality_of_odd_rows(spark):
    docs = [*enumerate(TEXTS), (None, TEXTS[4]), (0, TEXTS[4])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_words int")
    got = sorted((tuple(r)[:8] for r in quality.quality_signals(df).collect()), key=str)
    assert got == sorted(((d, *signals(t)) for d, t in docs), key=str)
    assert quality.quality_signals(df.limit(0)).collect() == []
    assert quality.keep_good(df).count() == sum(good(t) for _, t in docs)


def test_rules_are_ordered_by_rejections_per_second(spark):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(TEXTS * 5)], "doc_id long, text string")
    measured = quality.measure(df)
    assert {m.rule.name for m in measured} == {r.name for r in quality.RULES}
    assert [m.rate for m in measured] == sorted((m.rate for m in measured), reverse=True)
    assert all(m.rejected > 0 for m in measured if m.rule.name in ("few_words", "symbols", "capitals"))


def test_the_verdict_does_not_depend_on_the_order(spark):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(TEXTS)], "doc_id long, text string")
    text = quality.F.coalesce("text", quality.F.lit(""))
    kept = []
    for rules in (quality.RULES, quality.RULES[::-1]):
        verdict = quality.verdict(quality.Signals(text), rules)
        kept.append({r.doc_id for r in df.filter(verdict.isNull()).collect()})
    assert kept[0] == kept[1]


def groups(docs):
    by = {}
    for n, (doc_id, text) in enumerate(docs):
        by.setdefault("".join(words(text)), []).append((-len(text or ""), doc_id is None, doc_id or 0, n))
    out = []
    for content, members in by.items():
        best = min(members)
        digest = hashlib.sha256(content.encode()).hexdigest()
        keep = None if best[1] else best[2]
        for m in members:
            out.append((None if m[1] else m[2], keep, len(members), m == best, digest))
    return sorted(out, key=str)


def check_groups(spark, docs, parts):
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, part string")
    got = sorted((tuple(r) for r in exact.exact_groups(df.repartition(parts)).collect()), key=str)
    assert got == groups(docs)
    kept = exact.deduplicate(df.repartition(parts)).collect()
    assert len(kept) == len({"".join(words(t)) for _, t in docs})
    assert {r.part for r in kept} <= {"x"}


def test_copies_in_odd_rows(spark):
    docs = [
        (1, "a b"), (2, "ab"), (3, " a b "), (3, " a b "), (None, "a  b "), (4, None), (5, ""), (6, "\n"),
        (7, LONG), (8, LONG + "x"), (9, "A b"), (10, "a b"), (None, "z"),
    ]
    check_groups(spark, docs, 3)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_groups(empty).collect() == []
    assert exact.deduplicate(empty).collect() == []


def test_a_group_larger_than_a_partition(spark):
    """Copies cover several range partitions and are still one group."""
    docs = [(n, "the same text") for n in range(600)] + [(n, f"text {n}") for n in range(600, 700)]
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        check_groups(spark, docs, 4)
    finally:
        spark.conf.set(key, before)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c"]), max_size=40))
def test_covered_words_are_counted_once(own):
    windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    at = [i for i, w in enumerate(windows) if windows.count(w) > 1]
    steps = [min(8, b - a) for a, b in zip(at, at[1:], strict=False)] + [8] * bool(at)
    assert sum(steps) == repeated(own)


@pytest.mark.parametrize("column", ["counts", "word_chars", "head", "points", "run"])
def test_clashing_columns(spark, column):
    df = spark.createDataFrame([(1, "a b", "x")], f"doc_id long, text string, `{column}` string")
    assert quality.quality_signals(df).count() == 1
    assert exact.deduplicate(df).columns == ["doc_id", "text", column]
