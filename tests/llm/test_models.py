"""Language and toxicity models: held-out accuracy, brute force of their parts, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm import QUERIES, language, toxicity


def remainder(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_language_of_held_out_texts(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op9_language_id"](spark, sf).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    r = random.Random(5)
    lexicon = {"xx": "alpha beta gamma delta epsilon", "yy": "uno dos tres cuatro cinco"}
    docs = [
        (n, " ".join(r.choices(lexicon[lang].split(), k=12)), lang, 0)
        for n, lang in enumerate(["xx", "yy"] * 60)
    ]
    docs += [(900, None, "xx", 0), (901, "", None, 0), (902, " 12 !? \n", "yy", 0), (903, "alpha " * 30_000, None, 0)]
    docs += [(None, "uno dos", "yy", 0), (903, "alpha beta", None, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, score int")
    got = [tuple(x)[:4] for x in language.identify(df).collect()]
    assert len(got) == len(docs)
    und = {d: (lang, score) for d, _, lang, score in got if d in (900, 901, 902)}
    assert set(und.values()) == {("und", 0.0)}
    assert {lang for d, _, lang, _ in got if d == 903} == {"xx"}
    assert [(h, lang) for d, h, lang, _ in got if d is None] == [(True, "yy")]
    unlabelled = df.withColumn("lang", language.F.lit(None).cast("string"))
    assert {x.lang_pred for x in language.identify(unlabelled).collect()} == {"und"}
    assert language.identify(df.limit(0)).collect() == []


def test_text_logits_are_means_over_all_ngrams():
    model = language.fit([("alpha beta", "x"), ("uno dos", "y")] * 10)
    text = "alpha uno alpha"
    grams = []
    for word in text.split():
        data = f"<{word}>".encode()
        grams += [data[i : i + n] for n in language.ORDERS for i in range(len(data) - n + 1)]
    buckets, ends = language.bucket_rows(pa.array(["alpha", "uno"]))
    alpha, uno = buckets[: ends[1]], buckets[ends[1] :]
    assert len(grams) == 2 * len(alpha) + len(uno)
    z = model.logits[np.concatenate([alpha, uno, alpha])].mean(0) + model.bias
    p = np.exp(z / model.temperature)
    assert model.scores(pa.array([text]))[0] == pytest.approx(p / p.sum())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(
    st.text("abc", max_size=7),
    st.lists(st.text("abc", min_size=1, max_size=7), max_size=12, unique=True),
    st.integers(0, 2),
)
def test_automaton_accepts_what_is_near(word, terms, most):
    found = toxicity.LevenshteinAutomaton(word, most).accepted(toxicity.Trie(terms))
    near = [(t, distance(word, t)) for t in terms if distance(word, t) <= most]
    assert sorted(found) == sorted(near)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=9), st.lists(st.text("abc", min_size=5, max_size=8), min_size=1, max_size=6))
def test_lexicon_misses_no_misspelling(word, terms):
    lexicon = toxicity.Lexicon(dict.fromkeys(terms, 1.0))
    hit = lexicon.match(word)
    best = min(distance(word, t) for t in terms)
    assert (hit is None) == (best > 1)
    assert hit is None or hit[1] == best


@settings(max_examples=200, deadline=None)
@given(
    st.text("abc", min_size=1, max_size=9),
    st.dictionaries(st.text("abc", min_size=1, max_size=8), st.floats(0.1, 9.0), min_size=1, max_size=6),
)
def test_lexicon_finds_terms_of_any_weight_and_length(word, weights):
    hit = toxicity.Lexicon(weights).match(word)
    near = [t for t in weights if distance(word, t) <= 1]
    assert (hit is None) == (not near)
    if word in weights:
        assert hit == (weights[word], 0, toxicity.EXACT)
    elif near:
        best = max(near, key=lambda t: (len(t) >= toxicity.SHORT, weights[t]))
        kind = toxicity.MISSPELLED if len(best) >= toxicity.SHORT else toxicity.SHORT_MISSPELLED
        assert hit == (weights[best], 1, kind)


def test_misspelled_hits_have_features_of_their_own():
    lexicon = toxicity.Lexicon({"vermin": 8.0, "cretin": 2.6, "scum": 3.0})
    texts = ["a vermin here", "a cretinn here", "a scun here", "a vermin cretinn scun", "all is well"]
    names = {name: n for n, name in enumerate(toxicity.FEATURES)}
    found = toxicity.features(pa.array(texts), lexicon)
    assert found[:, names["any"]].tolist() == [1, 1, 1, 1, 0]
    assert found[:, names["most"]].tolist() == [8.0, 2.6, 3.0, 8.0, 0]
    assert found[:, names["any_misspelled"]].tolist() == [0, 1, 0, 0, 0]
    assert found[:, names["any_short"]].tolist() == [0, 0, 1, 0, 0]
    added = found[:, [names["total_misspelled"], names["total_short"]]]
    assert added[3] == pytest.approx([np.log(11.6 / 9), np.log(14.6 / 11.6)])


@pytest.mark.parametrize(
    ("text", "place", "quoted"),
    [
        ('he "called you idiot today" ok', 3, True),
        ("you idiot go away", 1, False),
        ('an "idiot," indeed', 1, True),
        ('"one" idiot "two"', 1, False),
        ("the word idiot is old", 2, True),
        ('" idiot', 1, False),
    ],
)
def test_context_tells_quotation_from_abuse(text, place, quoted):
    assert toxicity.is_quoted(text.split(), place) == quoted


def test_toxicity_of_held_out_texts(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op8_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    right = sum(p == y for p, y in held)
    assert right >= 0.97 * len(held)
    assert sum(p and y for p, y in held) >= 0.85 * sum(y for _, y in held)


def test_toxicity_of_odd_rows(spark):
    r = random.Random(2)
    plain = [f"word{n}" for n in range(200)]
    docs, labels = [], []
    for n in range(400):
        own, bad = r.choices(plain, k=30), n % 4 == 0
        if bad:
            for term in ("rotten", "vermin", "cretin"):
                own.insert(r.randrange(len(own)), term)
        docs.append((n, " ".join(own), 0))
        labels.append((n, int(bad), None))
    labels += [(0, None, 1), (None, 1, 1), (1, 0, 0), (1, 0, 0)]
    docs += [(900, None, 0), (900, "", 0), (901, "you are vermn and a cretinn", 0), (902, "plain " * 30_000, 0), (None, "rotten vermin", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score int")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, score int")
    got = {}
    for x in toxicity.toxicity(df, marks).collect():
        got.setdefault(x.doc_id, []).append((x.held_out, x.score, x.predicted))
    assert sum(map(len, got.values())) == len(docs)
    assert [p for _, _, p in got[900]] == [0, 0] and got[902][0][2] == 0
    assert got[901][0][2] == 1 and got[None][0][0] and got[None][0][2] == 1
    none = toxicity.toxicity(df, marks.limit(0)).collect()
    assert {(x.score, x.predicted) for x in none} == {(0.0, 0)}
    assert toxicity.toxicity(df.limit(0), marks).collect() == []


def test_rare_language_is_learned(spark):
    r = random.Random(7)
    lexicon = {"xx": "alpha beta gamma delta", "yy": "uno dos tres cuatro", "zz": "yksi kaksi kolme nelja"}
    langs = ["xx", "yy"] * 3000 + ["zz"] * 24
    docs = [(n, " ".join(r.choices(lexicon[x].split(), k=12)), x) for n, x in enumerate(langs)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    rows = language.identify(df, rows=150).collect()
    assert sum(x.lang_pred == "zz" for x in rows if x.doc_id >= 6000) >= 22
    assert sum(x.lang_pred == langs[x.doc_id] for x in rows) >= 0.99 * len(docs)
    sample = language.sample_of(df.selectExpr("text", "lang AS label"), 150).collect()
    assert sum(x.label == "zz" for x in sample) >= 20 and len(sample) <= 400


def test_shares_keep_rare_labels_whole():
    shares = language.shares_of({"a": 89_995, "b": 9_900, "c": 100, "d": 5}, 1000, 100)
    assert shares == {"a": pytest.approx(0.01), "b": pytest.approx(100 / 9900), "c": 1.0, "d": 1.0}


def test_rare_toxic_texts_are_learned(spark):
    r = random.Random(3)
    plain = [f"word{n}" for n in range(300)]
    docs = []
    for n in range(6000):
        own = r.choices(plain, k=12)
        if n % 150 == 0:
            own[2:2], own[8:8] = ["rotten"], ["vermin"]
        docs.append((n, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame([(n, int(n % 150 == 0)) for n, _ in docs], "doc_id long, toxic int")
    found = {x.doc_id: x.predicted for x in toxicity.toxicity(df, marks, rows=150).collect()}
    assert sum(found[n] for n in range(0, 6000, 150)) >= 38
    assert sum(found.values()) <= 45
