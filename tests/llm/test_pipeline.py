"""The pipeline against a brute-force version in plain Python, stage by stage."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from test_jaccard import brute
from test_packing import check_packed

from tributary.llm import QUERIES
from tributary.llm.secret_scan import RULES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(own):
    windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    often = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)})


def good(text):
    text = text or ""
    own, lines = words(text), text.split("\n")
    full = [x for x in lines if words(x)]
    n, chars = len(own), sum(map(len, own))
    return not (
        n < 20
        or 100 * repeated(own) > 30 * n
        or 4 * sum(c in "#*$%&|<>" for c in text) > n
        or 2 * (len(full) - len(set(full))) > len(lines)
        or 10 * sum(a == b for a, b in zip(own, own[1:], strict=False)) > 3 * n
        or 10 * sum("A" <= c <= "Z" for c in text) > 3 * chars
        or 2 * chars < 5 * n
        or chars > 12 * n
    )


def without_copies(docs):
    groups = defaultdict(list)
    for doc in docs:
        groups["".join(words(doc["text"]))].append(doc)
    return [
        min(g, key=lambda d: (-len(d["text"] or ""), d["doc_id"] is None, d["doc_id"] or 0))
        for g in groups.values()
    ]


def without_near_copies(docs):
    pairs = sorted(((d["doc_id"], d["text"]) for d in docs), key=lambda p: p[0])
    stay = {d for d, n, c in brute(pairs) if d == c}
    return [d for d in docs if d["doc_id"] in stay]


def without_secrets(docs):
    rules = [(r, re.compile(r.pattern)) for r in RULES]
    out = []
    for doc in docs:
        text = doc["text"]
        hidden = [False] * len(text)
        for rule, pattern in rules:
            for m in pattern.finditer(text):
                a, b = m.span(rule.group)
                if b - a >= rule.least:
                    hidden[a:b] = [True] * (b - a)
        shown = "".join("\0" if h else c for c, h in zip(text, hidden, strict=True))
        shown = re.sub("\0+", "[REDACTED]", shown)
        out.append({**doc, "text": shown, "n_chars": len(shown)})
    return out


def same(df, docs):
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in df.collect()]
    assert sorted(rows, key=str) == sorted((tuple(d[c] for c in COLUMNS) for d in docs), key=str)


def test_stages_against_brute_force(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [r.asDict() for r in df.collect()]
    steps = [
        lambda own: [d for d in own if good(d["text"])],
        without_copies,
        without_near_copies,
        without_secrets,
    ]
    for (_, stage), step in zip(corpus_pipeline.STAGES[:4], steps, strict=True):
        before = len(docs)
        docs = step(docs)
        df = stage(spark, df, sf_dir)
        same(df, docs)
        assert len(docs) <= before
        df = spark.createDataFrame(df.collect(), df.schema)
    rows = QUERIES["pipeline"](spark, sf_dir).collect()
    check_packed(rows, [(d["doc_id"], d["text"]) for d in docs], 4096)


def test_odd_rows(spark, sf_dir):
    clean = " ".join(f"word{n}" for n in range(40))
    other = " ".join(f"other{n}" for n in range(40)) + " password=abcdefghijkl"
    rows = [
        (1, clean, "en", None, len(clean)),
        (1, clean, "en", None, len(clean)),
        (None, clean.replace(" ", "  "), None, "s", 0),
        (2, clean + " more", "en", "s", 0),
        (3, other, None, None, None),
        (4, None, "en", "s", 0),
        (5, "", "en", "s", 0),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for empty in (False, True):
        df = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES[:4]:
            df = stage(spark, df, sf_dir)
            assert df.columns == COLUMNS
        got = {(r.doc_id, r.text) for r in df.collect()}
        masked = other.replace("abcdefghijkl", "[REDACTED]")
        assert got == (set() if empty else {(2, clean + " more"), (3, masked)}) or got == (
            set() if empty else {(1, clean), (3, masked)}
        )
        packed = corpus_pipeline.STAGES[4][1](spark, df, sf_dir).collect()
        assert len(packed) == len(got)


@pytest.mark.parametrize("extra", ["row", "group", "kept", "key", "node", "part", "words"])
def test_clashing_columns_survive(spark, sf_dir, extra):
    clean = " ".join(f"word{n}" for n in range(40))
    df = spark.createDataFrame(
        [(1, clean, None, None, 0, "x"), (2, clean, None, None, 0, "y")],
        f"doc_id long, text string, lang string, source string, n_chars long, `{extra}` string",
    )
    for _, stage in corpus_pipeline.STAGES[:4]:
        df = stage(spark, df, sf_dir)
        assert extra in df.columns
    assert df.count() == 1
