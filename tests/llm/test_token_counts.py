import base64
import re

import public_tokenizers
import pytest
import tiktoken

from tributary.llm import QUERIES, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute(encoding, text, rule):
    """Sections of one text with their counts, byte by byte."""
    parts = re.findall(r"[^\n]*\n|[^\n]+\Z", text)
    owner = [n for n, p in enumerate(parts) for _ in p.encode()]
    counts, crossing, at = [0] * len(parts), [0] * len(parts), 0
    for token in encoding.encode_ordinary(text):
        size = len(encoding.decode_single_token_bytes(token))
        held = owner[at : at + size]
        best = held[0] if rule == "first" else max(sorted(set(held)), key=held.count)
        counts[best] += 1
        crossing[best] += len(set(held)) > 1
        at += size
    out, start = [], 0
    for n, p in enumerate(parts):
        out.append((n, start, start + len(p), counts[n], crossing[n]))
        start += len(p)
    return out


def check(rows, docs, encoding, rule="most"):
    want = [(d, *s) for d, text in docs for s in brute(encoding, text or "", rule)]
    assert sorted((tuple(r) for r in rows), key=str) == sorted(want, key=str)


def test_query_against_brute_force(spark, sf_dir, encoding):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check(QUERIES["op6_token_counts"](spark, sf_dir).collect(), [tuple(d) for d in docs], encoding)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_odd_rows(spark, encoding, rule):
    docs = [
        (1, "a\n\n\n  b\n\n"), (1, "a\n\n\n  b\n\n"), (2, None), (3, ""), (4, "\n"), (None, "é\n \n\n\n \t\n日本\r\n\r\nx"),
        (5, "no break"), (6, " \n  \n   \n    \n" * 20), (7, "long " * 30_000),
    ]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, section int")
    rows = token_counts.section_tokens(df, PATH, public_tokenizers.PATTERN, rule)
    check(rows.collect(), docs, encoding, rule)
    assert any(r.n_crossing for r in rows.collect())
    assert token_counts.section_tokens(df.limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        token_counts.section_tokens(spark.range(1), PATH, "x", rule="half")
