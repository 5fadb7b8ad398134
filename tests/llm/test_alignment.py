import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tributary.llm import QUERIES, alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_of():
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


BYTE = byte_of()


def groups(models, text):
    """Groups of one whole text, byte by byte."""
    a, b = models
    if not text:
        return []
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(BYTE[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [
        bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in b_ids
    ]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return []
    out, own, sizes, at = [], ([], []), [0, 0], [0, 0]
    streams = ((a_ids, a_bytes), (b_ids, b_bytes))
    while at[0] < len(a_ids) or at[1] < len(b_ids):
        side = 0 if sizes[0] <= sizes[1] else 1
        own[side].append(streams[side][0][at[side]])
        sizes[side] += len(streams[side][1][at[side]])
        at[side] += 1
        if sizes[0] == sizes[1]:
            out.append(own)
            own = ([], [])
    return out


def brute(models, docs):
    found = [groups(models, text) for _, text in docs]
    counts = Counter((a[-1], b[-1]) for doc in found for a, b in doc)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for (doc_id, _), doc in zip(docs, found, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in doc)
        links = [(a[-1], b[-1]) for a, b in doc]
        rows.append(
            (
                doc_id, sum(len(a) for a, _ in doc), sum(len(b) for _, b in doc), len(doc), len(doc),
                sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return sorted(rows, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = [
    None, "", " ", "  two  spaces ", "a", "plain words twice plain words", "tab\tand\nline\r\n end \n", "é à la carte",
    "wide space and　more  line", "x▁y", "x ▁ y", "<|endoftext|> <s> </s> <0x41> <unk>",
    "emoji \U0001f600\U0001f468‍\U0001f469 end", "don't we'll 'tis 123 4567", "\x00 null \x1f x\x1f y\x7f z",
    "日本語 テキスト", "ЖИЗНЬ " * 3, "naïve—dash “quoted” text", "    indented\n        code = 1",
    "A" * 3000, "b4se64" * 500, "word " * 2000, "́ combining é x", "�﻿ bom",
]


def test_odd_rows(spark, models):
    docs = [*enumerate(ODD), (None, ODD[5]), (3, ODD[3]), (3, "again")]
    df = spark.createDataFrame([(*d, 7, "x") for d in docs], "doc_id long, text string, chunk int, pairs string")
    for parts in (1, 5):
        assert found(alignment.alignment_digests(df.repartition(parts), A, B)) == brute(models, docs)
    assert alignment.alignment_digests(df.limit(0), A, B).collect() == []


def test_query_against_brute_force(spark, sf_dir, models):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found(QUERIES["op11_cross_tokenizer_alignment"](spark, sf_dir)) == brute(models, [tuple(d) for d in docs])


def test_groups_are_given_whole(spark, models, monkeypatch):
    docs = list(enumerate(ODD))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    for r in alignment.align(df, A, B).collect():
        got, a, b = [], 0, 0
        for a_stop, b_stop in zip(r.a_stops, r.b_stops, strict=True):
            got.append((r.a_ids[a:a_stop], r.b_ids[b:b_stop]))
            a, b = a_stop, b_stop
        assert (a, b) == (len(r.a_ids), len(r.b_ids))
        assert got == groups(models, ODD[r.doc_id])


def test_a_full_table_of_cuts_is_emptied(models, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(alignment, "MOST_WORDS", 3)
    aligner = alignment.Aligner(A, B)
    for text in ("one two three", "four five", "one six seven eight", "one two"):
        places, docs = aligner.batch(pa.array([text, None, text]))
        words = aligner.known.take(pa.array(places)).to_pylist()
        assert "".join(words) == f" {text} {text}" and docs[1] == docs[2]


def test_pointers_reach_the_last_token():
    r = np.random.default_rng(1)
    for _ in range(50):
        size = int(r.integers(1, 60))
        ends = [np.flatnonzero(np.append(r.random(size - 1) < share, True)) + 1 for share in r.random(2)]
        a, b = alignment.last_tokens(*ends)
        both = np.intersect1d(*ends)
        assert np.array_equal(a, np.searchsorted(both, ends[0])) and np.array_equal(b, np.searchsorted(both, ends[1]))


def test_one_long_text_without_a_space(models):
    import time

    import pyarrow as pa

    r = np.random.default_rng(2)
    text = "".join(r.choice(list("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/"), 1_000_000))
    aligner = alignment.Aligner(A, B)
    start = time.perf_counter()
    places, _ = aligner.batch(pa.array([text]))
    assert len(places) == 1 and aligner.words.ok.all()
    assert time.perf_counter() - start < 30


def test_stored_rows_and_blocks_are_bounded(spark, models, monkeypatch):
    """Before, a row held all documents of a chunk, and a block all rows of a task."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(alignment, "BLOCK_BYTES", 32 << 10)
    monkeypatch.setattr(alignment, "ROW_LINKS", 2000, raising=False)
    draw = np.random.default_rng(3)
    docs = [(n, " ".join(map(str, draw.integers(0, 9000, size)))) for n, size in enumerate([*[300] * 50, 5000, 0])]
    docs += [*enumerate(ODD), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    batches = alignment.aligned_batches(df, A, B)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before
    for r in batches.collect():
        assert len(r.docs) == 1 or sum(len(d.codes) for d in r.docs) <= 2000
    (path,) = batches.inputFiles()
    file = pq.ParquetFile(path.removeprefix("file:"))
    codes = [file.read_row_group(n, columns=["docs"])["docs"].nbytes for n in range(file.num_row_groups)]
    assert len(codes) > 3 and max(codes) < 200_000
    assert found(alignment.alignment_digests(df, A, B)) == brute(models, docs)


def test_cuts_encoded_in_steps_are_the_same(models, monkeypatch):
    import pyarrow as pa

    texts = pa.array([*ODD, "one two three four five", *ODD])
    whole, steps = alignment.Aligner(A, B), alignment.Aligner(A, B)
    want, want_docs = whole.batch(texts)
    monkeypatch.setattr(alignment, "STEP_WORDS", 3)
    got, docs = steps.batch(texts)
    assert np.array_equal(got, want) and np.array_equal(docs, want_docs)
    for name, one in vars(whole.words).items():
        other = getattr(steps.words, name)
        pairs = zip(one, other, strict=True) if isinstance(one, tuple) else [(one, other)]
        assert all(np.array_equal(x, y) and x.dtype == y.dtype for x, y in pairs), name
