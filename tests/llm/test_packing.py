import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm import QUERIES, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_packed(rows, documents, capacity):
    """All ids of all documents are there, whole, gapless and within the capacity."""
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    for doc_id, text in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[start : start + capacity], "<u4")
            expected.append((doc_id, piece, start, len(own), zlib.crc32(own.tobytes())))
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_query_holds_every_token(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op4_best_fit_packing"](spark, sf_dir).collect()
    used = check_packed(rows, [tuple(d) for d in docs], 4096)
    assert used <= -(-sum(r.length for r in rows) // 4096) + 1


def test_odd_rows(spark):
    docs = [(1, None), (1, ""), (1, ""), (None, "a b"), (2, "wörd x\ty " * 40), (3, " \n ")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, block string")
    check_packed(packing.pack(df, PATH, capacity=16).collect(), docs, 16)
    assert packing.pack(df.limit(0), PATH).collect() == []


def test_blocks(spark):
    docs = [(n, "word " * (n % 13)) for n in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = packing.pack(df, PATH, capacity=16, block_bins=20).collect()
    assert len({r.sequence_id >> 32 for r in rows}) > 1
    check_packed(rows, docs, 16)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=40))
def test_search_keeps_items_and_never_adds(sizes):
    lengths = np.array(sizes)
    first = packing.best_fit(lengths, 20)
    count = len(first)
    bins = packing.improve([list(b) for b in first], lengths, 20)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(lengths[b].sum() <= 20 for b in bins)
    assert -(-sum(sizes) // 20) <= len(bins) <= count


@pytest.mark.parametrize(
    ("bins", "sizes", "best"),
    [
        ([[0, 1], [2, 3], [4]], [6, 2, 5, 2, 5], 2),  # one for one
        ([[0], [1], [2]], [3, 3, 4], 1),  # moves
        ([[0, 1], [2, 3], [4, 5]], [5, 2, 3, 4, 3, 3], 2),  # two for one or better
    ],
)
def test_search_empties(bins, sizes, best):
    assert len(packing.improve(bins, np.array(sizes), 10)) == best


def test_search_goes_on_with_other_donors():
    bins = [[1, 0], [3, 4, 2], [5]]  # the least filled one has no step
    assert len(packing.improve(bins, np.array([8, 10, 4, 8, 7, 3]), 20)) == 2
    lengths = np.random.default_rng(1).integers(1200, 1500, 600)
    bins = packing.improve(packing.best_fit(lengths, 4096), lengths, 4096)
    assert sorted(i for b in bins for i in b) == list(range(600))
    assert all(lengths[b].sum() <= 4096 for b in bins)
    assert len(bins) <= 1.03 * -(-int(lengths.sum()) // 4096)


def test_blocks_of_many_empty_texts_are_bounded(spark, monkeypatch):
    """Rows without tokens of their own are dealt by their number; no sequence is wasted but one a block."""
    monkeypatch.setattr(packing, "BLOCK_ROWS", 500)
    seen = []
    packed = packing._packed

    def watched(capacity):
        inner = packed(capacity)

        def run(frame):
            if len(frame) > 700:
                raise ValueError(f"a block of {len(frame)} rows")
            return inner(frame)

        seen.append(capacity)
        return run

    monkeypatch.setattr(packing, "_packed", watched)
    docs = [(n, None if n % 2 else "") for n in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = packing.pack(df, PATH, capacity=64).collect()
    assert seen == [64]
    assert check_packed(rows, docs, 64) <= 4000 // 64 + 1 + 8
