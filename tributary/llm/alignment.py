"""Alignment of the tokens two tokenizers make of the same documents.

Tokenizer A is byte-level BPE with the usual split pattern and is given a space and
the text; tokenizer B is a SentencePiece model that adds this space itself. Both
token streams cover the same bytes. Every token points to the token of the other
stream that overlaps it farthest to the right (to itself where both end together);
doubling the pointers brings each token to the last token of its component, which
labels the group. A group ends where an A and a B token end together, and these two
tokens are its link.

Neither tokenizer has a token that goes on over a space behind a visible character,
so texts are cut there, each distinct cut of a batch is encoded and aligned once,
and what was found is put together again per document. A vocabulary of B with such
a token switches the cuts off. Links are counted over the whole corpus: a batch of
documents has a dictionary of its id pairs, and gets the counts of these pairs back.
Its documents are stored as rows of a bounded number of links in row groups of a
bounded size, so no step holds more of a task than that (or one document).

Null and empty texts, and texts whose A or B bytes are not a space and the text
(B writes a space for U+2581), have no tokens. Strings of special tokens are plain
text. Rows that repeat an id, and null ids, are rows of their own; columns other
than id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import arrow_batches, give_back, let, ranges, text_chunks
from tributary.session import scratch_path

CHUNK_BYTES = 2 << 20
MOST_WORDS = 400_000
MOST_WORD_BYTES = 24 << 20
ARROW_BYTES = CHUNK_BYTES - (128 << 10)  # so that the last text seldom goes beyond a chunk
ROW_LINKS = 1 << 16  # links of a stored row, if it is not of one document
BLOCK_BYTES = 2 << 20  # of the stored rows: a reader holds one block of them decoded
LOW = (1 << 32) - 1
STEP_WORDS = 20_000
OLD_LETTERS = "\u0250"
# Fixed value: the pattern byte-level vocabularies of this kind split texts by.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TASK_BITS = 32

ALIGNED = """
doc_id long, a_ids array<int>, b_ids array<int>, a_stops array<int>, b_stops array<int>
"""
BATCH = """
chunk long,
docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, groups_sha256: string, codes: array<int>>>,
pairs array<long>, times array<long>
"""


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


@dataclass
class Side:
    """A tokenizer: ids of texts, and the bytes of every id."""

    encode: Callable[[list[str]], list[list[int]]]
    data: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, encode, vocabulary: list[bytes]) -> Side:
        sizes = np.fromiter(map(len, vocabulary), np.int64, count=len(vocabulary))
        return cls(encode, np.frombuffer(b"".join(vocabulary), np.uint8), np.concatenate([[0], np.cumsum(sizes)]))

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.ends[ids + 1] - self.ends[ids]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.ends[ids], self.sizes(ids))]


def byte_level(path: str) -> Side:
    """A byte-level BPE file.

    Where its merges make its ids in order, a rank table of the same ids encodes the
    same and faster; it is used for texts whose letters every version of Unicode has
    (the two libraries split texts by tables of their own).
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    alphabet = _byte_alphabet()
    vocabulary = [b""] * tokenizer.get_vocab_size()
    for token, number in tokenizer.get_vocab().items():
        vocabulary[number] = bytes(alphabet[c] for c in token)
    with open(path, encoding="utf-8") as file:
        stored_form = json.load(file)
    merges = [m.split(" ") if isinstance(m, str) else m for m in stored_form["model"]["merges"]]
    numbers = stored_form["model"]["vocab"]
    split = stored_form["pre_tokenizer"]
    in_order = all(numbers["".join(m)] == 256 + n for n, m in enumerate(merges))
    usual = split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]

    def slow(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    if not (in_order and usual):
        return Side.of(slow, vocabulary)
    ranks = {vocabulary[n]: n for n in numbers.values()}
    encoding = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        found = [encoding.encode_ordinary(t) if t.isascii() or max(t) < OLD_LETTERS else None for t in texts]
        rest = [n for n, ids in enumerate(found) if ids is None]
        for n, ids in zip(rest, slow([texts[n] for n in rest]), strict=True):
            found[n] = ids
        return found

    return Side.of(encode, vocabulary)


def sentence_pieces(path: str) -> tuple[Side, bool]:
    """The model, and whether none of its pieces goes on over a space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    vocabulary, parts = [], True
    for number in range(model.vocab_size()):
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            vocabulary.append(bytes([int(piece[3:-1], 16)]))
        else:
            vocabulary.append(piece.replace("▁", " ").encode())
            parts = parts and "▁" not in piece.lstrip("▁")
    space = model.piece_to_id("▁")  # the model gives nothing, not even its own space, for an empty text

    def encode(texts: list[str]) -> list[list[int]]:
        found = model.encode([t[1:] for t in texts], num_threads=1)
        return [ids if len(t) > 1 else [space] for t, ids in zip(texts, found, strict=True)]

    return Side.of(encode, vocabulary), parts


def last_tokens(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of the A and the B tokens, by pointer jumping.

    Both streams cover the same bytes; ends grow strictly.
    """
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends, side="left")
    over_b = np.searchsorted(a_ends, b_ends, side="left")
    is_last = b_ends[over_a] == a_ends if n else np.zeros(0, bool)
    target = np.concatenate([np.where(is_last, np.arange(n), n + over_a), over_b])
    while True:
        farther = target[target]
        if np.array_equal(farther, target):
            break
        target = farther
    group = np.cumsum(is_last) - 1
    return group[target[:n]], group[target[n:]]


@dataclass
class Words:
    """Distinct cuts with their tokens: ids and offsets, group stops, links and the groups as text."""

    ok: np.ndarray
    a: tuple[np.ndarray, np.ndarray]
    b: tuple[np.ndarray, np.ndarray]
    groups: np.ndarray  # offsets into a_stops, b_stops and pairs
    a_stops: np.ndarray
    b_stops: np.ndarray
    pairs: np.ndarray
    text: tuple[np.ndarray, np.ndarray]

    @classmethod
    def none(cls) -> Words:
        def flat(kind):
            return np.zeros(0, kind), np.zeros(1, np.int64)

        ids, stops, first = flat(np.int32), np.zeros(0, np.int32), np.zeros(1, np.int64)
        return cls(np.zeros(0, bool), ids, ids, first, stops, stops, np.zeros(0, np.int64), flat(np.uint8))

    def add(self, others: list[Words]) -> None:
        """Appends the others, one array after the other, so there are never two of the whole table."""

        def offsets(parts):
            before = np.cumsum([0, *(p[-1] for p in parts)])
            return np.concatenate([parts[0][:1], *(b + p[1:] for b, p in zip(before[:-1], parts, strict=True))])

        every = [self, *others]
        for name in ("a", "b", "text"):
            parts = [getattr(w, name) for w in every]
            setattr(self, name, (np.concatenate([v for v, _ in parts]), offsets([o for _, o in parts])))
            del parts
        self.groups = offsets([w.groups for w in every])
        for name in ("ok", "a_stops", "b_stops", "pairs"):
            setattr(self, name, np.concatenate([getattr(w, name) for w in every]))


def _flat(encode: Callable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and the texts' offsets."""
    flats, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for start in range(0, len(texts), STEP_WORDS):
        found = encode(texts[start : start + STEP_WORDS])
        sizes.append(np.fromiter(map(len, found), np.int64, count=len(found)))
        flats.append(np.fromiter(chain.from_iterable(found), np.int32, count=int(sizes[-1].sum())))
    return np.concatenate(flats), np.cumsum(np.concatenate(sizes))


def _only(ids: np.ndarray, offsets: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.where(ok, np.diff(offsets), 0)
    return ids[ranges(offsets[:-1], sizes)], np.concatenate([[0], np.cumsum(sizes)])


def _covered(side: Side, ids: np.ndarray, offsets: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the tokens of each cut are its bytes."""
    stops = np.concatenate([[0], np.cumsum(side.sizes(ids))])[offsets]
    same = np.diff(stops) == np.diff(at)
    held = np.where(same, np.diff(at), 0)
    mine, theirs = side.bytes_of(ids)[ranges(stops[:-1], held)], data[ranges(at[:-1], held)]
    wrong = np.concatenate([[0], np.cumsum(mine != theirs)])
    ends = np.concatenate([[0], np.cumsum(held)])
    return same & (np.diff(wrong[ends]) == 0) & (held > 0)


def _written(a, b, a_group, b_group, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """All groups as text, each ended by a semicolon, and the end of each group's text."""
    a_size, b_size = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    a_stops, b_stops = np.cumsum(a_size), np.cumsum(b_size)
    a_at = np.arange(len(a)) + (b_stops - b_size)[a_group]
    b_at = np.arange(len(b)) + a_stops[b_group]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[a_at], ids[b_at] = a, b
    mark = np.zeros(len(ids), np.int64)
    mark[a_at[a_stops - 1]], mark[b_at[b_stops - 1]] = 1, 2
    marks = pa.DictionaryArray.from_arrays(pa.array(mark), pa.array([",", "|", ";"])).cast(pa.large_string())
    cells = pc.binary_join_element_wise(pa.array(ids).cast(pa.large_string()), marks, pa.scalar("", pa.large_string()))
    data, ends = _buffers(cells)
    return data, ends[1:][b_at[b_stops - 1]] if n_groups else np.zeros(0, np.int64)


def _buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large string array."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset :][: len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _large(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers)


def cuts(data: np.ndarray, offsets: np.ndarray, parts: bool) -> np.ndarray:
    """Starts of the cuts: of every text, and spaces behind a visible character.

    Behind other than ASCII a lead byte that may begin a white space forbids the cut.
    """
    start = np.zeros(len(data), bool)
    if parts and len(data) > 3:
        before = data[2:-1]
        white = (data[1:-2] == 0xC2) | ((data[:-3] >= 0xE1) & (data[:-3] <= 0xE3))
        start[3:] = (data[3:] == 0x20) & np.where(before < 0x80, (before > 0x20) & (before < 0x7F), ~white)
    start[offsets[:-1]] = True
    return np.flatnonzero(start)


class Aligner:
    """Both tokenizers with a table of cuts seen before, emptied when large."""

    def __init__(self, a_path: str, b_path: str):
        self.a = byte_level(a_path)
        self.b, self.parts = sentence_pieces(b_path)
        self._clear()

    def _clear(self) -> None:
        self.known, self.words = pa.array([], pa.large_string()), Words.none()

    def _encode(self, new: pa.Array) -> Words:
        data, at = _buffers(new)
        texts = new.to_pylist()
        a, a_offsets = _flat(self.a.encode, texts)
        b, b_offsets = _flat(self.b.encode, texts)
        ok = _covered(self.a, a, a_offsets, data, at) & _covered(self.b, b, b_offsets, data, at)
        a, a_offsets = _only(a, a_offsets, ok)
        b, b_offsets = _only(b, b_offsets, ok)
        a_ends, b_ends = np.cumsum(self.a.sizes(a)), np.cumsum(self.b.sizes(b))
        a_group, b_group = last_tokens(a_ends, b_ends)
        n_groups = int(a_group[-1]) + 1 if len(a) else 0
        a_last = np.searchsorted(a_group, np.arange(n_groups), side="right")
        b_last = np.searchsorted(b_group, np.arange(n_groups), side="right")
        groups = np.searchsorted(a_last, a_offsets, side="right")
        text, text_ends = _written(a, b, a_group, b_group, n_groups)
        word = np.repeat(np.arange(len(ok)), np.diff(groups))
        return Words(
            ok,
            (a, a_offsets),
            (b, b_offsets),
            groups,
            (a_last - a_offsets[word]).astype(np.int32),
            (b_last - b_offsets[word]).astype(np.int32),
            (a[a_last - 1].astype(np.int64) << 32) | b[b_last - 1],
            (text, np.concatenate([[0], text_ends])[groups]),
        )

    def places(self, found: pa.Array) -> np.ndarray:
        """Places of distinct cuts in the table, new ones added."""
        size = len(self.words.text[0]) + 8 * (len(self.words.a[0]) + len(self.words.b[0]))
        if len(self.known) + len(found) > MOST_WORDS or size > MOST_WORD_BYTES:
            self._clear()
        # hashes the cuts of the chunk, not the table, which may be many times larger
        asked = pc.index_in(self.known, value_set=found)
        places = np.full(len(found), -1, np.int64)
        places[asked.drop_null().to_numpy()] = np.flatnonzero(asked.is_valid().to_numpy(zero_copy_only=False))
        unknown = places < 0
        if unknown.any():
            new = found.filter(pa.array(unknown))
            places[unknown] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, new])
            self.words.add([self._encode(new.slice(n, STEP_WORDS)) for n in range(0, len(new), STEP_WORDS)])
        return places

    def batch(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of the cuts of all texts in order, and each text's offsets; none for texts without tokens."""
        values = pc.fill_null(values.cast(pa.large_string()), "")
        has = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        empty = pa.scalar("", pa.large_string())
        data, at = _buffers(pc.binary_join_element_wise(empty, values.filter(pa.array(has)), pa.scalar(" ", pa.large_string())))
        if not has.any():
            return np.zeros(0, np.int64), np.zeros(len(values) + 1, np.int64)
        starts = cuts(data, at, self.parts)
        encoded = _large(data, np.append(starts, len(data))).dictionary_encode()
        places = self.places(encoded.dictionary)[encoded.indices.to_numpy()]
        offsets = np.searchsorted(starts, at)
        wrong = np.concatenate([[0], np.cumsum(~self.words.ok[places])])
        ok = np.zeros(len(values), bool)
        ok[has] = np.diff(wrong[offsets]) == 0
        sizes = np.zeros(len(values), np.int64)
        sizes[has] = np.diff(offsets)
        first = np.cumsum(sizes) - sizes
        sizes = np.where(ok, sizes, 0)
        return places[ranges(first, sizes)], np.concatenate([[0], np.cumsum(sizes)])


def _gather(flat: np.ndarray, offsets: np.ndarray, places: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all places in order, and the offsets of the documents in them."""
    sizes = offsets[places + 1] - offsets[places]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return flat[ranges(offsets[places], sizes)], ends[docs]


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _aligned(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in text_chunks(batches, limit=CHUNK_BYTES):
            places, docs = aligner.batch(batch.column("text"))
            w = aligner.words
            lists = []
            for (ids, offsets), stops in ((w.a, w.a_stops), (w.b, w.b_stops)):
                lists.append(_lists(*_gather(ids, offsets, places, docs)))
                sizes = offsets[places + 1] - offsets[places]
                before = np.cumsum(sizes) - sizes
                found, ends = _gather(stops, w.groups, places, docs)
                first = np.concatenate([before, [sizes.sum()]])[docs[:-1]]
                shift = np.repeat(before, w.groups[places + 1] - w.groups[places])
                lists.append(_lists(found + shift - np.repeat(first, np.diff(ends)), ends))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists[0], lists[2], lists[1], lists[3]],
                names=["doc_id", "a_ids", "b_ids", "a_stops", "b_stops"],
            )

    return run


def _stops(sizes: np.ndarray) -> np.ndarray:
    """Borders of runs of documents that have ``ROW_LINKS`` links at most, or are one document."""
    ends, stops = np.cumsum(sizes), [0]
    while stops[-1] < len(sizes):
        before = ends[stops[-1] - 1] if stops[-1] else 0
        stops.append(max(stops[-1] + 1, int(np.searchsorted(ends, before + ROW_LINKS, side="right"))))
    return np.array(stops)


def _chunk_rows(aligner: Aligner, batch: pa.RecordBatch, chunk: int) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk: its documents in order; the first row has the dictionary of all of them."""
    places, docs = aligner.batch(batch.column("text"))
    w = aligner.words
    used, code = np.unique(places, return_inverse=True)
    times = np.bincount(code, minlength=len(used))
    own, offsets = _gather(w.pairs, w.groups, used, np.arange(len(used) + 1))
    pairs, pair = np.unique(own, return_inverse=True)
    times = np.bincount(pair, np.repeat(times, np.diff(offsets)), len(pairs)).astype(np.int64)

    def per_doc(ends: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(np.diff(ends)[places])])[docs])

    counts = [per_doc(x) for x in (w.a[1], w.b[1], w.groups)]
    stops = _stops(counts[-1])
    for start, stop in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True):
        first, last = docs[start], docs[stop]
        at = docs[start : stop + 1] - first
        links, link_ends = _gather(pair, offsets, code[first:last], at)
        text, word_ends = _buffers(_large(*w.text).take(pa.array(places[first:last])))
        text, text_ends = memoryview(text), word_ends[at]
        digests = [
            hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else ""
            for s, e in zip(text_ends[:-1].tolist(), text_ends[1:].tolist(), strict=True)
        ]
        rows = pa.StructArray.from_arrays(
            [batch.column("doc_id").slice(start, stop - start), *(pa.array(c[start:stop]) for c in counts),
             pa.array(digests, pa.string()), _lists(links, link_ends)],
            names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "codes"],
        )
        one, several = pa.array([0, stop - start], pa.int32()), pa.array([0, len(pairs)], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([chunk], pa.int64()),
                pa.ListArray.from_arrays(one, rows),
                pa.ListArray.from_arrays(several, pa.array(pairs, pa.int64())),
                pa.ListArray.from_arrays(several, pa.array(times, pa.int64())),
            ],
            names=["chunk", "docs", "pairs", "times"],
        )
        pairs, times = pairs[:0], times[:0]


def _batches(a_path: str, b_path: str):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        first = TaskContext.get().partitionId() << TASK_BITS
        for number, batch in enumerate(text_chunks(batches, limit=CHUNK_BYTES)):
            yield from _chunk_rows(aligner, batch, first + number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from encoded(batches)
        give_back()

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its A and B ids, and how many of each precede the end of every group."""
    return _rows(docs, id_col, text_col).mapInArrow(_aligned(a_path, b_path), ALIGNED)


def aligned_batches(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Stored batches of documents: digests and links by code, the distinct id pairs and their counts.

    A batch (``chunk``) is some rows, of which the first has the pairs and their counts.
    """
    found = _rows(docs, id_col, text_col).mapInArrow(_batches(a_path, b_path), BATCH)
    path = scratch_path(docs.sparkSession, "aligned")
    # the size of a block or page is looked at after so many rows, by default 100
    sizes = {"parquet.block.size": BLOCK_BYTES, "parquet.page.size.row.check.min": 1}
    with arrow_batches(docs.sparkSession, ARROW_BYTES):
        found.write.options(**sizes).parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def _pairs(batches: DataFrame) -> DataFrame:
    return batches.select("chunk", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))


def link_counts(batches: DataFrame) -> DataFrame:
    """Corpus-wide table of linked ids: (pair, n, is_best); pair is the A id shifted by 32 bits and the B id.

    ``is_best`` marks the pairs whose count is the highest of their B id. A B id has
    at most as many pairs as A has ids.
    """
    counts = _pairs(batches).groupBy("pair").agg(F.sum("times").alias("n"))
    highest = F.max("n").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit(LOW))))
    return counts.select("pair", "n", (F.col("n") == highest).alias("is_best"))


def alignment_digests(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Every group holds one link. ``count_sum`` adds the corpus-wide counts of the
    document's links, ``n_best`` counts those whose count is the highest of their B id.
    """
    batches = aligned_batches(docs, a_path, b_path, id_col, text_col)
    known = _pairs(batches).join(link_counts(batches), "pair").groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("pair", "n", "is_best"))).alias("known")
    )
    joined = batches.select("chunk", "docs").join(known, "chunk", "left")

    def digest(doc, counts, best):
        def total(values):
            return F.aggregate(doc["codes"], F.lit(0).cast("long"), lambda s, code: s + F.get(values, code))

        return F.struct(
            *[doc[c].alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups")],
            doc["n_groups"].alias("n_links"),
            total(best).alias("n_best"),
            total(counts).alias("count_sum"),
            doc["groups_sha256"].alias("groups_sha256"),
        )

    best = F.transform("known.is_best", lambda x: x.cast("long"))
    rows = let(
        F.col("known.n"),
        lambda counts: let(best, lambda b: F.transform("docs", lambda doc: digest(doc, counts, b))),
    )
    return joined.select(F.inline(rows))
