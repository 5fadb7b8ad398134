"""Best-fit packing of token sequences, improved by swaps.

Documents become ids, closed by an end id; only longer ones are cut into full
pieces and a rest. Rests are dealt into blocks of about ``BLOCK_BINS`` sequences
by a hash of their row, and every block is packed on its own: best fit of the
longest first, then a local search that empties the less filled sequences. It
moves a document, exchanges one for one or two for one into another underfull
sequence, each step increasing the sum of squared fills, until the number of
sequences is the least the lengths allow or no pair of sequences has a step left. A block's size is
set by the token total, so neither tasks nor blocks grow with the corpus.

Null text counts as empty and packs as its end id alone. Rows that repeat an id
are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import giving_back, ranges, stored, text_chunks, texts
from tributary.llm.tokens import WordTokens

CHUNK = 2 << 20  # bytes of text encoded at once; ids and their places take about 30 times that
CAPACITY = 4096
END_ID = 1
BLOCK_BINS = 2000
BLOCK_ROWS = 500_000  # and no more pieces than about this, however short they are


def _pieces(path: str, capacity: int, end_id: int):
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = WordTokens(path), TaskContext.get().partitionId() << 33
        for batch in text_chunks(batches, limit=CHUNK):
            ids, offsets = encoder.encode(texts(batch))
            sizes = np.diff(offsets) + 1
            closed = np.full(int(sizes.sum()), end_id, "<u4")
            starts = np.cumsum(sizes) - sizes
            closed[ranges(starts, sizes - 1)] = ids
            counts = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), counts)
            piece = ranges(np.zeros(len(sizes), np.int64), counts)
            start = piece * capacity
            length = np.minimum(capacity, sizes[owner] - start)
            at = starts[owner] + start
            sums = [zlib.crc32(closed[a : a + n]) for a, n in zip(at, length, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(sums, pa.int64()),
                    pa.array(row + np.arange(len(owner))),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "row"],
            )
            row += len(owner)

    return run


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Longest first into the fullest sequence that has room; items by number."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if a sequence has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[place].append(item)
        else:
            room, place = capacity, len(bins)
            bins.append([item])
        if room > size:
            left = by_room.setdefault(room - size, [])
            if not left:
                rooms |= 1 << (room - size)
            left.append(place)
    return bins


def _step(
    bins: list[list[int]],
    lengths: np.ndarray,
    fills: np.ndarray,
    capacity: int,
    donor: int,
    receivers: np.ndarray,
) -> int | None:
    """The exchange of the donor that fills a receiver most; the receiver's number, None if none."""
    if not len(receivers):
        return None
    own = np.array(bins[donor])
    singles = lengths[own]
    gives = [((i,), int(singles[i])) for i in range(len(own))]
    gives += [
        ((i, j), int(singles[i] + singles[j])) for i in range(len(own)) for j in range(i + 1, len(own))
    ]
    gives.sort(key=lambda g: g[1])
    sums = np.array([g[1] for g in gives])
    # what a receiver may give back: nothing, or one document
    places = np.concatenate([receivers, np.repeat(receivers, [len(bins[r]) for r in receivers])])
    backs = np.concatenate(
        [np.full(len(receivers), -1), np.array([i for r in receivers for i in bins[r]], np.int64)]
    )
    back = np.where(backs < 0, 0, lengths[backs])
    best = np.searchsorted(sums, back + capacity - fills[places], side="right") - 1
    gain = np.where(best >= 0, sums[np.maximum(best, 0)] - back, 0)
    score = np.where(gain > 0, gain * (gain + fills[places] - fills[donor]), 0)
    pick = int(np.argmax(score))
    if score[pick] <= 0:
        return None
    receiver, given = int(places[pick]), [int(own[i]) for i in gives[int(best[pick])][0]]
    bins[donor] = [i for i in bins[donor] if i not in given]
    bins[receiver] += given
    if backs[pick] >= 0:
        bins[receiver].remove(int(backs[pick]))
        bins[donor].append(int(backs[pick]))
    fills[receiver] += gain[pick]
    fills[donor] -= gain[pick]
    return receiver


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search: exchanges that increase the squared fill until sequences empty.

    Donors take turns, the least filled first, until a turn of all has no step. A donor
    that had none tries again only what has changed since.
    """
    least = -(-int(lengths.sum()) // capacity)
    count = len(bins)
    fills = np.array([lengths[b].sum() for b in bins])
    clock, changed, tried = 1, np.ones(len(bins), int), np.zeros(len(bins), int)
    moved = True
    while moved and count > least:
        moved = False
        for donor in np.argsort(fills, kind="stable").tolist():
            while count > least and 0 < fills[donor] < capacity:
                open_ = (fills > 0) & (fills < capacity)
                open_[donor] = False
                if changed[donor] <= tried[donor]:
                    open_ &= changed > tried[donor]
                receiver = _step(bins, lengths, fills, capacity, donor, np.flatnonzero(open_))
                tried[donor] = clock
                if receiver is None:
                    break
                clock += 1
                changed[[donor, receiver]] = clock
                moved = True
                count -= fills[donor] == 0
    return [b for b in bins if b]


def _packed(capacity: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("row", ignore_index=True)
        lengths = block["length"].to_numpy()
        bins = improve(best_fit(lengths, capacity), lengths, capacity)
        order = np.concatenate([np.array(b, np.int64) for b in bins])
        sizes = np.array([len(b) for b in bins])
        ends = np.cumsum(lengths[order])
        starts = ends - lengths[order]
        firsts = np.repeat(starts[np.cumsum(sizes) - sizes], sizes)
        out = block.iloc[order].copy()
        number = np.repeat(np.arange(len(bins)), sizes)
        out["sequence_id"] = (out["block"].to_numpy() << 32) + number
        out["offset"] = starts - firsts
        return out[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    block_bins: int = BLOCK_BINS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file that every executor can read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = stored(
        rows.mapInArrow(
            _pieces(tokenizer, capacity, end_id),
            "doc_id long, piece int, start long, length long, ids_crc32 long, row long",
        ),
        "pieces",
    )
    full = pieces.filter(F.col("length") == capacity)
    rests = pieces.filter(F.col("length") < capacity)
    total, count = rests.agg(F.sum("length"), F.count("*")).first()
    blocks = max(1, round((total or 0) / (capacity * block_bins)), -(-count // BLOCK_ROWS))
    packed = (
        rests.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(
            _packed(capacity),
            "doc_id long, piece int, start long, length long, ids_crc32 long, "
            "sequence_id long, offset long",
        )
    )
    alone = full.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (-F.col("row") - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionAll(alone)
