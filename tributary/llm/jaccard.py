"""Exact Jaccard join of word shingles with count-vector R-trees.

Two texts link when their sets of five-word shingles overlap by four fifths of
their union. The unit is the node: a distinct shingle set. Copies share a node
and are never expanded into pairs.

1. Shingles become 48-bit tokens, written once per row.
2. Routing: in any common order of tokens, linked sets share one of the first
   ``n - ceil(0.8 n) + 1`` tokens of either, so nodes that share such a token
   form a cell, cut where their sizes are too far apart for any link. Cells with
   the same least node become one. Frequent tokens come last in the order (this
   moves work, never results).
3. Tokens are hashed into groups, twice as many for each doubling of a set beyond
   ``WIDE`` tokens, so that the counts of unrelated long texts stay apart; sets of
   different widths are compared at the lesser one. In a cell the counts are the points of
   an R-tree whose boxes hold coordinate maxima: the sum of the minima of a
   query and a box bounds the overlap from above. Surviving pairs connect nodes
   to candidate groups; a linked pair is always in one group.
4. In a candidate group, where each node has its tokens once, the tree yields
   pairs again, and they are verified, skipping pairs already connected.
5. Cells and groups beyond ``LEAF_WEIGHT`` are cut into leaves. Neighbouring
   leaves are joined first; then every pair of leaves whose boxes may hold a link
   between nodes not yet connected. So no task holds a whole cell, and no link
   between different components is missed.

Null or wordless texts have no shingles and link with nothing. Rows that repeat
an id are rows of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import giving_back, ranges, row_of, settled, split_words, stored, text_chunks, texts
from tributary.llm.components import components

SIZE = 5
GROUPS = 256
WIDE = 1024  # tokens of the largest set with GROUPS groups
FANOUT = 16
# A leaf ends where its tokens, and LEAST_WEIGHT more for each node, reach this.
LEAF_WEIGHT = 1_000_000
LEAST_WEIGHT = 500
# Frequent tokens are those seen in this many nodes of batches that hold them
# more than once; at most so many are broadcast (8 bytes each).
FREQUENT = 500
MOST_FREQUENT = 200_000
# Nodes, or rows of work (four numbers each), broadcast at once; more work goes in several passes.
MOST_BROADCAST = 1_000_000
# A token and, in its low bits, the logarithm of a set's size in thousandths. Sizes
# whose logarithms are so many thousandths apart differ by more than 5 : 4.
SIZE_BITS = 16
TOO_FAR = 225
FULL, BOX_FULL = 15, 65_535  # counts of a point are stored in four bits, of a box in two bytes
# Sets of so many tokens are stored with five bytes a token and their upper bytes, which
# ascend, as a bitmap; smaller ones with six, and these take fewer bytes than any of the former.
SPLIT, LOW, WHOLE = 43, 5, 6
CHUNK = 4 << 20  # bytes of text or tokens handled at once
TOKEN_MASK = np.uint64((1 << 48) - 1)
ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_tokens(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle tokens of every text, ascending, and the texts' offsets."""
    codes, offsets, words = split_words(pc.ascii_lower(values))
    hashes = np.fromiter(
        map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, count=len(words)
    )
    counts = np.diff(offsets)
    padded = np.concatenate([hashes[codes], np.zeros(SIZE, np.uint64)])
    windows = np.where(counts >= SIZE, counts - SIZE + 1, np.minimum(counts, 1))
    at = ranges(offsets[:-1], windows)
    rows = np.repeat(np.arange(len(counts)), windows)
    total = np.zeros(len(at), np.uint64)
    length = np.minimum(counts, SIZE)[rows]
    for k in range(SIZE):
        total += np.where(k < length, padded[at + k] * ODD[k], np.uint64(0))
    tokens = mix(total + length.astype(np.uint64)) & TOKEN_MASK
    keys = np.sort(rows.astype(np.uint64) << np.uint64(48) | tokens)
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    sizes = np.bincount((keys >> np.uint64(48)).astype(np.int64), minlength=len(counts))
    return keys & TOKEN_MASK, np.concatenate([[0], np.cumsum(sizes)])


def _places(offsets: np.ndarray, starts: np.ndarray, split: np.ndarray):
    """Each token's row, place in its row, first byte and whether its row is split."""
    rows = row_of(offsets)
    place = np.arange(len(rows)) - offsets[rows]
    own = split[rows]
    return rows, place, starts[rows] + place * np.where(own, LOW, WHOLE), own


def packed(tokens: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """About 5.2 bytes a token, one binary value per row; tokens ascend within a row."""
    sizes = np.diff(offsets)
    split = sizes >= SPLIT
    maps = np.where(split, (sizes + 256 + 7) // 8, 0)
    ends = np.concatenate([[0], np.cumsum(np.where(split, LOW, WHOLE) * sizes + maps)])
    rows, place, at, own = _places(offsets, ends[:-1], split)
    data = np.zeros(int(ends[-1]), np.uint8)
    first = tokens << np.where(own, np.uint64(64 - 8 * LOW), np.uint64(64 - 8 * WHOLE))
    parts = first.astype(">u8").view(np.uint8).reshape(-1, 8)
    for k in range(LOW):
        data[at + k] = parts[:, k]
    data[at[~own] + LOW] = parts[~own, LOW]
    # the upper byte u of the i-th token sets bit u + i
    bits = np.zeros(8 * int(maps.sum()), np.uint8)
    upper = (tokens >> np.uint64(8 * LOW)).astype(np.int64)
    bits[(8 * (np.cumsum(maps) - maps)[rows] + place + upper)[own]] = 1
    data[ranges(ends[:-1] + LOW * sizes, maps)] = np.packbits(bits)
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]
    )


def unpacked(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and offsets of a column made by ``packed``."""
    values = pa.concat_arrays([values])
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset :][: len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    starts, lengths = ends[:-1].astype(np.int64) - ends[0], np.diff(ends).astype(np.int64)
    split = lengths > WHOLE * (SPLIT - 1)
    # 8 * length is 41 * size + 256, and at most 7 more
    sizes = np.where(split, (8 * lengths - 256) // (8 * LOW + 1), lengths // WHOLE)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    rows, place, at, own = _places(offsets, starts, split)
    # the eight bytes from every byte on, as numbers
    eight = np.ndarray(len(data) + 1, ">u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    tokens = eight[at].astype(np.uint64)
    tokens >>= np.where(own, np.uint64(64 - 8 * LOW), np.uint64(64 - 8 * WHOLE))
    maps = np.where(split, lengths - LOW * sizes, 0)
    bits = np.flatnonzero(np.unpackbits(data[ranges(starts + LOW * sizes, maps)]))
    upper = bits - (8 * (np.cumsum(maps) - maps)[rows] + place)[own]
    tokens[own] |= upper.astype(np.uint64) << np.uint64(8 * LOW)
    return tokens, offsets


def _nodes(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name of each token set; 0 for the empty set."""
    sizes = np.diff(offsets)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens + np.uint64(1)), dtype=np.uint64)])
    names = mix(sums[offsets[1:]] - sums[offsets[:-1]] + sizes.astype(np.uint64))
    return np.where(sizes > 0, names, np.uint64(0)).view(np.int64)


@giving_back
def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in text_chunks(batches, limit=CHUNK // 2):
        for start in range(0, whole.num_rows, 1 << 16):
            batch = whole.slice(start, 1 << 16)
            tokens, offsets = shingle_tokens(texts(batch))
            rest = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in rest),
                    pa.array(_nodes(tokens, offsets)),
                    pa.array(np.diff(offsets)),
                    packed(tokens, offsets),
                ],
                names=[*rest, "node", "n_shingles", "tokens"],
            )


def _first_of_node(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row of each node with shingles."""
    names = batch.column("node").to_numpy()
    _, first = np.unique(names, return_index=True)
    return batch.take(pa.array(np.sort(first[names[first] != 0])))


@giving_back
def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches, "tokens", 2 * CHUNK):
        tokens, _ = unpacked(_first_of_node(batch).column("tokens"))
        found, counts = np.unique(tokens, return_counts=True)
        often = counts > 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(found[often].view(np.int64)), pa.array(counts[often])], names=["token", "n"]
        )


def _frequent(shingles: DataFrame) -> np.ndarray:
    """The most frequent tokens, at most ``MOST_FREQUENT``, ascending."""
    rows = (
        shingles.select("node", "tokens")
        .mapInArrow(_common, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= FREQUENT)
        .orderBy(F.desc("n"), "token")
        .limit(MOST_FREQUENT)
        .select("token")
        .toArrow()
    )
    return np.sort(rows.column("token").to_numpy()).astype(np.uint64)


def _prefixes(frequent: np.ndarray):
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in text_chunks(batches, "tokens", CHUNK):
            batch = _first_of_node(whole)
            tokens, offsets = unpacked(batch.column("tokens"))
            sizes = np.diff(offsets)
            rows = row_of(offsets)
            late = np.isin(tokens, frequent)
            order = np.lexsort((late, rows))  # tokens ascend within a row already
            lengths = sizes - (4 * sizes + 4) // 5 + 1
            at = ranges(offsets[:-1], lengths)
            logs = np.floor(1000 * np.log(sizes)).astype(np.uint64)
            keys = tokens[order][at] << np.uint64(SIZE_BITS) | logs[rows[at]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), batch.column("node").take(pa.array(rows[at]))],
                names=["key", "node"],
            )

    return run


def group_counts(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The points: tokens of each set per group."""
    rows = row_of(offsets)
    flat = rows * GROUPS + (tokens % np.uint64(GROUPS)).astype(np.int64)
    size = len(offsets) - 1
    return np.bincount(flat, minlength=size * GROUPS).reshape(size, GROUPS).astype(np.int32)


class Points:
    """Group counts of sets, at most ``FULL``; a set of class c has ``GROUPS << c`` of them.

    Sets that may link differ by one class at most.
    """

    def __init__(self, flat: np.ndarray, widths: np.ndarray):
        self.flat, self.starts = flat, np.cumsum(widths) - widths
        self.classes = np.log2(np.maximum(widths, 1) // GROUPS).astype(np.int64)

    @classmethod
    def of(cls, tokens: np.ndarray, offsets: np.ndarray) -> Points:
        sizes = np.diff(offsets)
        doublings = np.ceil(np.log2(np.maximum(sizes, WIDE) / WIDE)).astype(np.int64)
        widths = np.int64(GROUPS) << doublings
        starts, rows = np.cumsum(widths) - widths, row_of(offsets)
        groups = (tokens % widths[rows].astype(np.uint64)).astype(np.int64)
        counts = np.bincount(starts[rows] + groups, minlength=int(widths.sum()))
        return cls(np.minimum(counts, FULL).astype(np.uint8), widths)

    @classmethod
    def read(cls, column: pa.ChunkedArray) -> Points:
        column = pa.concat_arrays(column.chunks)
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        flat = np.stack([data >> 4, data & 15], axis=1).reshape(-1)
        return cls(flat, 2 * np.diff(ends).astype(np.int64))

    def binary(self) -> pa.Array:
        ends = (np.append(self.starts, len(self.flat)) // 2).astype(np.int32)
        data = self.flat[0::2] << 4 | self.flat[1::2]
        return pa.Array.from_buffers(
            pa.binary(), len(self.starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]
        )

    def rows(self, start: int, stop: int) -> Points:
        """The points of these rows."""
        widths = np.int64(GROUPS) << self.classes[start:stop]
        first = int(self.starts[start]) if start < stop else 0
        return Points(self.flat[first : first + int(widths.sum())], widths)

    def dense(self, rows: np.ndarray, at: int) -> np.ndarray:
        """Counts of some rows, of class ``at`` or above, folded to that class."""
        width = GROUPS << at
        out = np.zeros((len(rows), width), np.int32)
        for c in np.unique(self.classes[rows]).tolist():
            own = np.flatnonzero(self.classes[rows] == c)
            for fold in range(1 << (c - at)):
                counts = self.flat[(self.starts[rows[own]] + fold * width)[:, None] + np.arange(width)]
                # at least FULL: bounds stay bounds
                out[own] += np.where(counts == FULL, np.int32(1 << 22), counts)
        return out


class CountTree:
    """Bulk-loaded R-tree of group counts: boxes of FANOUT entries with maxima and size range."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((*points.T[:4], sizes))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > FANOUT:
            top, low, high = self.levels[-1]
            cuts = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (
                    np.maximum.reduceat(top, cuts),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                )
            )

    def matches(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, indexed point) that the bound on the overlap lets through."""
        depth = len(self.levels) - 1
        count = len(self.levels[depth][1])
        query = np.repeat(np.arange(len(sizes)), count)
        entry = np.tile(np.arange(count), len(sizes))
        while True:
            query, entry = self._passing(depth, query, entry, points, sizes)
            if not depth:
                return query, self.order[entry]
            depth -= 1
            count = len(self.levels[depth][1])
            starts = entry * FANOUT
            lengths = np.minimum(FANOUT, count - starts)
            query, entry = np.repeat(query, lengths), ranges(starts, lengths)

    def _passing(self, depth, query, entry, points, sizes):
        top, low, high = self.levels[depth]
        step = max(1, 8_000 * GROUPS // top.shape[1])
        n = sizes[query]
        fits = (4 * low[entry] <= 5 * n) & (5 * high[entry] >= 4 * n)
        query, entry = query[fits], entry[fits]
        keep = np.zeros(len(query), bool)
        for start in range(0, len(query), step):
            q, e = query[start : start + step], entry[start : start + step]
            bound = np.minimum(points[q], top[e]).sum(1)
            keep[start : start + step] = 9 * bound >= 4 * (sizes[q] + low[e])
        return query[keep], entry[keep]


def box_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The most tokens points of two boxes can share."""
    return np.minimum(a, b).sum(-1)


def point_pairs(
    points: Points, sizes: np.ndarray, sides: np.ndarray, parts: np.ndarray, step: int = 64
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of different parts that the trees let through, some queries at a time.

    Points of side 1 are looked up in the trees of side 0, or, where side 1 is
    empty, those of side 0 among themselves. Each class has a tree, which points
    of its own and of the next class are looked up in. ``parts`` may change in between.
    """
    two = sides.any()
    for c in np.unique(points.classes).tolist():
        own, above = points.classes == c, points.classes == c + 1
        jobs = [(own, own | above)]
        if two:
            left, right = sides == 0, sides == 1
            jobs = [(own & left, (own | above) & right), (above & left, own & right)]
        for indexed, asking in jobs:
            indexed, asking = np.flatnonzero(indexed), np.flatnonzero(asking)
            if not len(indexed) or not len(asking):
                continue
            tree = CountTree(points.dense(indexed, c), sizes[indexed])
            for start in range(0, len(asking), step):
                ask = asking[start : start + step]
                query, entry = tree.matches(points.dense(ask, c), sizes[ask])
                a, b = ask[query], indexed[entry]
                different = parts[a] != parts[b]
                yield a[different], b[different]


def _connect(pairs, parts: np.ndarray, holds) -> list[tuple[int, int]]:
    """The pairs for which ``holds`` is true and that connect two parts; parts are merged."""
    links = []
    for left, right in pairs:
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            if parts[a] != parts[b] and holds(a, b):
                links.append((a, b))
                parts[parts == parts[b]] = parts[a]
    return links


def candidate_links(
    points: Points, sizes: np.ndarray, sides: np.ndarray, parts: np.ndarray
) -> list[tuple[int, int]]:
    """Pairs the trees let through, as many as connect what they connect."""
    parts = np.unique(parts, return_inverse=True)[1]
    return _connect(point_pairs(points, sizes, sides, parts), parts, lambda a, b: True)


def cell_links(
    tokens: np.ndarray, offsets: np.ndarray, sides: np.ndarray, parts: np.ndarray
) -> list[tuple[int, int]]:
    """Verified links that connect the parts of one group of work."""

    def linked(a: int, b: int) -> bool:
        mine, other = tokens[offsets[a] : offsets[a + 1]], tokens[offsets[b] : offsets[b + 1]]
        places = np.searchsorted(other, mine)
        common = int((other[np.minimum(places, len(other) - 1)] == mine).sum())
        return 100 * common >= 80 * (len(mine) + len(other) - common)

    parts = np.unique(parts, return_inverse=True)[1]
    points = Points.of(tokens, offsets)
    return _connect(point_pairs(points, np.diff(offsets), sides, parts), parts, linked)


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, list]]:
    """Rows of a partition sorted by ``keys`` as tables of whole groups, with the groups' borders."""
    held: list[pa.RecordBatch] = []

    def changes(table) -> np.ndarray:
        columns = [table.column(k).to_numpy() for k in keys]
        return np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1

    def cut(table: pa.Table) -> tuple[pa.Table, list]:
        borders = [0, *changes(table).tolist(), table.num_rows]
        return table, list(zip(borders[:-1], borders[1:], strict=True))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if len(held) > 1:
            same = all(held[0].column(k)[0].as_py() == batch.column(k)[-1].as_py() for k in keys)
        else:
            same = not len(changes(batch))
        if same:  # one group so far, and it may go on
            continue
        table = pa.Table.from_batches(held)
        last = int(changes(table)[-1])
        yield cut(table.slice(0, last))
        held = table.slice(last).combine_chunks().to_batches()
    if held:
        yield cut(pa.Table.from_batches(held))


def _tops(table: pa.Table, name: str) -> np.ndarray:
    """The maxima of boxes."""
    column = pa.concat_arrays(table.column(name).chunks)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    tops = data.view(np.uint16).reshape(len(column), GROUPS).astype(np.int32)
    tops[tops == BOX_FULL] = 1 << 22
    return tops


def _binary(tops: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(np.minimum(tops, BOX_FULL).astype(np.uint16))
    ends = (np.arange(len(tops) + 1) * GROUPS * 2).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(tops), [None, pa.py_buffer(ends), pa.py_buffer(data)]
    )


@giving_back
def _pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in text_chunks(batches, "tokens", CHUNK):
        batch = _first_of_node(whole)
        tokens, offsets = unpacked(batch.column("tokens"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                pa.array(np.diff(offsets)),
                Points.of(tokens, offsets).binary(),
            ],
            names=["node", "n", "point"],
        )


def _ends(pairs: list) -> pa.RecordBatch:
    ends = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


@giving_back
def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate links of each group of work."""
    for table, groups in _whole_groups(batches, ["work"]):
        points = Points.read(table.column("point"))
        nodes, sizes, sides, parts = (
            table.column(c).to_numpy() for c in ("node", "n", "side", "part")
        )
        pairs = []
        for start, stop in groups:
            own = slice(start, stop)
            found = candidate_links(points.rows(start, stop), sizes[own], sides[own], parts[own])
            pairs += [(nodes[start + a], nodes[start + b]) for a, b in found]
        yield _ends(pairs)


@giving_back
def _new_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows less those that repeat a node and its work within the task."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        pairs = zip(batch.column("work").to_pylist(), batch.column("node").to_pylist(), strict=True)
        new = []
        for at, pair in enumerate(pairs):
            if pair not in seen:
                seen.add(pair)
                new.append(at)
        yield batch.take(pa.array(new, pa.int64()))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by work and node less those that repeat the one before."""
    last = None
    for batch in batches:
        work, node = (batch.column(c).to_numpy() for c in ("work", "node"))
        if not len(work):
            continue
        new = np.ones(len(work), bool)
        new[1:] = (work[1:] != work[:-1]) | (node[1:] != node[:-1])
        new[0] = (work[0], node[0]) != last
        last = work[-1], node[-1]
        yield batch.filter(pa.array(new))


@giving_back
def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verified links of each group of work; rows are sorted by work and node."""
    for table, groups in _whole_groups(_once(batches), ["work"]):
        nodes, sides, parts = (table.column(c).to_numpy() for c in ("node", "side", "part"))
        pairs = []
        for start, stop in groups:
            own = table.column("tokens").slice(start, stop - start)
            tokens, offsets = unpacked(pa.concat_arrays(own.chunks))
            found = cell_links(tokens, offsets, sides[start:stop], parts[start:stop])
            pairs += [(nodes[start + a], nodes[start + b]) for a, b in found]
        yield _ends(pairs)


def _boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The box of every leaf: maxima, size range, and its part if it has but one."""
    for table, groups in _whole_groups(batches, ["cell", "leaf"]):
        cuts = np.array([start for start, _ in groups])
        sizes, parts = table.column("n").to_numpy(), table.column("part").to_numpy()
        low, high = np.minimum.reduceat(parts, cuts), np.maximum.reduceat(parts, cuts)
        points = Points.read(table.column("point")).dense(np.arange(table.num_rows), 0)
        yield pa.RecordBatch.from_arrays(
            [
                table.column("cell").combine_chunks().take(pa.array(cuts)),
                table.column("leaf").combine_chunks().take(pa.array(cuts)),
                pa.array(np.minimum.reduceat(sizes, cuts)),
                pa.array(np.maximum.reduceat(sizes, cuts)),
                pa.array(low, mask=low != high),
                _binary(np.maximum.reduceat(points, cuts)),
            ],
            names=["cell", "leaf", "low", "high", "part", "top"],
        )


def _near_boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        need = 4 * (table.column("low").to_numpy() + table.column("low_b").to_numpy())
        near = 9 * box_bound(_tops(table, "top"), _tops(table, "top_b")) >= need
        yield from table.select(["cell", "a", "b"]).filter(pa.array(near)).to_batches()


def _leaf_pairs(several: DataFrame) -> DataFrame:
    """(cell, a, b) for leaves of one cell whose boxes may hold a link between different parts."""
    boxes = (
        several.select("cell", "leaf", "part", "n", "point")
        .repartition("cell", "leaf")
        .sortWithinPartitions("cell", "leaf")
        .mapInArrow(_boxes, "cell long, leaf int, low long, high long, part long, top binary")
    )
    boxes = stored(boxes, "boxes")
    other = boxes.select(
        "cell",
        F.col("leaf").alias("b"),
        *[F.col(c).alias(f"{c}_b") for c in ("low", "high", "part", "top")],
    )
    return (
        boxes.withColumnRenamed("leaf", "a")
        .join(other, "cell")
        .filter("a <= b AND NOT coalesce(part = part_b, false)")
        .filter("5 * high_b >= 4 * low AND 5 * high >= 4 * low_b")
        .select("cell", "a", "b", "low", "low_b", "top", "top_b")
        .mapInArrow(_near_boxes, "cell long, a int, b int")
    )


def _leaf(name: str, side: int):
    return F.struct(F.col(name).alias("leaf"), F.lit(side).alias("side"))


def _place(leaf: Column, alone: bool, side: int) -> Column:
    return F.struct(leaf.alias("leaf"), F.lit(alone).alias("alone"), F.lit(side).alias("side"))


def _placed(cells: DataFrame) -> DataFrame:
    """Rows (cell, node, part, n) with their leaf and the number of leaves of their cell."""
    in_cell = Window.partitionBy("cell")
    before = F.sum(F.col("n") + LEAST_WEIGHT).over(
        in_cell.orderBy("part", "n", "node").rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = cells.withColumn("leaf", F.floor(F.coalesce(before, F.lit(0)) / LEAF_WEIGHT))
    ranked = reached.withColumn("leaf", F.dense_rank().over(in_cell.orderBy("leaf")) - 1)
    return ranked.withColumn("leaves", F.max("leaf").over(in_cell) + 1)


def _search(rows: DataFrame, verify: bool) -> DataFrame:
    """Links (a, b) of every group of work; rows are (work, side, node, part) and points or tokens."""
    search, order = (_linked, ["work", "node"]) if verify else (_candidates, ["work"])
    return stored(
        rows.repartition("work").sortWithinPartitions(*order).mapInArrow(search, "a long, b long"),
        "links",
    )


def _verified(work: DataFrame, shingles: DataFrame) -> DataFrame:
    """``_search`` with the tokens of all nodes, which move but once, to their work.

    The work is broadcast, some whole groups at a time.
    """
    passes = max(1, -(-work.count() // MOST_BROADCAST))
    links = []
    for k in range(passes):
        own = work.filter(F.pmod("work", F.lit(passes)) == k)
        rows = _of_nodes(shingles, F.broadcast(own))
        links.append(_search(rows.mapInArrow(_new_rows, rows.schema), True))
    return reduce(DataFrame.unionAll, links)


def _joined(cells: DataFrame, points: DataFrame, shingles: DataFrame | None = None) -> DataFrame:
    """Links (a, b) that connect, in every cell (cell, node), what is linked there.

    Links are verified where ``shingles`` are given, else as the points bound them.
    """
    verify = shingles is not None
    sized = cells.join(points.select("node", "n"), "node")
    placed = stored(_placed(sized.withColumn("part", F.col("node"))).drop("n"), "placed")
    work = placed.filter("leaves = 1").select(
        F.xxhash64("cell").alias("work"), F.lit(0).alias("side"), "node", "part"
    )
    whole = _verified(work, shingles) if verify else _search(work.join(points, "node"), False)
    several = placed.filter("leaves > 1")
    if several.isEmpty():
        return whole
    hot = _small(stored(several.select("node").distinct(), "hot-nodes"))
    points = stored(points.join(hot, "node"), "hot-points")
    payload = points
    if verify:
        payload = stored(_of_nodes(shingles, hot).dropDuplicates(["node"]), "node-tokens")
    # a leaf by itself, and the next leaf's rows looked up in it
    leaf = F.col("leaf")
    alone, ahead, behind = _place(leaf, True, 0), _place(leaf, False, 0), _place(leaf - 1, False, 1)
    places = several.withColumn("place", F.explode(F.array(alone, ahead, behind)))
    work = places.filter("place.leaf >= 0").select(
        F.xxhash64("cell", "place.leaf", "place.alone").alias("work"), "place.side", "node", "part"
    )
    first = whole.unionAll(_search(work.join(payload, "node"), verify))
    found = components(first)
    again = (
        several.select("cell", "node")
        .join(found, "node", "left")
        .join(points.select("node", "n"), "node")
        .select("cell", "node", F.coalesce("component", "node").alias("part"), "n")
    )
    members = stored(_placed(again), "leaves")
    pairs = _leaf_pairs(members.join(points.select("node", "point"), "node"))
    places = F.when(F.col("a") == F.col("b"), F.array(_leaf("a", 0))).otherwise(
        F.array(_leaf("a", 0), _leaf("b", 1))
    )
    spread = pairs.select(
        "cell", F.xxhash64("cell", "a", "b").alias("work"), F.explode(places).alias("place")
    ).select("cell", "work", "place.leaf", "place.side")
    work = members.join(spread, ["cell", "leaf"]).select("work", "side", "node", "part")
    return first.unionAll(_search(work.join(payload, "node"), verify))


def shingle_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with their text replaced by node, n_shingles and tokens, stored."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
    schema = ", ".join([*fields, "node long", "n_shingles long", "tokens binary"])
    return stored(rows.mapInArrow(_shingled, schema), "shingles")


def _cells(shingles: DataFrame) -> DataFrame:
    """(cell, node) of nodes that share a prefix token and may link by their sizes.

    The cell is the least node of those with a token, so cells that share it are one.
    """
    prefixes = shingles.select("node", "tokens").mapInArrow(
        _prefixes(_frequent(shingles)), "key long, node long"
    )
    token = F.shiftrightunsigned("key", SIZE_BITS)
    size = F.col("key").bitwiseAND((1 << SIZE_BITS) - 1)
    by_size = Window.partitionBy("token").orderBy("size")
    # null at a token's ends
    below = F.col("size") - F.lag("size").over(by_size) < TOO_FAR
    above = F.lead("size").over(by_size) - F.col("size") < TOO_FAR
    near = (
        prefixes.repartition(token)
        .select(token.alias("token"), size.alias("size"), "node")
        .select("*", F.coalesce(below, F.lit(False)).alias("below"), above.alias("above"))
        .filter("below OR above")
    )
    # ties are peers in a sum over a range, so equal sizes stay together
    chained = near.withColumn("chain", F.sum(F.when(F.col("below"), 0).otherwise(1)).over(by_size))
    least = F.min("node").over(Window.partitionBy("token", "chain"))
    stars = stored(
        chained.select(least.alias("cell"), "node").filter("cell <> node").distinct(), "stars"
    )
    return stars.unionAll(stars.select("cell", F.col("cell").alias("node")).distinct())


def _of_nodes(shingles: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with the tokens of their node, as often as the node occurs."""
    return shingles.select("node", "tokens").join(rows, "node")


def node_components(shingles: DataFrame) -> DataFrame:
    """(node, component) of every node that links with another."""
    spark = shingles.sparkSession

    def found() -> DataFrame:
        cells = settled(spark, lambda: _cells(shingles), "cells")
        wanted = stored(cells.select("node").distinct(), "cell-nodes")
        # points first: where the join moves rows, they are not as long as tokens
        points = stored(
            shingles.select("node", "tokens")
            .mapInArrow(_pointed, "node long, n long, point binary")
            .join(_small(wanted), "node")
            .dropDuplicates(["node"]),
            "points",
        )
        groups = settled(
            spark,
            lambda: components(_joined(cells, points)).select(
                F.col("component").alias("cell"), "node"
            ),
            "groups",
        )
        return components(_joined(groups, points, shingles))

    return settled(spark, found, "node-components")


def _small(nodes: DataFrame) -> DataFrame:
    """Nodes (8 bytes each), broadcast if there are at most ``MOST_BROADCAST``; else Spark decides."""
    return F.broadcast(nodes) if nodes.count() <= MOST_BROADCAST else nodes


def _grouped(rows: DataFrame) -> DataFrame:
    """The rows with their component, ``group``; null for those without shingles."""
    shingles = shingle_rows(rows)
    found = node_components(shingles)
    return (
        shingles.drop("tokens")
        .join(found, "node", "left")
        .withColumn("group", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")))
        .drop("node", "component")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    grouped = settled(docs.sparkSession, lambda: _grouped(rows), "grouped")
    least = (
        grouped.filter("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("least"))
    )
    return grouped.join(least, "group", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` less all but one of each component, all columns as they were.

    The row with the smallest id stays (null ids last). Rows without shingles stay.
    """
    # rows with the same id and text are alike here; 96 bits name them
    keys = {"key": F.xxhash64(id_col, text_col), "mark": F.hash(id_col, text_col)}
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        *[c.alias(n) for n, c in keys.items()],
    )

    def repeated() -> DataFrame:
        grouped = settled(
            docs.sparkSession, lambda: _grouped(rows).filter("group IS NOT NULL"), "grouped"
        )
        rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "mark")
        best = grouped.groupBy("group").agg(F.min(rank).alias("best"))
        return (
            grouped.join(best, "group")
            .groupBy("key", "mark")
            .agg(F.max(rank == F.col("best")).alias("stays"), F.count(F.lit(1)).alias("n"))
            .filter("NOT stays OR n > 1")
        )

    alike = settled(docs.sparkSession, repeated, "dropped")
    count = alike.count()
    dropped = F.broadcast(alike) if count <= 500_000 else alike  # 21 bytes each
    keyed = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in keys.items()])
    kept = keyed.join(dropped, ["key", "mark"], "left_anti")
    twice = dropped.filter("stays")
    if count and not twice.isEmpty():
        again = keyed.join(twice, ["key", "mark"], "left_semi").dropDuplicates(["key", "mark"])
        kept = kept.unionByName(again)
    return kept.select("row.*")
