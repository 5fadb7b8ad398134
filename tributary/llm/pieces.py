"""SentencePiece encoding and decoding by suffix-array matching.

A text is marked as the model marks it (a space is ``▁``, one goes in front) and
cut before every run of marks, which no piece crosses. The distinct cuts of a
chunk are concatenated and indexed by a suffix array over as many characters as
fit in one number, and where pieces are longer over as many more; every piece is
binary-searched for its range of occurrences. These are edges between positions. Sorted by position
they are relaxed from left to right: at each position exactly one edge continues
the encoding of the text before it, the one whose piece and its predecessor
would not have merged otherwise; for a model whose merges have an order this
gives the library's encoding. Characters no piece covers become byte pieces.
A cut of over ``LONG`` characters is relaxed as overlapping windows side by side, which
are put together where two of them part the text alike and the pieces that meet stay apart.

Null counts as empty text, which has no pieces. Decoding turns ids back into the
text; a literal ``▁`` comes back as a space. Rows that repeat an id are rows of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import ranges, text_chunks, texts

MARK = "\u2581"
FENCES = ("\0", "\x01", *map(chr, range(0x10FF00, 0x10FFFF)))
CHUNK = 2 << 20  # bytes of text indexed at once; edges and ranks take about 50 times the new cuts
MOST_KNOWN = 500_000
LONG = 2_000  # characters of the longest cut that is relaxed as a whole
STEPS = (1680, 1664, 1584)  # from window to window; the next where windows do not fit together


class Vocabulary:
    """The model's pieces, their order of merging, and what may stand side by side."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.hidden = {
            i for i in range(len(self.pieces)) if model.is_control(i) or model.is_unknown(i)
        }
        self.ids = {
            p: i for i, p in enumerate(self.pieces) if i not in self.byte_of and i not in self.hidden
        }
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        # a piece no merge leads to never occurs
        steps = {p: self._steps(p) for p in self.ids}
        self.ids = {p: i for p, i in self.ids.items() if len(steps[p]) == len(p) - 1}
        self.longest = max(map(len, self.ids))
        self.borders = Borders(self, {p: steps[p] for p in self.ids})

    def _steps(self, text: str) -> list[tuple[float, int, list[str]]]:
        """Merges of the best-scored neighbours first: (score, place, parts after it)."""
        parts, steps = list(text), []
        scores = [self.scores.get(a + b, -np.inf) for a, b in zip(parts, parts[1:], strict=False)]
        while scores:
            best = max(scores)
            if best == -np.inf:
                break
            i = scores.index(best)
            parts = [*parts[:i], parts[i] + parts[i + 1], *parts[i + 2 :]]
            steps.append((best, i, parts))
            del scores[i]
            for k in (i - 1, i):
                if 0 <= k < len(scores):
                    scores[k] = self.scores.get(parts[k] + parts[k + 1], -np.inf)
        return steps

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best-scored neighbours first."""
        steps = self._steps(text)
        return steps[-1][2] if steps else list(text)

    def agree(self, left: int, right: int) -> bool:
        """Whether the two pieces stay apart when their text is merged."""
        a, b = self.pieces[left], self.pieces[right]
        return self.merged(a + b) == [a, b]


class Borders:
    """Whether pieces side by side stay apart, for many pairs at once.

    While two pieces are merged next to each other, each is made by its own merges, in
    order of score, unless a merge over the border has its turn before. Only the parts
    that lie at the border matter: of the left piece the last part, of the right piece
    the first, each from the merge that makes it to the merge that takes it up. Two such
    parts that are there at one time merge if the vocabulary has their join and its score
    comes before the end of either. Pieces whose own scores do not fall from merge to
    merge are merged one pair at a time.
    """

    def __init__(self, v: Vocabulary, steps: dict[str, list]):
        self.vocabulary, size = v, len(v.pieces)
        self.size = size
        self.odd = np.zeros(size, bool)
        joins = {}
        spans: tuple[list, list] = ([], [])  # at the left border, at the right one
        counts = np.zeros((2, size), np.int64)
        for p, i in sorted(v.ids.items(), key=lambda item: item[1]):
            times = [-s for s, _, _ in steps[p]]
            self.odd[i] = any(a > b for a, b in zip(times, times[1:], strict=False))
            for side, spot in enumerate((0, -1)):
                part, since = p[spot], -np.inf
                for time, (_, _, parts) in zip(times, steps[p], strict=True):
                    if parts[spot] != part:
                        self.odd[i] |= time == since or part not in v.ids
                        spans[side].append((v.ids.get(part, -1), since, time))
                        counts[side, i] += 1
                        part, since = parts[spot], time
                spans[side].append((i, since, np.inf))
                counts[side, i] += 1
        for p, score in v.scores.items():
            for k in range(1, len(p)):
                if p[:k] in v.ids and p[k:] in v.ids:
                    joins[v.ids[p[:k]] * size + v.ids[p[k:]]] = -score
        self.joins = np.array(sorted(joins), np.int64)
        self.times = np.array([joins[k] for k in self.joins.tolist()])
        self.offsets = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
        self.parts, self.since, self.until = zip(
            *(
                (
                    np.array([x[0] for x in side], np.int64),
                    np.array([x[1] for x in side], np.float64),
                    np.array([x[2] for x in side], np.float64),
                )
                for side in spans
            ),
            strict=True,
        )

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = np.ones(len(left), bool)
        odd = self.odd[left] | self.odd[right]
        agree = self.vocabulary.agree
        found[odd] = [agree(a, b) for a, b in zip(left[odd].tolist(), right[odd].tolist(), strict=True)]
        plain = np.flatnonzero(~odd)
        # every part at the end of the left piece beside every part at the start of the right one
        starts, ends = self.offsets
        a, b = left[plain], right[plain]
        wide, high = ends[a + 1] - ends[a], starts[b + 1] - starts[b]
        pair = np.repeat(np.arange(len(plain)), wide * high)
        inside = ranges(np.zeros(len(plain), np.int64), wide * high)
        x, y = ends[a][pair] + inside // high[pair], starts[b][pair] + inside % high[pair]
        # of merges with one score the left one comes first
        there = (self.since[1][x] <= self.until[0][y]) & (self.since[0][y] < self.until[1][x])
        pair, x, y = pair[there], x[there], y[there]
        keys = self.parts[1][x] * self.size + self.parts[0][y]
        place = np.minimum(np.searchsorted(self.joins, keys), len(self.joins) - 1)
        joined = self.joins[place] == keys
        pair, x, y, time = pair[joined], x[joined], y[joined], self.times[place[joined]]
        meets = (time < self.until[1][x]) & (time <= self.until[0][y])
        found[plain[pair[meets]]] = False
        return found


class SuffixIndex:
    """Suffix array of code points, in order of as many of them as fit in one number.

    Where a piece is longer, the suffixes that begin as it does are put in order of
    what follows, as many code points at a time, up to the end of the piece.
    """

    def __init__(self, codes: np.ndarray, depth: int):
        # code points as small numbers in the same order; 0 stands for what the text does not hold
        self.least = int(codes.min(initial=0))
        used = np.zeros(int(codes.max(initial=0)) - self.least + 2, bool)
        used[codes - self.least] = True
        self.small = np.where(used, np.cumsum(used), 0)
        self.bits = int(self.small.max(initial=1)).bit_length()
        self.covered = min(63 // self.bits, depth)
        size = len(codes)
        padded = np.concatenate([self.small[codes - self.least], np.zeros(self.covered, np.int64)])
        first = np.zeros(size, np.int64)
        for k in range(self.covered):
            first <<= self.bits
            first |= padded[k : k + size]
        self.order = np.argsort(first)
        self.keys = first[self.order]
        # of equal beginnings the first place, counted from 1; 0 beyond the end
        place = np.arange(1, size + 1)
        place[1:][self.keys[1:] == self.keys[:-1]] = 0
        self.rank = np.zeros(size + 1, np.int64)
        self.rank[self.order] = np.maximum.accumulate(place)

    def _ranks(self, wanted: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row, the ranks (first, after the last) of suffixes that begin with it."""
        low = np.zeros(len(sizes), np.int64)
        high = np.zeros(len(sizes), np.int64)
        for k in range(self.covered):
            inside = k < sizes
            own = wanted[:, k] if k < wanted.shape[1] else 0
            low = low << self.bits | np.where(inside, own, 0)
            high = high << self.bits | np.where(inside, own, (1 << self.bits) - 1)
        return np.searchsorted(self.keys, low) + 1, np.searchsorted(self.keys, high, side="right") + 1

    def occurrences(self, wanted: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece number, start) of every occurrence of every piece."""
        inside = (wanted >= self.least) & (wanted - self.least < len(self.small))
        wanted = np.where(inside, self.small[np.where(inside, wanted - self.least, 0)], 0)
        absent = (wanted == 0) & (np.arange(wanted.shape[1]) < sizes[:, None])
        number = np.flatnonzero(~absent.any(axis=1))
        at, keys, done = self.order, np.arange(1, len(self.order) + 1), 0
        group, width = np.zeros(len(number), np.int64), len(self.order) + 2
        numbers, starts = [number[:0]], [at[:0]]
        while len(number):
            low, high = self._ranks(wanted[number, done : done + self.covered], sizes[number] - done)
            first = np.searchsorted(keys, group * width + low)
            counts = np.searchsorted(keys, group * width + high) - first
            done += self.covered
            here = sizes[number] <= done
            numbers.append(np.repeat(number[here], counts[here]))
            starts.append(at[ranges(first[here], counts[here])])
            # longer pieces go on among the suffixes that begin as they do
            on = ~here & (counts > 0)
            number = number[on]
            first, one, group = np.unique(first[on], return_index=True, return_inverse=True)
            counts = counts[on][one]
            at = at[ranges(first, counts)]
            keys = np.repeat(np.arange(len(first)), counts) * width + self.rank[at + done]
            order = np.argsort(keys)
            at, keys = at[order], keys[order]
        return np.concatenate(numbers), np.concatenate(starts)


class PieceEncoder:
    """Encodes texts; cuts seen before are kept, at most ``MOST_KNOWN``.

    Made on the driver and sent to the tasks with their code: its tables are bounded by the
    vocabulary (some 20 MB for 32,000 pieces), and each task begins without known cuts.
    """

    def __init__(self, path: str):
        self.vocabulary = v = Vocabulary(path)
        names = list(v.ids)
        self.piece_ids = np.array([v.ids[p] for p in names])
        self.sizes = np.array([len(p) for p in names])
        self.wanted = np.full((len(names), v.longest), -1, np.int64)
        for n, p in enumerate(names):
            self.wanted[n, : len(p)] = [ord(c) for c in p]
        # characters a piece begins, and its text; a byte that goes on with a character begins none
        v_size = len(v.pieces)
        self.widths = np.array([len(p) for p in v.pieces])
        self.surface = [p.replace(MARK, " ") for p in v.pieces]
        self.high = np.zeros(v_size, bool)  # bytes beyond ASCII, which need their neighbours
        for b, i in v.bytes.items():
            self.widths[i] = b & 0xC0 != 0x80
            self.high[i] = b > 127
            self.surface[i] = chr(b) if b < 128 else ""
        for i in v.hidden:
            self.surface[i] = ""
        self.surface = pa.array(self.surface, pa.string())
        self._clear()

    def _clear(self) -> None:
        self.cuts = pa.array([], pa.string())
        self.ids = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)

    def _agreeing(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        size = len(self.vocabulary.pieces)
        pairs, place = np.unique(left * size + right, return_inverse=True)
        return self.vocabulary.borders.apart(pairs // size, pairs % size)[place]

    def _encode_cuts(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all cuts, flat, and their offsets."""
        todo = set(np.flatnonzero(pc.utf8_length(values).to_numpy() > LONG).tolist())
        if not todo:
            return self._relaxed(values)
        cuts = values.to_pylist()
        found: list = [None] * len(cuts)
        short = [n for n in range(len(cuts)) if n not in todo]
        for step in STEPS:
            windows: dict[str, int] = {}
            for n in todo:
                for start in range(0, len(cuts[n]), step):
                    windows.setdefault(self._window(cuts[n], start, step), len(windows))
            ids, offsets = self._relaxed(pa.array(list(windows), pa.string()))
            for n in list(todo):
                own = self._joined(cuts[n], step, windows, ids, offsets)
                if own is not None:
                    found[n] = own
                    todo.remove(n)
            if not todo:
                break
        whole = short + sorted(todo)
        if whole:
            ids, offsets = self._relaxed(values.take(pa.array(whole)))
            for k, n in enumerate(whole):
                found[n] = ids[offsets[k] : offsets[k + 1]]
        counts = np.array([len(x) for x in found])
        return np.concatenate(found), np.concatenate([[0], np.cumsum(counts)])

    def _window(self, cut: str, start: int, step: int) -> str:
        return cut[start : start + step + 4 * self.vocabulary.longest]

    def _joined(self, cut: str, step: int, windows: dict, ids: np.ndarray, offsets: np.ndarray):
        """The ids of a cut from those of its windows; None if two windows part the text nowhere alike.

        Pieces that stay apart wherever two of them meet are the encoding, so it is exact.
        """
        done, own, at = [], None, None
        for start in range(0, len(cut), step):
            n = windows[self._window(cut, start, step)]
            new = ids[offsets[n] : offsets[n + 1]]
            widths = self.widths[new]
            places = np.where(widths > 0, start + np.cumsum(widths) - widths, -1)
            if own is not None:
                both, left, right = np.intersect1d(at, places, return_indices=True)
                for p, i, j in zip(both.tolist(), left.tolist(), right.tolist(), strict=True):
                    if p >= 0 and i and self._apart(int(own[i - 1]), int(new[j])):
                        break
                else:
                    return None
                done.append(own[:i])
                new, places = new[j:], places[j:]
            own, at = new, places
        return np.concatenate([*done, own])

    def _apart(self, left: int, right: int) -> bool:
        v = self.vocabulary
        return left in v.byte_of or right in v.byte_of or v.agree(left, right)

    def _relaxed(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all cuts, each relaxed from its start to its end."""
        v = self.vocabulary
        lengths = pc.utf8_length(cuts).to_numpy().astype(np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        ends = starts + lengths
        whole = pa.ListArray.from_arrays(pa.array([0, len(cuts)], pa.int32()), cuts)
        joined = pc.binary_join(whole, "\0")[0].as_py()
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        codes[ends[:-1]] = -1  # between two cuts
        number, start = SuffixIndex(codes, v.longest).occurrences(self.wanted, self.sizes)
        stop, piece = start + self.sizes[number], self.piece_ids[number]
        covered = np.zeros(len(codes) + 1, bool)
        covered[start[self.sizes[number] == 1]] = True
        bare = np.flatnonzero(~covered[: len(codes)] & (codes >= 0))
        start, stop = np.concatenate([start, bare]), np.concatenate([stop, bare + 1])
        piece = np.concatenate([piece, np.full(len(bare), -1)])  # -1: byte pieces
        depth = stop - np.repeat(starts, lengths + 1)[start]
        if depth.max(initial=0) < 1 << 16:
            depth = depth.astype(np.uint16)  # put in order by digits
        order = np.argsort(depth, kind="stable")
        start, stop, piece, depth = start[order], stop[order], piece[order], depth[order]
        at_start = np.zeros(len(codes) + 2, bool)
        at_start[starts] = True
        # relax: the edge that reaches a position, and the piece it ends with
        last = np.full(len(codes) + 2, -2, np.int64)
        back = np.zeros(len(codes) + 2, np.int64)
        borders = np.flatnonzero(np.diff(depth, prepend=-1, append=-1)) if len(depth) else []
        for a, b in zip(borders[:-1], borders[1:], strict=True):
            s, e, p = start[a:b], stop[a:b], piece[a:b]
            first = at_start[s]
            before = last[s]
            good = first | (before == -1) | ((before >= 0) & (p == -1))
            ask = ~good & (before >= 0)
            good[ask] = self._agreeing(before[ask], p[ask])
            last[e[good]], back[e[good]] = p[good], s[good]
        # walk back from the ends, all cuts at once
        place, owner, steps = ends.copy(), np.arange(len(cuts)), []
        alive = np.flatnonzero(place > starts)
        while len(alive):
            here = place[alive]
            steps.append((owner[alive], back[here], last[here]))
            place[alive] = back[here]
            alive = alive[place[alive] > starts[alive]]
        if not steps:
            return np.zeros(0, np.int32), np.zeros(len(cuts) + 1, np.int64)
        owner, at, found = (np.concatenate(x) for x in zip(*steps, strict=True))
        order = np.argsort(at, kind="stable")
        owner, at, found = owner[order], at[order], found[order]
        raw = np.flatnonzero(found == -1)
        if len(raw):
            spelled = [[v.bytes[b] for b in chr(c).encode("utf-8", "replace")] for c in codes[at[raw]]]
            widths = np.ones(len(found), np.int64)
            widths[raw] = [len(x) for x in spelled]
            wide = np.repeat(found, widths)
            owner = np.repeat(owner, widths)
            wide[wide == -1] = [i for x in spelled for i in x]
            found = wide
        counts = np.bincount(owner, minlength=len(cuts))
        return found.astype(np.int32), np.concatenate([[0], np.cumsum(counts)])

    def _places(self, cuts: pa.Array) -> np.ndarray:
        if len(self.cuts) + len(cuts) > MOST_KNOWN:
            self._clear()
        known = pc.index_in(cuts, value_set=self.cuts)
        new = cuts.filter(pc.is_null(known))
        places = known.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(new):
            ids, offsets = self._encode_cuts(new.cast(pa.string()))
            places[places < 0] = len(self.cuts) + np.arange(len(new))
            self.cuts = pa.concat_arrays([self.cuts, new.cast(pa.string())])
            self.ids = np.concatenate([self.ids, ids])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
        return places

    def encode(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and the texts' offsets."""
        # cut before each run of marks: a character the texts do not hold goes in front of it
        fence = next(c for c in FENCES if not pc.any(pc.match_substring(values, c)).as_py())
        spaced = pc.replace_substring(values, MARK, " ")
        fenced = pc.binary_join_element_wise(MARK, pc.replace_substring(spaced, " ", fence + MARK), "")
        fenced = pc.replace_substring(fenced, MARK + fence, MARK)
        lists = pc.split_pattern(pc.if_else(pc.equal(values, ""), "", fenced), fence)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        encoded = lists.flatten().dictionary_encode()
        places = self._places(encoded.dictionary)[encoded.indices.to_numpy(zero_copy_only=False)]
        lengths = self.offsets[places + 1] - self.offsets[places]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[ranges(self.offsets[places], lengths)], ends[offsets - offsets[0]]

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of all lists of ids, given flat."""
        pieces = self.surface.take(pa.array(ids))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pieces)
        texts = pc.utf8_slice_codeunits(pc.binary_join(lists, ""), 1)
        odd = np.unique(np.searchsorted(offsets, np.flatnonzero(self.high[ids]), side="right") - 1)
        if not len(odd):
            return texts
        alone = [self.decode(ids[offsets[n] : offsets[n + 1]]) for n in odd]
        mask = np.zeros(len(texts), bool)
        mask[odd] = True
        return pc.replace_with_mask(texts, pa.array(mask), pa.array(alone, pa.string()))

    def decode(self, ids: np.ndarray) -> str:
        """The text of a list of ids."""
        v, out, held = self.vocabulary, [], bytearray()
        for i in ids.tolist():
            if i in v.byte_of:
                held.append(v.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if i not in v.hidden:
                out.append(v.pieces[i])
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")[1:]


def _encoded(path: str):
    encoder = PieceEncoder(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, limit=CHUNK):
            values = texts(batch)
            ids, offsets = encoder.encode(values)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                ],
                names=["doc_id", "ids"],
            )

    return run


def _decoded(path: str):
    encoder = PieceEncoder(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            found = [encoder.decode(np.array(x.as_py() or [], np.int64)) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "text"]
            )

    return run


def _digests(path: str):
    encoder = PieceEncoder(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, limit=CHUNK):
            values = texts(batch)
            ids, offsets = encoder.encode(values)
            own = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            same = pc.equal(encoder.decode_all(ids, offsets), values)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in own], pa.int64()),
                    same,
                ],
                names=["doc_id", "n_pieces", "ids_crc32", "round_trip"],
            )

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the ids of every text."""
    return _rows(docs, id_col, text_col).mapInArrow(_encoded(model), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and the text of every list of ids."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(model), "doc_id long, text string")


def piece_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, CRC-32 of the ids, and whether decoding gives the text back."""
    return _rows(docs, id_col, text_col).mapInArrow(
        _digests(model), "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean"
    )
