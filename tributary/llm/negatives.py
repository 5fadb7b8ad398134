"""Hard negatives of a stated set of anchors, searched in Hilbert-ordered blocks.

Vectors become whole numbers, ``floor(256 * x)``. They are ordered along a Hilbert
curve over the dimensions of largest variance, range-partitioned and written as
Parquet, a folder per range and in it one row per block of neighbouring vectors, with
the least and the largest value of every dimension (its zone map) and the labels it
holds. For an anchor the products of its components with these bounds give an
interval for the scores of the whole block; a block is decoded and scored for an
anchor only if the interval reaches into what the anchor still looks for:

- positives: the block holds the anchor's label and may reach its fifth best score
  so far. The anchor's own block, scored when it is written, gives the first bound.
- negatives: the block holds another label and its interval meets a window
  ``50 * p <= 100 * n <= 95 * p`` of one of the anchor's positives, and may reach the
  third best score found in that window.

Anchors are taken in Hilbert order, in passes of about ``PASS_BYTES`` of vectors,
so what a task is sent has a fixed bound whatever the number of anchors. A pass
reads the folders whose merged zone maps (one row per range) at least one of its
anchors needs, and in them scores the blocks the anchors need. Tasks keep the best
rows per anchor only; the tasks' rows meet in one window per anchor of (tasks * 5)
rows at most.

Rows with a null label, a null vector, or a null or non-finite component take no
part; shorter vectors count as filled with zeros. Rows that repeat an id are rows of
their own; a null id is no anchor and comes last among equal scores. Rows are equal
in score and id: any of them, the later ones in further ranks. A score that does not
fit a long fails the job. Columns other than id, vector and label are not read. A
table without anchors, or an empty one, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import stored
from tributary.session import scratch_path

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW_SHARE, HIGH_SHARE = 50, 95  # percent of the positive's score
BLOCK_ROWS = 512
CURVE_DIMS, CURVE_BITS = 8, 7
PASS_BYTES = 16 << 20
STEP_CELLS = 4 << 20  # scores held at once
ROW_BITS, RANGE_BITS = 12, 28  # of a place: row in its block, block in its range
NO_ID = np.iinfo(np.int64).max  # stands for null
EXACT = 1 << 53  # up to here doubles add whole numbers exactly

BLOCKS = """
part int, block long, size int, n_dims int, low array<long>, high array<long>, labels_held array<long>,
ids array<long>, labels array<long>, vectors binary
"""
ANCHORS = "place long, id long, label long, bound long, vector binary"
ZONES = "part int, n_dims int, low array<long>, high array<long>, held array<long>"
ZONES_ARROW = pa.schema(
    [("part", pa.int32()), ("n_dims", pa.int32()), *((c, pa.list_(pa.int64())) for c in ("low", "high", "held"))]
)
RESULT = """
anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long
"""
FOUND = "place long, slot int, score long, id long, kept long"


def whole_vectors(
    df: DataFrame, id_col: str, vector_col: str, label_col: str, label: Column | None = None
) -> DataFrame:
    """Rows that take part: id, label and the vector as whole numbers."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    rows = df.filter(F.col(label_col).isNotNull() & x.isNotNull() & finite)
    kept = F.col(label_col) if label is None else label
    return rows.select(
        F.col(id_col).cast("long").alias("id"),
        kept.cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * SCALE)).alias("vector"),
    )


def matrix(lists: pa.Array, n_dims: int) -> np.ndarray:
    """Vectors as rows of whole numbers, filled with zeros up to ``n_dims``."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(offsets)
    flat = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    out = np.zeros((len(sizes), n_dims), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of both sides."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    ends = [max(abs(int(x.min())), abs(int(x.max()))) for x in (left, right)]
    most = ends[0] * ends[1] * left.shape[1]
    if most < EXACT:
        return np.rint(left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    if most < NO_ID:
        return left @ right.T
    exact = left.astype(object) @ right.T.astype(object)
    if max(abs(int(exact.min())), abs(int(exact.max()))) >= NO_ID:
        raise OverflowError("a score does not fit a long")
    return exact.astype(np.int64)


def bounds(up: np.ndarray, down: np.ndarray, low, high) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of vectors with any vector between ``low`` and ``high``.

    ``up`` and ``down`` are the positive and the negative parts of the vectors, in
    doubles; the interval is widened by what rounding may lose.
    """
    low, high = np.array(low, np.float64), np.array(high, np.float64)
    slack = 1 + 1e-12 * ((up - down) @ np.maximum(np.abs(low), np.abs(high)))
    return up @ low + down @ high - slack, up @ high + down @ low + slack


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve of points whose coordinates have ``bits`` bits each.

    Skilling's transform of the coordinates into the transposed index, on whole columns.
    """
    x = [c.astype(np.int64) for c in cells.T]
    for level in range(bits - 1, 0, -1):
        bit = 1 << level
        low = bit - 1
        for i in range(len(x)):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[i]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flips = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    key = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for column in x:
            key = (key << 1) | (((column ^ flips) >> level) & 1)
    return key


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension: rows, sum, sum of squares, least and largest value."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("vector")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        rows = matrix(lists, int(np.diff(offsets).max(initial=0)))
        x = rows.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(x.shape[1], dtype=np.int32)),
                pa.array(np.full(x.shape[1], float(len(x)))),
                pa.array(x.sum(axis=0)),
                pa.array((x * x).sum(axis=0)),
                pa.array(x.min(axis=0)),
                pa.array(x.max(axis=0)),
            ],
            names=["dim", "n", "s", "ss", "low", "high"],
        )


def curve_dims(rows: DataFrame, dims: int = CURVE_DIMS) -> tuple[int, list[tuple[int, float, float]]]:
    """Length of the longest vector; of the dimensions that vary most, place and ends.

    One row per dimension reaches the driver.
    """
    parts = rows.select("vector").mapInArrow(
        _moments, "dim int, n double, s double, ss double, low double, high double"
    )
    total = parts.groupBy("dim").agg(
        *[F.sum(c).alias(c) for c in ("n", "s", "ss")], F.min("low").alias("low"), F.max("high").alias("high")
    )
    found = total.select("dim", "low", "high", (F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2)).alias("v"))
    listed = sorted(found.collect(), key=lambda r: (-r["v"], r["dim"]))
    return len(listed), [(r["dim"], r["low"], r["high"]) for r in listed[:dims] if r["high"] > r["low"]]


def _with_key(n_dims: int, curve: Sequence[tuple[int, float, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("vector"), n_dims)
            cells = [
                np.clip((rows[:, d] - low) / (high - low) * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1)
                for d, low, high in curve
            ]
            key = hilbert_keys(np.stack(cells, axis=1), CURVE_BITS) if cells else np.zeros(len(rows), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "key"])

    return run


def _smallest(rows: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them all."""
    low, high = (int(rows.min()), int(rows.max())) if rows.size else (0, 0)
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return rows.astype(kind)
    return rows


def _vectors(data: bytes, n_dims: int, size: int) -> np.ndarray:
    """Rows of a block; the bytes a number takes tell its type."""
    width = len(data) // max(1, size * n_dims)
    return np.frombuffer(data, {2: np.int16, 4: np.int32}.get(width, np.int64)).reshape(size, n_dims).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, kept: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The first k along the last axis, by score down, then id, then place."""
    order = np.lexsort((kept, ids, -score), axis=-1)[..., :k]
    return tuple(np.take_along_axis(x, order, axis=-1) for x in (score, ids, kept))


NONE = np.iinfo(np.int64).min + 1  # score of an empty slot


class Block:
    """A stored block: rows ordered by id, so that the first of equal scores has the smallest."""

    def __init__(self, row: dict):
        self.number, self.size, self.n_dims = row["block"], row["size"], row["n_dims"]
        self.low, self.high = row["low"], row["high"]
        self.held = np.array(row["labels_held"], np.int64)
        self.row = row
        self._read = False

    def read(self) -> None:
        if not self._read:
            self.ids = np.array([NO_ID if i is None else i for i in self.row["ids"]], np.int64)
            self.labels = np.array(self.row["labels"], np.int64)
            self.rows = _vectors(self.row["vectors"], self.n_dims, self.size)
            self.places = (self.number << ROW_BITS) + np.arange(self.size)
            self._read = True

    def top(self, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """The k best rows of each line of scores, ties to the row with the smaller id."""
        score = score.copy()
        best = np.full((len(score), k), NONE)
        at = np.zeros((len(score), k), np.int64)
        lines = np.arange(len(score))
        for i in range(min(k, self.size)):
            at[:, i] = score.argmax(axis=1)
            best[:, i] = score[lines, at[:, i]]
            score[lines, at[:, i]] = NONE
        there = best != NONE
        return best, np.where(there, self.ids[at], NO_ID), np.where(there, self.places[at], NO_ID)


def _blocks(n_dims: int, block_rows: int):
    def pack(part: int, number: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.Table.from_batches(rows).combine_chunks()
        ids = batch.column("id").combine_chunks()
        order = np.lexsort((np.arange(len(ids)), ids.fill_null(NO_ID).to_numpy()))
        x = matrix(batch.column("vector").combine_chunks(), n_dims)[order]
        labels = batch.column("label").combine_chunks().to_numpy()[order]
        one = [
            part,
            (part << RANGE_BITS) + number,
            len(x),
            n_dims,
            x.min(axis=0).tolist(),
            x.max(axis=0).tolist(),
            np.unique(labels).tolist(),
            ids.take(pa.array(order)).to_pylist(),
            labels.tolist(),
            _smallest(x).tobytes(),
        ]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 5, pa.binary()]
        names = ["part", "block", "size", "n_dims", "low", "high", "labels_held", "ids", "labels", "vectors"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(one, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, block_rows - size)
                batch = batch.slice(taken.num_rows)
                held.append(taken)
                size += taken.num_rows
                if size == block_rows:
                    yield pack(part, number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield pack(part, number, held)

    return run


def candidate_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows in Hilbert order, stored as one row per block with its zone map."""
    n_dims, curve = curve_dims(rows)
    keyed = rows.select("id", "label", "vector").mapInArrow(
        _with_key(n_dims, curve), "id long, label long, vector array<long>, key long"
    )
    ordered = keyed.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    found = ordered.drop("key").mapInArrow(_blocks(n_dims, block_rows), BLOCKS)
    path = scratch_path(rows.sparkSession, "blocks")
    found.write.partitionBy("part").parquet(path)
    return rows.sparkSession.read.schema(found.schema).parquet(path)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch.slice(i, 1).to_pylist()[0])


def _anchors(modulus: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _rows_of(batches):
            block.read()
            at = np.flatnonzero((block.ids != NO_ID) & (block.ids % modulus == 0))
            if not len(at):
                continue
            own = scores(block.rows[at], block.rows)
            own[block.labels[at][:, None] != block.labels[None, :]] = NONE
            own[np.arange(len(at)), at] = NONE
            bound = np.sort(own, axis=1)[:, -k] if block.size >= k else np.full(len(at), NONE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.places[at]),
                    pa.array(block.ids[at]),
                    pa.array(block.labels[at]),
                    pa.array(bound),
                    pa.array([row.tobytes() for row in block.rows[at]], pa.binary()),
                ],
                names=["place", "id", "label", "bound", "vector"],
            )

    return run


class Pass:
    """The anchors of one pass, and the best rows a task has found for them so far."""

    def __init__(self, anchors: pa.Table, n_dims: int, k: int, slots: int = 1):
        self.places = anchors.column("place").to_numpy()
        self.labels = anchors.column("label").to_numpy()
        data = b"".join(anchors.column("vector").to_pylist())
        self.rows = np.frombuffer(data, np.int64).reshape(len(self.places), n_dims)
        self.up = np.maximum(self.rows, 0).astype(np.float64)
        self.down = np.minimum(self.rows, 0).astype(np.float64)
        shape = (len(self.places), slots, k)
        self.score, self.ids = np.full(shape, NONE), np.full(shape, NO_ID)
        self.kept, self.k = np.full(shape, NO_ID), k

    def keep(self, lines: np.ndarray, slot: int, found: tuple[np.ndarray, ...]) -> None:
        merged = [np.concatenate([old[lines, slot], new], axis=1) for old, new in zip((self.score, self.ids, self.kept), found, strict=True)]
        for old, new in zip((self.score, self.ids, self.kept), _best(*merged, self.k), strict=True):
            old[lines, slot] = new

    def steps(self, lines: np.ndarray, block: Block) -> Iterator[np.ndarray]:
        step = max(1, STEP_CELLS // max(1, block.size))
        for start in range(0, len(lines), step):
            yield lines[start : start + step]

    def result(self) -> pa.RecordBatch:
        there = self.score != NONE
        line, slot, _ = np.nonzero(there)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.places[line]),
                pa.array(slot.astype(np.int32)),
                pa.array(self.score[there]),
                pa.array(self.ids[there]),
                pa.array(self.kept[there]),
            ],
            names=["place", "slot", "score", "id", "kept"],
        )


class NearSearch:
    """What an anchor's positives need: blocks of its label that may reach its bound."""

    def __init__(self, anchors: pa.Table, n_dims: int, k: int):
        self.state = Pass(anchors, n_dims, k)
        self.bound = anchors.column("bound").to_numpy()

    def lines(self, low, high, held) -> np.ndarray:
        """The anchors that need a block, by its zone map."""
        state = self.state
        _, most = bounds(state.up, state.down, low, high)
        reach = np.maximum(self.bound, state.score[:, 0, -1])
        return np.flatnonzero(np.isin(state.labels, held) & (most >= reach))

    def score(self, some: np.ndarray, block: Block) -> None:
        state = self.state
        found = scores(state.rows[some], block.rows)
        found[state.labels[some][:, None] != block.labels[None, :]] = NONE
        found[state.places[some][:, None] == block.places[None, :]] = NONE
        found[found < self.bound[some][:, None]] = NONE
        state.keep(some, 0, block.top(found, state.k))


class WindowSearch:
    """What an anchor's negatives need: blocks of other labels that meet one of its windows."""

    def __init__(self, anchors: pa.Table, n_dims: int, k: int):
        self.low, self.high = (np.array(anchors.column(c).to_pylist(), np.int64) for c in ("from", "to"))
        self.state = Pass(anchors, n_dims, k, self.low.shape[1])

    def _met(self, lines, low, high, held) -> np.ndarray:
        state = self.state
        least, most = bounds(state.up[lines], state.down[lines], low, high)
        if len(held) == 1:
            most[state.labels[lines] == held[0]] = -np.inf
        first, last = self.low[lines], self.high[lines]
        reach = np.maximum(first, state.score[lines, :, -1])
        return (first <= last) & (most[:, None] >= reach) & (least[:, None] <= last)

    def lines(self, low, high, held) -> np.ndarray:
        return np.flatnonzero(self._met(slice(None), low, high, held).any(axis=1))

    def score(self, some: np.ndarray, block: Block) -> None:
        state = self.state
        found = scores(state.rows[some], block.rows)
        found[state.labels[some][:, None] == block.labels[None, :]] = NONE
        met = self._met(some, block.low, block.high, block.held)
        for slot in range(met.shape[1]):
            own = some[met[:, slot]]
            mine = found[met[:, slot]]
            inside = (mine >= self.low[own, slot][:, None]) & (mine <= self.high[own, slot][:, None])
            state.keep(own, slot, block.top(np.where(inside, mine, NONE), state.k))


def _searched(sent: Broadcast, search, n_dims: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = search(sent.value, n_dims, k)
        for block in _rows_of(batches):
            for some in own.state.steps(own.lines(block.low, block.high, block.held), block):
                block.read()
                own.score(some, block)
        yield own.state.result()

    return run


class Candidates:
    """The stored blocks, and the merged zone map of every range (one row each, on the driver)."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks
        zones = blocks.select("part", "n_dims", "low", "high", "labels_held").mapInArrow(_merged, ZONES)
        self.zones = [z for z in zones.collect()]
        self.n_dims = self.zones[0]["n_dims"] if self.zones else 0

    def search(self, anchors: pa.Table, search, k: int) -> DataFrame:
        """Best rows of the anchors, from the ranges at least one of them needs."""
        probe = search(anchors, self.n_dims, k)
        parts = {z["part"] for z in self.zones if len(probe.lines(z["low"], z["high"], z["held"]))}
        sent = self.blocks.sparkSession.sparkContext.broadcast(anchors)
        some = self.blocks.filter(F.col("part").isin(sorted(parts)))
        return _first(some.drop("part").mapInArrow(_searched(sent, search, self.n_dims, k), FOUND), k)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zone maps of a task's blocks, merged per range."""
    merged: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            own = merged.setdefault(row["part"], [row["n_dims"], row["low"], row["high"], set()])
            own[1] = np.minimum(own[1], row["low"]).tolist()
            own[2] = np.maximum(own[2], row["high"]).tolist()
            own[3].update(row["labels_held"])
    rows = [
        {"part": part, "n_dims": n, "low": low, "high": high, "held": sorted(held)}
        for part, (n, low, high, held) in merged.items()
    ]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, ZONES_ARROW)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The best k rows of each anchor and slot over all tasks, ranked from 1."""
    order = Window.partitionBy("place", "slot").orderBy(F.desc("score"), "id", "kept")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _passes(anchors: DataFrame, n_dims: int) -> Iterator[DataFrame]:
    """Anchors in Hilbert order, ``PASS_BYTES`` of vectors and at most a fifth more at a time."""
    most = max(1, PASS_BYTES // (8 * max(1, n_dims)))
    n = -(-anchors.count() // most)
    if n == 1:
        yield anchors
    elif n:
        ends = anchors.approxQuantile("place", [i / n for i in range(1, n)], 0.1 / n)
        ends = sorted({int(e) for e in ends})
        for low, high in zip([None, *ends], [*ends, None], strict=True):
            own = F.lit(True) if low is None else F.col("place") >= low
            yield anchors.filter(own if high is None else own & (F.col("place") < high))


def _windows(anchors: pa.Table, best: pa.Table, slots: int) -> pa.Table:
    """The anchors with the ends of the score windows of their positives; an empty window ends before it begins."""
    windows: dict[int, list] = {}
    for row in best.to_pylist():
        p = row["score"]
        ends = windows.setdefault(row["place"], ([1] * slots, [0] * slots))
        ends[0][row["rank"] - 1], ends[1][row["rank"] - 1] = -(-LOW_SHARE * p // 100), HIGH_SHARE * p // 100
    held = anchors.filter(pc.is_in(anchors.column("place"), pa.array(windows.keys(), pa.int64())))
    for n, name in enumerate(("from", "to")):
        cells = [windows[p][n] for p in held.column("place").to_pylist()]
        held = held.append_column(name, pa.array(cells, pa.list_(pa.int64())))
    return held


def mine(
    df: DataFrame,
    anchor_modulus: int,
    label: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``anchor_modulus``; ``label``
    replaces the stored label.
    """
    spark = df.sparkSession
    blocks = candidate_blocks(whole_vectors(df, id_col, vector_col, label_col, label))
    candidates = Candidates(blocks)
    anchors = stored(blocks.drop("part").mapInArrow(_anchors(anchor_modulus, positives), ANCHORS), "anchors")
    out = spark.createDataFrame([], RESULT)
    for some in _passes(anchors, candidates.n_dims):
        held = some.toArrow().combine_chunks()
        best = stored(candidates.search(held, NearSearch, positives), "positives")
        windows = _windows(held, best.select("place", "rank", "score").toArrow(), positives)
        picked = candidates.search(windows, WindowSearch, negatives)
        pairs = best.join(some.select("place", F.col("id").alias("anchor_id")), "place").select(
            "place",
            (F.col("rank") - 1).alias("slot"),
            "anchor_id",
            F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        own = pairs.join(picked, ["place", "slot"]).select(
            "anchor_id",
            F.nullif("positive_id", F.lit(NO_ID)).alias("positive_id"),
            "rank",
            F.nullif("id", F.lit(NO_ID)).alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        out = out.unionByName(own)
    return out
