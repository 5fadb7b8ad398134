import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import negatives

KIND = "vec_id long, embedding array<float>, label int, score long, place string"


def brute(rows, modulus=50):
    """Every anchor against every row, with whole numbers."""
    held = []
    for vec_id, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        held.append((vec_id, [math.floor(256 * float(np.float32(c))) for c in x], label))

    def order(hit):
        return (-hit[1], hit[0] is None, hit[0] or 0)

    out = []
    for n, (anchor, x, label) in enumerate(held):
        if anchor is None or anchor % modulus:
            continue
        hits = [
            (i, sum(a * b for a, b in zip(x, y, strict=False)), own)
            for m, (i, y, own) in enumerate(held)
            if m != n
        ]
        for positive, p, _ in sorted((h for h in hits if h[2] == label), key=order)[:5]:
            inside = [h for h in hits if h[2] != label and 50 * p <= 100 * h[1] <= 95 * p]
            for rank, (i, score, _) in enumerate(sorted(inside, key=order)[:3], 1):
                out.append((anchor, positive, rank, i, p, score))
    return sorted(out, key=str)


def mined(spark, rows, parts=3, modulus=50):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND).repartition(parts)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted((tuple(r) for r in negatives.mine(df, modulus, label).collect()), key=str)


def clustered(seed, n=400, dims=6, spread=0.2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dims))
    own = r.integers(0, 5, n)
    points = centres[own] + spread * r.normal(size=(n, dims))
    return [(i, [float(c) for c in p], int(k)) for i, (p, k) in enumerate(zip(points, own, strict=True))]


@pytest.mark.parametrize("block_rows", [16, 512])
def test_against_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(negatives.candidate_blocks, "__defaults__", (block_rows,))
    rows = clustered(1)
    assert mined(spark, rows) == brute(rows)


def test_several_passes(spark, monkeypatch):
    monkeypatch.setattr(negatives, "PASS_BYTES", 8 * 6 * 10)
    rows = clustered(2)
    assert mined(spark, rows, modulus=10) == brute(rows, 10)


ODD = [
    (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [0.25, 1.0], 2), (None, [1.0, 0.5], 1), (None, [0.75, 0.3], 3),
    (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 2),
    (5, [1.0, 0.5], None), (6, [], 1), (8, [0.7], 2), (9, [0.7, 0.0, 3.0], 2), (50, [0.0, 0.0], 4),
    (100, [-1.0, -0.5], 1), (10, [0.7, 0.3], 2), (11, [0.7, 0.3], 2), (12, [0.7, 0.3], 2), (13, [0.7, 0.3], 2),
    (350, [0.9, 0.9], 1), (16, [0.0, 0.0], 5), (17, [0.0, 0.0], 4),
]


def test_odd_rows(spark):
    assert mined(spark, ODD) == brute(ODD)
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(50, [], 1), (51, [], 1), (52, [], 2)]) == brute([(50, [], 1), (51, [], 1), (52, [], 2)])


def test_large_components_stay_exact(spark):
    rows = [(50 * i, [1e6 + i, -2e6 * (i % 3)], i % 2) for i in range(30)]
    assert mined(spark, rows) == brute(rows)


def test_a_hilbert_curve_visits_neighbours():
    """All points of a small cube, in curve order, differ by one step in one dimension."""
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = negatives.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_prune():
    r = np.random.default_rng(3)
    for _ in range(100):
        rows, one = r.integers(-300, 300, (20, 8)), r.integers(-300, 300, (4, 8))
        up, down = np.maximum(one, 0).astype(float), np.minimum(one, 0).astype(float)
        least, most = negatives.bounds(up, down, rows.min(axis=0), rows.max(axis=0))
        got = one @ rows.T
        assert (got >= least[:, None]).all() and (got <= most[:, None]).all()


def test_clustered_vectors_leave_blocks_unread(spark, monkeypatch):
    """Of far clusters only the blocks near an anchor are scored."""
    r = np.random.default_rng(4)
    rows = []
    for n in range(600):
        centre = np.eye(6)[n // 100] * 50
        rows.append((n, [float(c) for c in centre + r.normal(size=6)], n % 2))
    df = spark.createDataFrame([(*x, 1, "x") for x in rows], KIND)
    blocks = negatives.candidate_blocks(negatives.whole_vectors(df, "vec_id", "embedding", "label"), 25)
    candidates = negatives.Candidates(blocks)
    anchors = blocks.drop("part").mapInArrow(negatives._anchors(50, 5), negatives.ANCHORS).toArrow()
    near = negatives.NearSearch(anchors, candidates.n_dims, 5)
    zones = blocks.collect()
    pairs = sum(len(near.lines(z.low, z.high, z.labels_held)) for z in zones)
    assert len(zones) >= 24 and pairs < len(anchors) * len(zones) / 3
