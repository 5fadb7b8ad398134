import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tributary.llm import components, jaccard
from tributary.llm.common import settled, stored
from tributary.session import shared_dir


def shingles(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        folded = folded.replace(c, " ")
    words = [w for w in folded.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(docs):
    sets = [shingles(text) for _, text in docs]
    group = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (doc_id, _), g in zip(docs, group, strict=True):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return sorted(
        ((d, len(s), least.get(g, d)) for (d, _), s, g in zip(docs, sets, group, strict=True)), key=str
    )


def variants(seed, families=12, copies=9, words=60):
    """Families of texts whose members differ from the one before by a few words."""
    r = random.Random(seed)
    docs = []
    for _ in range(families):
        own = [f"w{r.randrange(400)}" for _ in range(r.randrange(5, words))]
        for _ in range(copies):
            docs.append(" ".join(own))
            own = own.copy()
            for _ in range(r.randrange(3)):
                own[r.randrange(len(own))] = f"w{r.randrange(400)}"
    common = " ".join(f"c{n}" for n in range(30))
    docs += [f"{common} {r.random()} {r.random()} {r.random()}" for _ in range(25)]
    r.shuffle(docs)
    return [(n * 7, text) for n, text in enumerate(docs)]


@pytest.mark.parametrize("weights", [(1_000_000, 500), (2000, 400)], ids=["one leaf", "many leaves"])
def test_links_against_brute_force(spark, monkeypatch, weights):
    monkeypatch.setattr(jaccard, "LEAF_WEIGHT", weights[0])
    monkeypatch.setattr(jaccard, "LEAST_WEIGHT", weights[1])
    docs = variants(1 if weights[1] == 500 else 2)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in jaccard.near_duplicates(df).collect()), key=str)
    assert got == brute(docs)


def test_odd_rows(spark):
    text = "one two three four five six seven"
    docs = [
        (5, None), (5, None), (4, ""), (3, " \n\t"), (9, "Word"), (8, "word"), (None, text),
        (7, text.upper()), (7, text), (2, "a b c d"), (1, "a b c d "), (6, "É x"), (10, "é x"),
    ]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, node int")
    got = sorted((tuple(r) for r in jaccard.near_duplicates(df).collect()), key=str)
    assert got == brute(docs)
    assert jaccard.near_duplicates(df.limit(0)).collect() == []


def test_tree_bound_loses_nothing():
    r = np.random.default_rng(4)
    sets = [np.sort(r.choice(3000, r.integers(1, 80), replace=False)).astype(np.uint64) for _ in range(300)]
    sets += [np.unique(np.append(s[: len(s) - 1], np.uint64(4000 + n))) for n, s in enumerate(sets[:100])]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    tokens = np.concatenate(sets)
    points = jaccard.group_counts(tokens, offsets)
    tree = jaccard.CountTree(points, np.diff(offsets))
    found = set(zip(*(x.tolist() for x in tree.matches(points, np.diff(offsets))), strict=True))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert (i, j) in found
    assert len(found) < 0.5 * len(sets) ** 2


def test_packed_tokens_come_back():
    tokens, offsets = jaccard.shingle_tokens(pa.array(["a b c d e f", None, "", "x y"]).fill_null(""))
    again, ends = jaccard.unpacked(jaccard.packed(tokens, offsets).slice(0))
    assert again.tolist() == tokens.tolist() and ends.tolist() == offsets.tolist()
    assert np.diff(offsets).tolist() == [2, 0, 0, 1]


def test_packed_sets_of_any_size_come_back_in_fewer_bytes():
    r = np.random.default_rng(6)
    sizes = [0, 1, 41, 42, 43, 44, 0, 50, 51, 300, 5000, 0]
    sets = [np.unique(r.integers(0, 1 << 48, n).astype(np.uint64)) for n in sizes]
    top = np.uint64((1 << 48) - 1)
    sets += [top - np.arange(60, dtype=np.uint64)[::-1], np.arange(60, dtype=np.uint64), top[None]]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    column = jaccard.packed(np.concatenate(sets), offsets)
    for start in range(len(sets) + 1):
        tokens, ends = jaccard.unpacked(column.slice(start))
        assert tokens.tolist() == [t for s in sets[start:] for t in s.tolist()]
        assert ends.tolist() == (offsets[start:] - offsets[start]).tolist()
    assert len(column[10].as_py()) < 5.2 * 5000


def test_components_of_chains_and_stars(spark):
    edges = [(n, n + 1) for n in range(0, 40)] + [(100, n) for n in range(101, 160)] + [(7, 7), (200, 150)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert got == {**{n: 0 for n in range(41)}, **{n: 100 for n in range(100, 160)}, 200: 100}
    assert components.components(df.limit(0)).collect() == []


def long_texts(seed):
    """Unrelated texts of up to 9,000 words and near copies of them, at the borders of the point widths too."""
    r = random.Random(seed)
    docs = []
    for words in (1026, 1030, 2050, 2200, 4100, 5000, 9000):
        for _ in range(3):
            own = [f"w{r.randrange(100_000)}" for _ in range(words)]
            docs.append(" ".join(own))
            docs.append(" ".join(own[: int(len(own) * 0.83)]))
            docs.append(" ".join(own[: int(len(own) * 0.79)]))
            docs.append(" ".join(own + ["end", "word"]))
    r.shuffle(docs)
    return [(n, text) for n, text in enumerate(docs)]


def test_long_texts_against_brute_force(spark):
    docs = long_texts(3)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in jaccard.near_duplicates(df).collect()), key=str)
    assert got == brute(docs)


def test_wide_points_lose_nothing_and_keep_unrelated_texts_apart():
    texts = [text for _, text in long_texts(5)]
    tokens, offsets = jaccard.shingle_tokens(pa.array(texts))
    points, sizes = jaccard.Points.of(tokens, offsets), np.diff(offsets)
    assert sorted(set(points.classes.tolist())) == [0, 1, 2, 3, 4]
    again = jaccard.Points.read(pa.chunked_array([points.binary().slice(2)]))
    assert np.array_equal(again.dense(np.array([0, 1]), 0), points.dense(np.array([2, 3]), 0))
    sets = [set(tokens[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    sides = np.arange(len(sets)) % 2
    for own in (np.zeros(len(sets), int), sides):
        found = set()
        for a, b in jaccard.point_pairs(points, sizes, own, np.arange(len(sets))):
            found |= {frozenset(p) for p in zip(a.tolist(), b.tolist(), strict=True)}
        for i, x in enumerate(sets):
            for k in range(i):
                both = len(x & sets[k])
                if own[i] != own[k] or not own.any():
                    if 100 * both >= 80 * (len(x) + len(sets[k]) - both):
                        assert frozenset((i, k)) in found
        assert all(sets[i] & sets[k] for i, k in map(tuple, found))


def test_full_counts_stay_bounds():
    tokens = np.arange(1, 1001, dtype=np.uint64) * np.uint64(jaccard.GROUPS)  # all in one group
    points = jaccard.Points.of(tokens, np.array([0, 1000]))
    assert points.dense(np.array([0]), 0).sum() >= 1000


def test_cells_of_one_least_node_are_one_and_lose_no_link(spark):
    docs = variants(4)
    short = " ".join(f"s{n}" for n in range(20))
    docs += [(-1, short), (-2, short + " ".join(f" t{n}" for n in range(40)))]
    docs += [(-n - 3, text) for n, (_, text) in enumerate(docs[:20])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = jaccard.shingle_rows(df)
    node = {r["doc_id"]: r["node"] for r in rows.select("doc_id", "node").collect()}
    found = [tuple(r) for r in jaccard._cells(rows).select("cell", "node").collect()]
    cells = {}
    for cell, member in found:
        cells.setdefault(cell, set()).add(member)
    assert len(found) == len(set(found))
    assert all(min(members) == cell and len(members) > 1 for cell, members in cells.items())
    # a passage of a text three times as long is no reason for a cell
    assert not {node[-1], node[-2]} & {member for _, member in found}
    sets = [(node[d], shingles(text)) for d, text in docs]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if a != b and both and 100 * both >= 80 * (len(x) + len(y) - both):
                assert any({a, b} <= members for members in cells.values())


def test_tokens_go_straight_to_their_work(spark, monkeypatch):
    names = []

    def noted(df, name):
        names.append(name)
        return stored(df, name)

    monkeypatch.setattr(jaccard, "stored", noted)
    monkeypatch.setattr(jaccard, "MOST_BROADCAST", 20)
    docs = variants(5)
    docs += [(-n - 1, text) for n, (_, text) in enumerate(docs[:40] + docs[:10])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = sorted((tuple(r) for r in jaccard.near_duplicates(df).collect()), key=str)
    assert got == brute(docs)
    assert "node-tokens" not in names and names.count("links") > 2


def test_tables_on_the_way_are_removed(spark):
    shared = Path(shared_dir(spark))
    before = set(shared.iterdir())
    df = spark.createDataFrame(variants(3, families=3), "doc_id long, text string")
    left = jaccard.near_duplicates(df)
    assert [p.name.split("-")[0] for p in set(shared.iterdir()) - before] == ["grouped"]
    assert left.count() == df.count()
    before = set(shared.iterdir())
    kept = jaccard.keep_one(df)
    assert [p.name.split("-")[0] for p in set(shared.iterdir()) - before] == ["dropped"]
    assert kept.count() == left.select("component_id").distinct().count()

    def failing():
        stored(df, "half")
        raise ValueError("lost")

    before = set(shared.iterdir())
    with pytest.raises(ValueError, match="lost"):
        settled(spark, failing, "whole")
    assert set(shared.iterdir()) == before
