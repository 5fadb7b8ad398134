"""Toxicity scores from a learned lexicon, spelling automata and context windows.

The lexicon is learned from about ``FIT_ROWS`` labelled texts, and from at least
``LEAST_ROWS`` of the toxic and of the other ones, or all there are: a word counts by
the number of different words it follows in toxic and in other texts, so copies
of one text count once; so does each beginning of a word, for inflected terms.
All whole words make a trie. Each distinct word of a chunk is
turned into a Levenshtein automaton and intersected with the trie, which finds
the terms it spells or misspells by one edit; a cheap test on the halves of the
terms keeps all other words away.

Every hit is weighed by its term and by its context: hits inside quotation
marks, or within a few words of a word of reporting, count as quoted, others as
abuse. A logistic regression, trained here, turns the sums into a score; its
intercept is set back to the shares of all labelled rows. What
misspelled hits add to the sums are features of their own, apart for short
terms, whose neighbours are often other words: the regression decides what an
edit takes away. Where the fit has no such hit, they count like exact ones.

Null text counts as empty; texts without a hit get the model's lowest scores.
Rows that repeat an id are rows of their own; labels that repeat an id or
disagree train as toxic if any says so. Without labels every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import WORD_CLASS, let, split_words, stored, text_chunks, texts
from tributary.llm.language import held_out, shares_of

FIT_ROWS = 4_000
LEAST_ROWS = 1_000  # of the toxic and of the other texts, beyond FIT_ROWS if need be
MOST_TERMS = 400
LEAST_CONTEXTS = 4
LEAST_WEIGHT = 2.5
SHORT = 5  # misspellings of terms of fewer letters are weighed apart
STEM = "*"  # closes a term that stands for all words it begins
STEM_SIZES = (4, 5, 6)
WINDOW = 4
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…–—¡¿"
# Marks that open or close a quotation, words that report speech.
QUOTES = "\"«»“”„"
REPORTING = frozenset(
    "said says quote quoted quotes wrote called calls calling word term slur insult "
    "dit écrit mot sagte schrieb wort dijo escribió palabra".split()
)
SUMS = ("most", "total", "density", "any", "quoted")
EXACT, MISSPELLED, SHORT_MISSPELLED = range(3)  # kinds of hits
FEATURES = (*SUMS, *(f"{s}_misspelled" for s in SUMS), *(f"{s}_short" for s in SUMS))


class Trie:
    """Terms by their characters; a node is a dictionary, a term's end holds it under ''."""

    def __init__(self, terms):
        self.root: dict = {}
        for term in terms:
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = term


class LevenshteinAutomaton:
    """Accepts what is within ``most`` edits of a word; a state is a sparse row of distances."""

    def __init__(self, word: str, most: int):
        self.word, self.most = word, most

    def start(self) -> tuple:
        return tuple((i, i) for i in range(min(self.most, len(self.word)) + 1))

    def step(self, state: tuple, c: str) -> tuple:
        row: dict[int, int] = {}
        before = dict(state)
        for place, cost in state:
            row[place] = min(row.get(place, cost + 1), cost + 1)
            if place < len(self.word):
                change = cost + (self.word[place] != c)
                row[place + 1] = min(row.get(place + 1, change), change)
        for place in range(min(before, default=0), min(max(row, default=-1) + self.most, len(self.word)) + 1):
            if place - 1 in row:
                row[place] = min(row.get(place, row[place - 1] + 1), row[place - 1] + 1)
        return tuple(sorted((p, cost) for p, cost in row.items() if cost <= self.most))

    def distance(self, state: tuple) -> int | None:
        return dict(state).get(len(self.word))

    def accepted(self, trie: Trie) -> list[tuple[str, int]]:
        """The trie's terms this automaton accepts, with their distances."""
        found, stack = [], [(trie.root, self.start())]
        while stack:
            node, state = stack.pop()
            for c, child in node.items():
                if c == "":
                    if (distance := self.distance(state)) is not None:
                        found.append((child, distance))
                elif nearer := self.step(state, c):
                    stack.append((child, nearer))
        return sorted(found, key=lambda f: (f[1], f[0]))


@dataclass
class Lexicon:
    weights: dict[str, float]
    trie: Trie = field(init=False)

    def __post_init__(self):
        self.stems = sorted({len(t) - 1 for t in self.weights if t.endswith(STEM)}, reverse=True)
        fuzzy = [t for t in self.weights if not t.endswith(STEM)]
        self.trie = Trie(fuzzy)
        # lengths a misspelling may have, by the half of the term it keeps
        self.heads: dict[str, set[int]] = {}
        self.tails: dict[str, set[int]] = {}
        for t in fuzzy:
            near = {len(t) - 1, len(t), len(t) + 1}
            self.heads.setdefault(t[: len(t) // 2], set()).update(near)
            self.tails.setdefault(t[len(t) // 2 :], set()).update(near)
        self.head_sizes = sorted({len(h) for h in self.heads})
        self.tail_sizes = sorted({len(t) for t in self.tails})
        self.seen: dict[str, tuple[float, int, int] | None] = {}

    def _may_match(self, word: str) -> bool:
        """One edit leaves the first or the second half of a term in its place."""
        size = len(word)
        return any(size in self.heads.get(word[:n], ()) for n in self.head_sizes) or any(
            size in self.tails.get(word[-n:], ()) for n in self.tail_sizes
        )

    def match(self, word: str) -> tuple[float, int, int] | None:
        """(weight, distance, kind) of the nearest term of a bare word; of several the heaviest long one."""
        if word in self.weights:
            return self.weights[word], 0, EXACT
        for size in self.stems:
            if len(word) > size and (weight := self.weights.get(word[:size] + STEM)):
                return weight, 0, EXACT
        if not word or not self._may_match(word):
            return None
        if word not in self.seen:
            if len(self.seen) > 200_000:
                self.seen.clear()
            near = [t for t, _ in LevenshteinAutomaton(word, 1).accepted(self.trie)]
            best = max(((len(t) >= SHORT, self.weights[t]) for t in near), default=None)
            self.seen[word] = best and (best[1], 1, MISSPELLED if best[0] else SHORT_MISSPELLED)
        return self.seen[word]


def bare(word: str) -> str:
    return word.strip(EDGES).lower()


def features(values: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row per text: the sums over all hits, then what long and short misspellings add to them.

    The sums are the heaviest hit, summed weights, hits per word, any hit, the heaviest quoted hit.
    """
    codes, offsets, words = split_words(values)
    listed = words.to_pylist()
    hits = [lexicon.match(bare(w)) for w in listed]
    weight = np.array([h[0] if h else 0.0 for h in hits])
    kinds = [h[2] if h else EXACT for h in hits]
    most, total, count, reported = np.zeros((4, len(values), 3))
    places = np.flatnonzero(weight[codes] > 0) if len(codes) else np.zeros(0, int)
    rows = np.searchsorted(offsets, places, side="right") - 1
    for place, row in zip(places.tolist(), rows.tolist(), strict=True):
        code = codes[place]
        kind = kinds[code]
        start, stop = max(offsets[row], place - WINDOW), min(offsets[row + 1], place + WINDOW + 1)
        around = [listed[c] for c in codes[start:stop]]
        if is_quoted(around, place - int(start)):
            reported[row, kind] = max(reported[row, kind], weight[code])
        else:
            most[row, kind] = max(most[row, kind], weight[code])
            total[row, kind] += weight[code]
            count[row, kind] += 1
    sizes = np.maximum(np.diff(offsets), 1)[:, None]
    count = count.cumsum(1)
    # per text, sum and kind: the sum over hits up to this kind
    sums = np.stack(
        [
            np.maximum.accumulate(most, 1),
            np.log1p(total.cumsum(1)),
            np.sqrt(count / sizes),
            count > 0,
            np.maximum.accumulate(reported, 1),
        ],
        1,
    )
    return np.hstack([sums[:, :, SHORT_MISSPELLED], *np.moveaxis(np.diff(sums), 2, 0)])


def is_quoted(around: list[str], place: int) -> bool:
    """Whether the window puts the word at ``place`` between quotation marks or next to reporting."""
    before = sum(c in QUOTES for w in around[:place] for c in w)
    own = around[place]
    opened = own[:1] in QUOTES and own[:1] != ""
    closed = own.rstrip(".,;:!?")[-1:] in QUOTES and own != ""
    after = sum(c in QUOTES for w in around[place + 1 :] for c in w)
    marked = (opened or before % 2 == 1) and (closed or after > 0)
    return marked or any(bare(w) in REPORTING for w in around[max(0, place - 3) : place])


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def scores(self, values: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-(features(values, self.lexicon) @ self.weights + self.bias)))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, penalty: float = 0.05):
    """Weights and intercept by Newton's method with a small ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.diag([penalty] * (len(w) - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms whose contexts lean to toxic texts; ``sample`` has text and toxic (boolean)."""
    words = F.regexp_extract_all("text", F.lit(WORD_CLASS + "+"), F.lit(0))
    bared = let(words, lambda w: F.transform(w, lambda x: F.lower(F.btrim(x, F.lit(EDGES)))))
    pairs = let(
        bared,
        lambda w: F.transform(
            w, lambda x, i: F.struct(x.alias("word"), F.xxhash64(F.get(w, i - 1)).alias("before"))
        ),
    )
    contexts = (
        sample.select("toxic", F.explode(pairs).alias("pair"))
        .select("toxic", "pair.word", "pair.before")
        .filter("word <> ''")
        .distinct()
    )
    stems = F.array(
        *[
            F.when(F.char_length("word") > n, F.concat(F.substring("word", 1, n), F.lit(STEM)))
            for n in STEM_SIZES
        ]
    )
    contexts = contexts.select(
        "toxic", "before", F.explode(F.array_compact(F.array_append(stems, F.col("word")))).alias("word")
    ).distinct()
    counts = contexts.groupBy("word").agg(
        F.count_if(F.col("toxic")).alias("yes"), F.count_if(~F.col("toxic")).alias("no")
    )
    totals = contexts.agg(F.count_if(F.col("toxic")), F.count_if(~F.col("toxic"))).first()
    lean = F.log((F.col("yes") + 0.5) / F.lit(totals[0] + 1.0)) - F.log(
        (F.col("no") + 0.5) / F.lit(totals[1] + 1.0)
    )
    terms = (
        counts.filter(F.col("yes") >= LEAST_CONTEXTS)
        .withColumn("lean", lean)
        .filter(F.col("lean") >= LEAST_WEIGHT)
        .orderBy(F.desc(F.col("lean") * F.sqrt("yes")), "word")
        .limit(MOST_TERMS)
        .collect()
    )
    return Lexicon({r["word"]: float(r["lean"]) for r in terms})


def _featured(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            found = features(texts(batch), lexicon)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), *(pa.array(found[:, k]) for k in range(len(FEATURES)))],
                names=["toxic", *FEATURES],
            )

    return run


def train(
    docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, least: int = LEAST_ROWS
) -> ToxicityModel | None:
    """The model of the labelled texts outside the held-out fold."""
    marks = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
        .filter(~held_out(F.col("doc_id"), 5, 0))
    )
    counts = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if not counts:
        return None
    shares = shares_of(counts, rows, least)
    share = F.when(F.col("toxic"), shares.get(True, 1.0)).otherwise(shares.get(False, 1.0))
    chosen = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) <= share * 1_000_000)
    sample = stored(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(chosen, "doc_id")
        .groupBy(F.sha2("text", 256).alias("digest"))
        .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")),
        "toxic-sample",
    ).select("text", "toxic")
    lexicon = learn_lexicon(sample)
    schema = "toxic boolean, " + ", ".join(f"{f} double" for f in FEATURES)
    table = sample.mapInArrow(_featured(lexicon), schema).toArrow()
    x = np.stack([table.column(f).to_numpy() for f in FEATURES], 1)
    y = table.column("toxic").to_numpy(zero_copy_only=False).astype(float)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(lexicon, np.zeros(len(FEATURES)), -5.0 if not y.any() else 5.0)
    weights, bias = logistic(x, y)
    return ToxicityModel(lexicon, weights, bias - float(np.log(shares[True] / shares[False])))


def _scored(model: ToxicityModel | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            score = model.scores(texts(batch)) if model else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    model = train(docs, labels, rows)
    return docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "text").mapInArrow(
        _scored(model), "doc_id long, held_out boolean, score double, predicted int"
    )
