"""Language identification by averaged hashed subword embeddings and a linear softmax.

Every word is framed by marks and cut into byte n-grams, which are hashed into a
table of embeddings; a text is the mean of the embeddings of all n-grams of all
its words. Embeddings and softmax are trained by stochastic gradient descent in
numpy, on about ``FIT_ROWS`` labelled texts chosen by a hash of the text, and for
each language on ``LEAST_ROWS`` of its rows at least, or all if it has fewer. A
part of these texts is held back to set the softmax temperature and the score
under which a prediction counts as rejected.

A text is scored through its distinct words, each reduced to its summed logits,
so whole texts are read and memory is bounded by a chunk. Null text, and text
without a letter, is ``und`` with score 0; languages are predicted for all
others, with ``rejected`` telling weak ones apart. Without a labelled text all
are ``und``. Rows that repeat an id are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import WORD_CLASS, let, ranges, row_of, split_words, text_chunks, texts

FIT_ROWS = 3000
LEAST_ROWS = 100  # of each language, beyond FIT_ROWS if need be
FIT_WORDS = 100  # words of a training text, spread over the whole of it
EMBEDDING_RATE = 20  # embeddings get small gradients: each n-gram is a small share of its text
BUCKETS = 1 << 15
WIDTH = 16
ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"


def bucket_rows(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, flat, and their offsets."""
    frame = [pa.scalar(mark, pa.large_string()) for mark in ("<", ">", "")]
    framed = pc.binary_join_element_wise(frame[0], words.cast(pa.large_string()), *frame[1:])
    framed = pa.concat_arrays([framed])
    offsets = np.frombuffer(framed.buffers()[1], np.int64)[framed.offset :][: len(framed) + 1]
    data = np.frombuffer(framed.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    codes, found, owners = data.astype(np.uint64), [], []
    padded = np.concatenate([codes, np.zeros(max(ORDERS), np.uint64)])
    rolled = np.zeros(len(codes), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        rolled = rolled * np.uint64(0x100000001B3) + padded[order - 1 : order - 1 + len(codes)]
        counts = np.maximum(sizes - order + 1, 0)
        at = ranges(offsets[:-1], counts)
        hashed = (rolled[at] + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
        found.append((hashed >> np.uint64(40)).astype(np.int64) % BUCKETS)
        owners.append(np.repeat(np.arange(len(sizes)), counts))
    owner, bucket = np.concatenate(owners), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))])
    return bucket[order], ends


@dataclass
class LanguageModel:
    labels: list[str]
    logits: np.ndarray  # per bucket and label: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, values: pa.Array) -> np.ndarray:
        """Probabilities of the labels for each text; zeros without a letter."""
        codes, offsets, words = split_words(pc.utf8_lower(values))
        buckets, ends = bucket_rows(words)
        owner, rows, size = row_of(ends), row_of(offsets), len(values)
        counts = np.diff(ends)
        total = np.zeros((size, len(self.labels)))
        for k in range(len(self.labels)):
            of_word = np.bincount(owner, self.logits[buckets, k], len(words))
            total[:, k] = np.bincount(rows, of_word[codes], size)
        grams = np.bincount(rows, counts[codes], size)
        z = (total / np.maximum(grams, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        letters = pc.match_substring_regex(values, r"\p{L}").to_numpy(zero_copy_only=False)
        return np.where(letters[:, None], z / z.sum(1, keepdims=True), 0.0)


def fit(examples: list[tuple[str, str]], epochs: int = 6, rate: float = 0.5, seed: int = 3) -> LanguageModel | None:
    """Trains on (text, label); every fifth text sets temperature and threshold."""
    labels = sorted({label for _, label in examples})
    if not labels:
        return None
    generator = np.random.default_rng(seed)
    values = pa.array([text.lower() for text, _ in examples], pa.string())
    target = np.array([labels.index(label) for _, label in examples])
    codes, offsets, words = split_words(values)
    buckets, ends = bucket_rows(words)
    bags = [
        np.unique(buckets[ranges(ends[own], ends[own + 1] - ends[own])], return_counts=True)
        for own in (codes[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True))
    ]
    held = np.arange(len(bags)) % 5 == 4
    embedding = generator.normal(0, 0.1, (BUCKETS, WIDTH))
    weights, bias = generator.normal(0, 0.1, (WIDTH, len(labels))), np.zeros(len(labels))
    learn = np.flatnonzero(~held)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in generator.permutation(learn):
            bag, counts = bags[i]
            if not len(bag):
                continue
            shares = counts / counts.sum()
            hidden = shares @ embedding[bag]
            z = hidden @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target[i]] -= 1
            back = weights @ p
            weights -= step * np.outer(hidden, p)
            bias -= step * 0.1 * p
            embedding[bag] -= step * EMBEDDING_RATE * shares[:, None] * back
    model = LanguageModel(labels, embedding @ weights, bias, 1.0, 0.0)
    if held.any():
        own = values.filter(pa.array(held))
        right = target[held]
        best = (np.inf, 1.0)
        for temperature in (0.25, 0.5, 0.7, 1.0, 1.4, 2.0, 4.0):
            model.temperature = temperature
            p = model.scores(own)[np.arange(len(right)), right]
            best = min(best, (-np.log(np.maximum(p, 1e-9)).mean(), temperature))
        model.temperature = best[1]
        p = model.scores(own)
        wrong = p.max(1)[p.argmax(1) != right]
        # the largest score of the held-back errors, but at most 0.9
        model.threshold = float(min(0.9, wrong.max())) if len(wrong) else 0.0
    return model


def held_out(id_column: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the row's id falls into the fold that training must not see; null ids do."""
    own = F.crc32(id_column.cast("string").cast("binary")) % folds == fold
    return F.coalesce(own, F.lit(True))


def spread_words(text: Column, most: int = FIT_WORDS) -> Column:
    """Under twice ``most`` words of a text, evenly spread over the whole of it."""
    words = F.regexp_extract_all(text, F.lit(WORD_CLASS + "+"), F.lit(0))
    return F.array_join(
        let(
            words,
            lambda w: F.filter(
                w, lambda _, i: i % F.greatest(F.floor(F.size(w) / most), F.lit(1)) == 0
            ),
        ),
        " ",
    )


def shares_of(counts: dict, rows: int, least: int) -> dict:
    """The share to sample of each label: ``rows`` of all, but ``least`` of a label or all it has."""
    total = max(sum(counts.values()), 1)
    return {label: min(1.0, max(rows / total, least / n)) for label, n in counts.items()}


def sample_of(labelled: DataFrame, rows: int, least: int = LEAST_ROWS) -> DataFrame:
    """About ``rows`` of the rows (text, label) and ``least`` of each label, none of the same text and label.

    Rows are chosen by a hash of the text, counts are taken over all rows. The model
    holds a column per label, so the labels are few enough for the driver.
    """
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if not counts:
        return labelled
    shares = shares_of(counts, rows, least)
    listed = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    return labelled.filter(place <= listed[F.col("label")] * 1_000_000).dropDuplicates(["text", "label"])


def train(docs: DataFrame, rows: int = FIT_ROWS) -> LanguageModel | None:
    """The model of ``docs`` (doc_id, text, lang) outside the held-out fold."""
    labelled = (
        docs.filter("text IS NOT NULL AND lang IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .select("text", F.col("lang").alias("label"))
    )
    sample = sample_of(labelled, rows).select(spread_words(F.col("text")).alias("text"), "label")
    return fit(sorted((r["text"], r["label"]) for r in sample.collect()))


def _predicted(model: LanguageModel | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            size = batch.num_rows
            p = model.scores(texts(batch)) if model and size else np.zeros((size, 1))
            score = p.max(1) if size else np.zeros(0)
            names = np.array(model.labels if model else [UNKNOWN], object)
            label = np.where(score > 0, names[p.argmax(1)] if size else names[:0], UNKNOWN)
            rejected = score < (model.threshold if model else 1.0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(label, pa.string()),
                    pa.array(score),
                    pa.array(rejected),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return run


def identify(docs: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = train(docs, rows)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        _predicted(model),
        "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean",
    )
