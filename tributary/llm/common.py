"""Helpers the operators share: stored tables, text batches, words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import remove_path, scratch_path

# White space of every contract here: space and the five ASCII controls 9-13.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
CHUNK_BYTES = 8 << 20
ARROW_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


# paths of the tables stored by the body of the innermost ``settled``
_on_the_way: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again.

    Removed at the end of the ``settled`` around it, else when the driver's JVM ends.
    """
    path = scratch_path(df.sparkSession, name)
    if (paths := _on_the_way.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, body: Callable[[], DataFrame], name: str) -> DataFrame:
    """The result of ``body`` as a stored table; those stored on the way to it are removed."""
    paths: list[str] = []
    outer = _on_the_way.set(paths)
    try:
        df = body()
        path = scratch_path(spark, name)
        df.write.parquet(path)
    finally:
        _on_the_way.reset(outer)
        for passing in paths:
            remove_path(spark, passing)
    if (around := _on_the_way.get()) is not None:
        around.append(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``limit`` bytes; one longer text stays whole."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
            pa.default_memory_pool().release_unused()


@contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Jobs started inside send Python about ``limit`` bytes at once, not rows by the thousand."""
    before = spark.conf.get(ARROW_KEY, None)
    spark.conf.set(ARROW_KEY, str(limit))
    try:
        yield
    finally:
        spark.conf.unset(ARROW_KEY) if before is None else spark.conf.set(ARROW_KEY, before)


def give_back() -> None:
    """Freed memory back to the system: an idle worker stays, beside the JVM's next stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(
    run: Callable[..., Iterator[pa.RecordBatch]],
) -> Callable[..., Iterator[pa.RecordBatch]]:
    """``run``, a function over a task's batches, with its memory given back at the end."""

    @wraps(run)
    def whole(*args) -> Iterator[pa.RecordBatch]:
        yield from run(*args)
        give_back()

    return whole


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column with null as empty text."""
    return pc.fill_null(batch.column(column), "")


def split_words(values: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes of all words, offsets of each text's words, and the distinct words."""
    lists = pc.ascii_split_whitespace(values)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    encoded = lists.flatten().dictionary_encode()
    codes, words = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:
        keep = codes != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return codes, offsets, words


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row number of every element of a list column with these offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all ranges, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
