"""Token counts of sections, from one encoding of the whole document.

A document is encoded once by a byte-level tokenizer. Tokens cover its bytes
without gaps, so the running sum of their byte lengths gives every token's span;
section borders are byte positions of the same text. Both are sorted, so the
interval join is a merge: a binary search of the borders among the spans.

A token that crosses a border is allocated by one of two rules: ``first`` gives
it to the section of its first byte, ``most`` to the section that holds most of
its bytes, the earlier one where two hold as many. Either way every token
belongs to exactly one section and the sections add up to the document.

Sections are the pieces of the text that end with a separator (a line break);
the separator belongs to the section it ends, and only the last section may have
none. Null and empty texts have no sections. Rows that repeat an id are rows of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import ranges, row_of, text_chunks, texts

RULES = ("first", "most")


class SpanEncoder:
    """Byte lengths of the tokens of whole texts."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding(
            "spans", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.widths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.widths[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """The byte position behind every token."""
        return np.cumsum(self.widths[self.encoding.encode_ordinary(text)])


def section_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and byte position (in the row) behind every section of every text."""
    filled = np.flatnonzero(np.diff(offsets) > 0)
    ends = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, offsets[filled + 1]]))
    rows = filled[np.searchsorted(offsets[filled + 1], ends, side="left")]
    return rows, ends - offsets[rows]


def allocate(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of every token, and whether the token crosses a border."""
    starts = np.concatenate([[0], token_ends[:-1]]).astype(np.int64)
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_ends, token_ends, side="left")
    section = first.copy()
    if rule == "most":
        for token in np.flatnonzero(first != last).tolist():
            borders = section_ends[first[token] : last[token]]
            held = np.diff(np.concatenate([[starts[token]], borders, [token_ends[token]]]))
            section[token] += int(np.argmax(held))
    return section, first != last


def _counted(path: str, pattern: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = SpanEncoder(path, pattern)
        for batch in text_chunks(batches):
            values = pa.concat_arrays([texts(batch).cast(pa.large_string())])
            offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset :][: len(values) + 1]
            data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            rows, ends = section_ends(data, offsets)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            cuts = np.searchsorted(rows, np.arange(len(values) + 1))
            counts = np.zeros(len(rows), np.int64)
            crossing = np.zeros(len(rows), np.int64)
            for row, text in enumerate(values.to_pylist()):
                if text:
                    own = slice(cuts[row], cuts[row + 1])
                    section, crosses = allocate(encoder.ends(text), ends[own], rule)
                    size = cuts[row + 1] - cuts[row]
                    counts[own] = np.bincount(section, minlength=size)
                    crossing[own] = np.bincount(section, crosses, size)
            number = ranges(np.zeros(len(values), np.int64), np.diff(cuts))
            stop = points[offsets[rows] + ends] - points[offsets[rows]]
            start = np.concatenate([[0], stop[:-1]]) if len(stop) else stop
            start = np.where(number == 0, 0, start)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row_of(cuts))),
                    pa.array(number.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(stop.astype(np.int64)),
                    pa.array(counts),
                    pa.array(crossing),
                ],
                names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
            )

    return run


def section_tokens(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    rule: str = "most",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per section: doc_id, section, start, end (code points), n_tokens, n_crossing.

    ``ranks`` is the path of a rank file, ``pattern`` what splits text before its
    merges; ``n_crossing`` counts the section's tokens that cross a border.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _counted(ranks, pattern, rule),
        "doc_id long, section int, start long, end long, n_tokens long, n_crossing long",
    )
