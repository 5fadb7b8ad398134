"""Secret scans through a trigram inverted index.

Every rule's pattern is parsed once and turned into a Boolean query over the
lower-case trigrams each match must hold. The texts of a chunk are indexed by
the trigrams any rule asks for; postings are intersected and united as the
query says, and only candidate texts are put to the pattern. A rule whose
pattern has no mandatory trigram scans every text.

Null text counts as empty and holds no secret. Spans count code points, end
exclusive. Rows that repeat an id are rows of their own; other columns of the
input are left alone. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import giving_back, text_chunks, texts

MASK = "[REDACTED]"
CHUNK = 2 << 20  # bytes of text indexed at once; codes and their places take about 15 times that


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules of the contract, then public formats of keys.
BASE_RULES = (
    SecretRule(
        "assign",
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    # runs of one class: the least length may stand in the pattern
    SecretRule("access", r"AKIA[A-Z0-9]{14,}"),
    SecretRule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("forge_token", r"gh[opsu]_[A-Za-z0-9]{30,}"),
    SecretRule("chat_token", r"xox[abpr]-[A-Za-z0-9-]{16,}"),
    SecretRule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    SecretRule("payment_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    SecretRule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:([^\s/@]{4,128})@", 1, 4),
)
RULES = (*BASE_RULES, *MORE_RULES)

# A Boolean query: True (no demand), a trigram, ("and", parts) or ("or", parts).
MOST_STRINGS = 24


def _both(parts) -> object:
    found = tuple(dict.fromkeys(p for p in parts if p is not True))
    return True if not found else found[0] if len(found) == 1 else ("and", found)


def _either(parts) -> object:
    found = tuple(dict.fromkeys(parts))
    if not found or any(p is True for p in found):
        return True
    return found[0] if len(found) == 1 else ("or", found)


def _of_strings(strings: set[str]) -> object:
    """What a text with one of the strings must hold."""
    return _either(_both(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _set(items) -> set[str] | None:
    """The characters of a class if they are few, lower case."""
    found: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            found.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < MOST_STRINGS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if all(c.isascii() for c in found) else None


def _strings(tree) -> set[str] | None:
    """All strings the tree matches, if they are few."""
    found = {""}
    for op, value in tree:
        if op is sre.LITERAL:
            own = {chr(value).lower()} if value < 128 else None
        elif op is sre.IN:
            own = _set(value)
        elif op is sre.SUBPATTERN:
            own = _strings(value[3])
        elif op is sre.BRANCH:
            sides = [_strings(side) for side in value[1]]
            own = None if None in sides else set().union(*sides)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[1] <= 3:
            inner = _strings(value[2])
            own = inner and {
                "".join(p)
                for n in range(value[0], value[1] + 1)
                for p in product(inner, repeat=n)
                if len(inner) ** n <= MOST_STRINGS
            }
            if inner and len(inner) ** value[1] > MOST_STRINGS:
                own = None
        elif op is sre.AT:
            own = {""}
        else:
            own = None
        if own is None or len(found) * len(own) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in own}
    return found


def _query(tree) -> object:
    """Conjunction over the runs of the tree whose strings are known and its other parts."""
    demands, run = [], []

    def close():
        strings = _strings(run)
        if strings is not None:
            demands.append(_of_strings(strings))
        run.clear()

    for node in tree:
        op, value = node
        if _strings([*run, node]) is not None:
            run.append(node)
            continue
        close()
        if _strings([node]) is not None:
            run.append(node)
        elif op is sre.SUBPATTERN:
            demands.append(_query(value[3]))
        elif op is sre.BRANCH:
            demands.append(_either(_query(side) for side in value[1]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
            demands.append(_query(value[2]))
    close()
    return _both(demands)


def trigram_query(pattern: str) -> object:
    """Trigrams that every match of the pattern holds, as a Boolean query; True if none is needed."""
    return _query(parser.parse(pattern))


def trigrams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


class TrigramIndex:
    """Postings (ascending row numbers) of the wanted trigrams over the texts of a chunk."""

    def __init__(self, values: pa.Array, wanted: dict[str, int], table: np.ndarray):
        values = pa.concat_arrays([values.cast(pa.large_string())])
        offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset :][: len(values) + 1]
        data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        lower = data.astype(np.int32)
        lower[(data >= 65) & (data <= 90)] += 32
        codes = lower[:-2] << 16 | lower[1:-1] << 8 | lower[2:] if len(lower) > 2 else lower[:0]
        numbers = table[codes]
        places = np.flatnonzero(numbers)
        rows = np.searchsorted(offsets - offsets[0], places, side="right") - 1
        pairs = np.unique(numbers[places].astype(np.int64) * len(values) + rows)
        number, row = np.divmod(pairs, max(len(values), 1))
        cuts = np.searchsorted(number, np.arange(1, len(wanted) + 2))
        self.postings = {t: row[cuts[n - 1] : cuts[n]] for t, n in wanted.items()}

    def rows(self, query: object) -> np.ndarray:
        if isinstance(query, str):
            return self.postings[query]
        op, parts = query
        found = self.rows(parts[0])
        for part in parts[1:]:
            if op == "and" and not len(found):
                break
            other = self.rows(part)
            found = (
                np.intersect1d(found, other, assume_unique=True)
                if op == "and"
                else np.union1d(found, other)
            )
        return found


Span = tuple[str, int, int, int, int]


def spans_of(text: str, rules) -> list[Span]:
    """(kind, start, end, value start, value end) of the rules' matches in one text."""
    found = []
    for rule, pattern in rules:
        for match in pattern.finditer(text):
            start, end = match.span(rule.group)
            if end - start >= rule.least:
                found.append((rule.kind, *match.span(), start, end))
    return found


class Scanner:
    """The rules compiled, with their queries; made once per task."""

    def __init__(self, rules: tuple[SecretRule, ...] = RULES):
        self.rules = [(r, re.compile(r.pattern)) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.place = {r.kind: n for n, r in enumerate(rules)}
        wanted = sorted(set().union(*map(trigrams, self.queries)))
        self.wanted = {t: n for n, t in enumerate(wanted, 1)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, n in self.wanted.items():
            self.table[int.from_bytes(t.encode(), "big")] = n

    def scan(self, values: pa.Array) -> dict[int, list[Span]]:
        """Spans per row number, by start, then in the order of the rules."""
        index = TrigramIndex(values, self.wanted, self.table)
        asked: dict[int, list] = {}
        everywhere = []
        for rule, query in zip(self.rules, self.queries, strict=True):
            if query is True:
                everywhere.append(rule)
                continue
            for row in index.rows(query).tolist():
                asked.setdefault(row, []).append(rule)
        found = {}
        rows = range(len(values)) if everywhere else sorted(asked)
        for row in rows:
            spans = spans_of(values[row].as_py(), everywhere + asked.get(row, []))
            if spans:
                found[row] = sorted(spans, key=lambda s: (s[1], self.place[s[0]], s[2]))
        return found


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _, _ in spans)


@giving_back
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    base = [r.kind for r in BASE_RULES]
    for batch in text_chunks(batches, limit=CHUNK):
        found = scanner.scan(texts(batch))
        spans = [found.get(row, []) for row in range(batch.num_rows)]
        firsts = [[s for s in own if s[0] in base] for own in spans]
        counts = [pa.array([sum(s[0] == k for s in own) for own in firsts], pa.int64()) for k in base]
        digests = [hashlib.sha256(_listed(own).encode()).hexdigest() for own in firsts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *counts, pa.array(digests), pa.array(map(_listed, spans))],
            names=["doc_id", *(f"n_{k}" for k in base), "base_sha256", "spans"],
        )


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, their digest, and all spans."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _digests,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def masked(text: str, spans: list[Span]) -> str:
    """The text with every secret value replaced; overlapping values become one mask."""
    pieces, done = [], 0
    for start, end in sorted((s[3], s[4]) for s in spans):
        if start >= done:
            pieces += [text[done:start], MASK]
        done = max(done, end)
    return "".join([*pieces, text[done:]])


@giving_back
def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in text_chunks(batches, limit=CHUNK):
        values = batch.column("text").to_pylist()
        for row, spans in scanner.scan(texts(batch)).items():
            values[row] = masked(values[row], spans)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(values, pa.string())], names=["row", "text"]
        )


def mask_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with secret values masked in the text; all else as it was."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    rows = docs.select(rest.alias("row"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(
        _masked, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    )
    return out.select(
        *[
            F.col("text").alias(text_col) if c == text_col else F.col("row").getField(c).alias(c)
            for c in docs.columns
        ]
    )
