"""Quality rules as a short-circuit cascade, in column expressions only.

Each rule is a rejecting expression. A sample is drawn once; on it every rule's
cost (seconds of a run) and rejections are measured, and rules are ordered by
rejections per second. The cascade is one nested CASE in that order, so a row
rejected by a cheap rule is not put to the dearer ones. The order changes the
cost only, never the verdict.

Null text counts as empty: no words, rejected by the base rule. Columns of the
input that clash with names used here are not touched. An empty table gives an
empty result, with rules in their stated order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import SPACE, SPACE_CLASS, WORD_CLASS, let, stored

SAMPLE_ROWS = 2000
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_CLASS + "+"), F.lit(0))


def word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, SPACE_CLASS + "+", "")).cast("long")


def symbol_count(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _windows(tokens: Column) -> Column:
    """Hash of every window of eight words."""
    return let(
        tokens,
        lambda w: F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]),
        ),
    )


def _covered(codes: Column) -> Column:
    """Words under the windows whose code occurs twice; the codes are sorted with their places."""
    pairs = F.sort_array(
        F.transform(codes, lambda x, i: F.struct(x.alias("code"), i.alias("at")))
    )
    repeated = let(
        pairs,
        lambda p: F.sort_array(
            F.transform(
                F.filter(
                    p,
                    lambda x, i: F.coalesce(F.get(p, i + 1)["code"] == x["code"], F.lit(False))
                    | ((i > 0) & (F.get(p, F.greatest(i - 1, F.lit(0)))["code"] == x["code"])),
                ),
                lambda x: x["at"],
            )
        ),
    )
    steps = let(
        repeated,
        lambda r: F.transform(
            r,
            lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(r, i + 1) - x, F.lit(WINDOW))),
        ),
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)


def repeated_words(tokens: Column) -> Column:
    """Words in windows of eight that occur twice or more in the text."""
    return let(
        _windows(tokens),
        lambda c: F.when(F.size(F.array_distinct(c)) == F.size(c), F.lit(0).cast("long")).otherwise(
            _covered(c)
        ),
    )


def stutters(tokens: Column) -> Column:
    """Words that equal the word before."""
    return let(
        tokens,
        lambda w: F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))).cast("long"),
    )


class Signals:
    """The counts rules are stated over, each an expression of the text or a column that has it."""

    def __init__(self, text: Column, **known: Column):
        self.text, self.known = text, known

    def __getattr__(self, name: str) -> Column:
        return self.known[name] if name in self.known else getattr(self, "_" + name)()

    def _n_words(self) -> Column:
        return F.regexp_count(self.text, F.lit(WORD_CLASS + "+")).cast("long")

    def _word_chars(self) -> Column:
        return word_chars(self.text)

    def _n_symbols(self) -> Column:
        return symbol_count(self.text)

    def _n_dup_lines(self) -> Column:
        return repeated_lines(self.text)

    def _n_lines(self) -> Column:
        return F.size(F.split(self.text, "\n"))

    def _n_repeat_words(self) -> Column:
        return repeated_words(words(self.text))

    def _n_stutters(self) -> Column:
        return stutters(words(self.text))

    def _n_capitals(self) -> Column:
        return F.char_length(F.regexp_replace(self.text, "[^A-Z]+", ""))


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the signals of a text to a boolean that is never null."""

    name: str
    rejects: Callable[[Signals], Column]


BASE_RULES = (
    Rule("few_words", lambda s: s.n_words < MIN_WORDS),
    Rule("repeated_words", lambda s: s.n_repeat_words * 100 > s.n_words * MAX_REPEAT_PERCENT),
)
RULES = (
    *BASE_RULES,
    # over a symbol for every fourth word
    Rule("symbols", lambda s: s.n_symbols * 4 > s.n_words),
    # over half of the lines repeat an earlier one
    Rule("repeated_lines", lambda s: s.n_dup_lines * 2 > s.n_lines),
    # over 30 % of the words equal the word before
    Rule("stutter", lambda s: s.n_stutters * 10 > s.n_words * 3),
    # over 30 % of the words' characters are capital letters A-Z: shouting
    Rule("capitals", lambda s: s.n_capitals * 10 > s.word_chars * 3),
    # words of under 2.5 or over 12 characters on average
    Rule(
        "word_length",
        lambda s: (s.word_chars * 2 < s.n_words * 5) | (s.word_chars > s.n_words * 12),
    ),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: int

    @property
    def rate(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def measure(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text_col: str = "text",
    rows: int = SAMPLE_ROWS,
) -> list[Measured]:
    """Cost and rejections of every rule on about ``rows`` sampled rows, best rate first.

    The sampled texts are stored, not collected; only counts come back.
    """
    total = docs.count()
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    sample = stored(
        docs.select(text).sample(min(1.0, rows / max(total, 1)), seed=7), "quality-sample"
    ).coalesce(1)
    found = []
    for rule in rules:
        count = sample.agg(F.count_if(rule.rejects(Signals(F.col("text")))).alias("n"))
        took = []
        for _ in range(2):
            start = time.perf_counter()
            rejected = count.first()["n"]
            took.append(time.perf_counter() - start)
        found.append(Measured(rule, min(took), rejected))
    return sorted(found, key=lambda m: -m.rate)


def verdict(signals: Signals, rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does."""
    name = F.lit(None).cast("string")
    for rule in reversed(rules):
        name = F.when(rule.rejects(signals), F.lit(rule.name)).otherwise(name)
    return name


def quality_signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts of every document, whether the base rules reject it, and the cascade's verdict."""
    order = [m.rule for m in measure(docs, text_col=text_col)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        let(
            words(text),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                repeated_words(w).alias("n_repeat_words"),
                stutters(w).alias("n_stutters"),
            ),
        ).alias("counts"),
        word_chars(text).alias("word_chars"),
        symbol_count(text).alias("n_symbols"),
        repeated_lines(text).alias("n_dup_lines"),
    )
    known = {
        "n_words": F.col("counts.n_words"),
        "word_chars": F.col("word_chars"),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.col("n_dup_lines"),
        "n_repeat_words": F.col("counts.n_repeat_words"),
    }
    later = {"n_stutters": F.col("counts.n_stutters")}
    signals = Signals(F.col("text"), **known, **later)
    failed = reduce(Column.__or__, [rule.rejects(signals) for rule in BASE_RULES])
    rest = [rule for rule in order if rule not in BASE_RULES]
    return counted.select(
        "doc_id",
        *[c.alias(name) for name, c in known.items()],
        failed.alias("base_failed"),
        F.when(failed, F.lit(False)).otherwise(verdict(signals, rest).isNull()).alias("kept"),
        *[c.alias(name) for name, c in later.items()],
    )


def keep_good(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns as they were."""
    order = [m.rule for m in measure(docs, rules, text_col)]
    signals = Signals(F.coalesce(F.col(text_col), F.lit("")))
    return docs.filter(verdict(signals, order).isNull())
