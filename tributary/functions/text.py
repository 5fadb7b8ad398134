"""Text expressions: accent folding, unknown labels, range labels, padding."""

import json
import re
import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache
from itertools import filterfalse

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.recode import recode

# Every character str.strip() removes; a blank-only trim misses tabs and NBSP.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _bare(text: str) -> str:
    """Compatibility decomposition without combining marks."""
    return "".join(filterfalse(unicodedata.combining, unicodedata.normalize("NFKD", text)))


def fold_literal(text: str) -> str:
    """The fold of one driver-side string, e.g. a column name."""
    return _bare(text).lower().strip()


# Hangul syllables are composed by rule: 19 leads, 21 vowels, 27 tails or none.
SYLLABLES = (0xAC00, 0xD7A3)
LEADS, VOWELS, TAILS = (
    [chr(first + n) for n in range(count)] for first, count in ((0x1100, 19), (0x1161, 21), (0x11A8, 27))
)


@lru_cache(maxsize=1)
def _fold_rules() -> tuple[str, str, dict[str, str]]:
    """Translate strings for one-to-one folds and deletions, and all expansions but syllables."""
    source, target, dropped, expanded = [], [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF or SYLLABLES[0] <= point <= SYLLABLES[1]:
            continue
        char = chr(point)
        bare = _bare(char)
        if bare == char:
            continue
        if not bare:
            dropped.append(char)
        elif len(bare) == 1:
            source.append(char)
            target.append(bare)
        else:
            expanded[char] = bare
    return "".join(source + dropped), "".join(target), expanded


def _has_any(col: Column, characters: str) -> Column:
    """Whether a text holds one of many characters.

    One table lookup per character; a regex class tests its members in turn.
    """
    return F.length(F.translate(col, characters, "")) < F.length(col)


def strip(col: Column) -> Column:
    """Trim all Unicode white space at both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def _plain_edges(col: Column) -> Column:
    """Whether a text starts and ends with a visible ASCII character.

    Such a text needs no trimming, folded or not. Trimming a set of characters
    walks the whole text.
    """
    first, last = F.substring(col, 1, 1), F.substring(col, -1, 1)
    return first.between("!", "~") & last.between("!", "~")


def _syllable(char: Column) -> Column:
    """The letters of one Hangul syllable."""
    place = F.ascii(char) - SYLLABLES[0]
    vowels, tails = len(VOWELS), len(TAILS) + 1
    letters = [
        (LEADS, F.floor(place / (vowels * tails))),
        (VOWELS, F.floor(place / tails) % vowels),
        (["", *TAILS], place % tails),
    ]
    return F.concat(
        *[F.element_at(F.array(*map(F.lit, chars)), (n + 1).cast("int")) for chars, n in letters]
    )


def _spelled(col: Column, expanded: dict[str, str]) -> Column:
    """A text with every expanding character replaced by its expansion."""
    table = F.from_json(F.lit(json.dumps(expanded)), "map<string,string>")
    chars = F.split(col, "")
    return F.array_join(
        F.transform(
            chars,
            lambda c: F.when(
                F.octet_length(c) > 1,
                F.when(c.between(*map(chr, SYLLABLES)), _syllable(c)).otherwise(
                    F.coalesce(F.element_at(table, c), c)
                ),
            ).otherwise(c),
        ),
        "",
    )


def _folded_any(col: Column) -> Column:
    """The fold of a text with characters of any kind, not yet in lower case."""
    source, target, expanded = _fold_rules()
    syllables = col.rlike(f"[{chr(SYLLABLES[0])}-{chr(SYLLABLES[1])}]")
    rare = syllables | _has_any(col, "".join(expanded))
    spelled = F.when(rare, _spelled(col, expanded)).otherwise(col)
    return F.translate(spelled, source, target)


def fold(col: Column) -> Column:
    """Lower-case text without accents, compatibility forms resolved, trimmed.

    JVM expressions only. Pure ASCII values skip the translation; only values
    with a character that becomes several ones are taken apart.
    """
    wide = F.octet_length(col) > F.length(col)
    folded = F.lower(F.when(wide, _folded_any(col)).otherwise(col))
    return F.when(_plain_edges(col), folded).otherwise(strip(folded))


def needs_fold(col: Column, capitals: str = "A-ZÁÉÍÓÚÑ") -> Column:
    """True for a value that makes its column worth folding: null or a capital."""
    return col.isNull() | col.rlike(f"[{capitals}]")


def canonical_unknown(col: Column, variants: Sequence[str], label: str) -> Column:
    """Null and every listed spelling of "unknown" become one label."""
    return F.coalesce(recode(col, dict.fromkeys(variants, label)), F.lit(label))


def compact_range(
    col: Column, filler: str = "entre", connector: str = "y", connector_only: bool = False
) -> Column:
    """Range label such as "entre 6 y 11" in the form "6-11".

    Every occurrence of the connector is replaced, inside words too, unless
    ``connector_only`` asks for the free-standing word.
    """
    text = F.replace(col.cast("string"), F.lit(filler), F.lit(""))
    if connector_only:
        text = F.regexp_replace(text, rf"\b{re.escape(connector)}\b", "-")
    else:
        text = F.replace(text, F.lit(connector), F.lit("-"))
    return strip(F.replace(text, F.lit(" - "), F.lit("-")))


def zero_pad(col: Column, width: int) -> Column:
    """Left padding with zeros that never truncates and keeps a leading sign."""
    text = col.cast("string")
    signed = F.concat(F.substring(text, 1, 1), F.lpad(F.substring(text, 2, width), width - 1, "0"))
    padded = F.when(text.rlike("^[+-]"), signed).otherwise(F.lpad(text, width, "0"))
    return F.when(F.length(text) < width, padded).otherwise(text)


def label(*parts: Column | str) -> Column:
    """Text built from literals (str) and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
