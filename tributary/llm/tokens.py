"""Token ids of whole texts by way of their distinct words.

For a tokenizer that drops white space before it merges, the ids of a text are
the ids of its words in order. Each distinct word of a chunk is encoded once;
words seen before come from a table kept by the task.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tributary.llm.common import ranges, split_words

MOST_WORDS = 1_000_000
WORDS_AT_ONCE = 32_768  # an encoding takes about 100 times the memory of its word
# ASCII punctuation but the apostrophe, behind a letter or digit, at a word's end.
CLOSING = r"([\p{L}\p{N}])([!-&(-/:-@\[-`{-~]+)$"


class WordTokens:
    """Word-wise encoding with a table of at most ``MOST_WORDS`` words, emptied when full."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)

    def _places(self, words: pa.Array) -> np.ndarray:
        """Places of the words, all different, in the table; new ones are added."""
        if len(self.words) + len(words) > MOST_WORDS:
            self._clear()
        # hashes the words of the chunk, not the table, which may be many times larger
        asked = pc.index_in(self.words, value_set=words)
        held = np.flatnonzero(pc.is_valid(asked).to_numpy(zero_copy_only=False))
        places = np.full(len(words), -1, np.int64)
        places[asked.drop_null().to_numpy()] = held
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = words.take(pa.array(missing))
            places[missing] = len(self.words) + np.arange(len(new))
            flat, sizes = [], []
            for start in range(0, len(new), WORDS_AT_ONCE):
                some = new.slice(start, WORDS_AT_ONCE).to_pylist()
                found = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                sizes.append(np.fromiter(map(len, found), np.int64, count=len(found)))
                flat.append(np.fromiter(chain.from_iterable(found), np.int32, count=int(sizes[-1].sum())))
            self.words = pa.concat_arrays([self.words, new.cast(pa.string())])
            self.ids = np.concatenate([self.ids, *flat])
            ends = self.offsets[-1] + np.cumsum(np.concatenate(sizes))
            self.offsets = np.concatenate([self.offsets, ends])
        return places

    def _encode_parts(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        codes, offsets, parts = split_words(values)
        places = self._places(parts)[codes]
        lengths = self.offsets[places + 1] - self.offsets[places]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[ranges(self.offsets[places], lengths)], ends[offsets]

    def encode(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the texts' offsets.

        The tokenizer folds case and starts anew at punctuation behind a letter or
        digit, so distinct words are encoded folded and without it; words that may
        hold a special token (``<|``) are left as they are.
        """
        codes, offsets, words = split_words(values)
        folded = pc.replace_substring_regex(pc.ascii_lower(words), CLOSING, r"\1 \2")
        plain = pc.invert(pc.match_substring(words, "<"))
        ids, ends = self._encode_parts(pc.if_else(plain, folded, words))
        lengths = np.diff(ends)[codes]
        stops = np.concatenate([[0], np.cumsum(lengths)])
        return ids[ranges(ends[codes], lengths)], stops[offsets]
