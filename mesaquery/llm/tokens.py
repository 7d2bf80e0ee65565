"""Token ids of whole texts by a public tokenizer, by way of a cache of words.

The tokenizer's splitting pattern never crosses white space and its normaliser composes nothing
across it, so that the ids of a text are those of its white-space-separated words in a row. Only
words that a worker hasn't met yet go through the tokenizer itself, many at a time: words of letters
alone by themselves where the vocabulary marks a word's last id, and others with a separator between
them whose id no other text gives. Where the tokenizer parts letters from punctuation, a word with
punctuation behind its letters is put together from the two. Probes tell whether a tokenizer is of this kind; one that
isn't, as it glues white space to words, gets whole texts.
"""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from mesaquery.llm.common import claim

#: Words after which a worker's cache starts anew: a bound on memory, without effect on ids.
CACHE_WORDS = 600_000
#: Texts that are encoded at once: a bound on a worker's memory.
ROWS = 256
#: Words that are encoded as one text, with a separator in between.
JOINED = 128
_SEPARATOR, _PROBE = "\x00", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: An apostrophe can belong to the letters after it.
_PUNCTUATION = string.punctuation.replace("'", "")
_PROBES = ("one", "Two", "3", "...", "don't", "é.", "x1y", "\u0301", "\u4e16", "the", "</s>", "\U0001f600")


class WordIds:
    def __init__(self, tokenizer_file: str, cache_words: int = CACHE_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each task has its own core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.lowers = self._ids([_PROBE]) == self._ids([_PROBE.lower()])
        self.separator = self._ids([_SEPARATOR])[0]
        each = [*chain.from_iterable(self._ids([*_PROBES]))]
        self.by_words = all(ids == each for ids in self._ids([f"{s}{s.join(_PROBES)}{s}" for s in (" ", "\t", "\n", "\r", "\x0b", "\x0c", " \n ")]))
        parts = [("one", "."), ("\u00e9t\u00e9", "***"), ("\u4e16", "!?"), ("the", "&&&"), ("Two", ")"), ("a", "_"), ("on", "---")]
        whole = self._ids([a + b for a, b in parts])
        self.by_parts = all(x == y + z for x, (y, z) in zip(whole, (self._ids([*p]) for p in parts), strict=True))
        self.cache_words = cache_words
        self.last = self._last_ids()
        self._reset()

    def _last_ids(self) -> np.ndarray | None:
        """Which ids end a word, where the vocabulary has a mark for that."""
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not mark:
            return None
        vocabulary = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        return ends

    def _reset(self) -> None:
        self.new: list[bytes] = []
        self.index = _Index(self.new)
        self.ids, self.first, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids start (one more entry than texts)."""
        if not self.by_words:
            ids = self._ids([(t or b"").decode() for t in texts])
            return np.array([*chain.from_iterable(ids)], np.uint32), np.cumsum([0, *map(len, ids)])
        if len(self.index) > self.cache_words:
            self._reset()
        # Words that the tokenizer itself lower-cases are cached in one form.
        words = [(t or b"").lower().split() for t in texts] if self.lowers else [(t or b"").split() for t in texts]
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), np.int64, int(n_words.sum()))
        self._learn()
        flat, stops = self._gathered(at)
        return flat, stops[np.concatenate(([0], np.cumsum(n_words)))]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [e.ids for e in encode(texts, add_special_tokens=False)]

    def _learn(self) -> None:
        if not self.new:
            return
        known, words, plain, other, joined = len(self.first), [], [], [], []
        for i, raw in enumerate(self.new):  # which grows by the parts of words
            word = raw.decode()
            words.append(word)
            if self.last is not None and word.isalpha():
                plain.append(i)
            elif self.by_parts and (cut := _letters(word)):
                joined.append((i, self.index[raw[:cut]], self.index[raw[cut:]]))
            else:
                other.append(i)
        self.new.clear()
        order, flat, counts = [], [], []
        for numbers, between in ((plain, " "), (other, f" {_SEPARATOR} ")):
            groups = [np.array(numbers[i : i + JOINED]) for i in range(0, len(numbers), JOINED)]
            for group, ids in zip(groups, self._ids([between.join(words[i] for i in g) for g in groups]), strict=True):
                got = np.array(ids, np.uint32)
                order.append(group)
                if between == " " and len(cuts := np.flatnonzero(self.last[got]) + 1) == len(group):
                    flat.append(got)  # each word has an end, and there are no more
                    counts.append(np.diff(cuts, prepend=0))
                elif between != " " and len(self.separator) == 1 and len(cuts := np.flatnonzero(got == self.separator[0])) == len(group) - 1:
                    flat.append(np.delete(got, cuts))
                    counts.append(np.diff(np.concatenate(([-1], cuts, [len(got)]))) - 1)
                else:  # a word holds the separator, or it isn't one id
                    alone = self._ids([words[i] for i in group])
                    flat.append(np.array([*chain.from_iterable(alone)], np.uint32))
                    counts.append(np.array([*map(len, alone)], np.int64))
        # Nothing goes to the tokenizer where all words are put together of known parts.
        place, sizes = (np.concatenate([np.empty(0, np.int64), *x]) for x in (order, counts))
        first, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        first[place], size[place] = len(self.ids) + np.cumsum(sizes) - sizes, sizes
        self.ids = np.concatenate((self.ids, *flat))
        self.first, self.size = np.concatenate((self.first, first)), np.concatenate((self.size, size))
        if joined:
            place, *parts = np.array(joined, np.int64).T
            flat, stops = self._gathered(np.stack(parts, axis=1).ravel())
            self.first[known + place], self.size[known + place] = len(self.ids) + stops[:-1:2], stops[2::2] - stops[:-1:2]
            self.ids = np.concatenate((self.ids, flat))

    def _gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known words in a row, by their numbers, and where each one's start (one more entry than words)."""
        first, n_ids = self.first[at], self.size[at]
        stops = np.concatenate(([0], np.cumsum(n_ids)))
        return self.ids[np.repeat(first - stops[:-1], n_ids) + np.arange(stops[-1])], stops


def _letters(word: str) -> int:
    """How many bytes of letters come before punctuation that is all the rest; 0 if it isn't so.

    Letters that the tokenizer's normal form or lower case would part into a letter and a mark don't count.
    """
    stem = word.rstrip(_PUNCTUATION)
    if not stem or len(stem) == len(word) or not stem.isalpha():
        return 0
    if stem.isascii():
        return len(stem)
    return len(stem.encode()) if unicodedata.is_normalized("NFC", word) and stem.lower().isalpha() else 0


class _Index(dict):
    """Number of each word in order of appearance; words met first also go to ``new``."""

    def __init__(self, new: list[bytes]):
        self.new = new

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n


def vocabulary_of(tokenizer_file: str) -> int:
    """One more than the largest id."""
    from tokenizers import Tokenizer

    return 1 + max(Tokenizer.from_file(tokenizer_file).get_vocab().values())


_made: dict[str, WordIds] = {}


def word_ids(tokenizer_file: str, cache_words: int = CACHE_WORDS) -> WordIds:
    """One per worker process and file."""
    claim("tokens", _made.clear)
    if tokenizer_file not in _made:
        _made[tokenizer_file] = WordIds(tokenizer_file)
    _made[tokenizer_file].cache_words = cache_words
    return _made[tokenizer_file]


def few_rows(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches; no empty ones."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def texts_of(column) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string column."""
    return column.cast(pa.binary()).to_pylist()
